"""WARC archives: writing, reading, and revisit records in place of repeated payloads.

Pages are written as response records, then read back. Only their headers are shuffled, by
payload digest: the record with the smallest page id of equal payloads stays a response, the
others become revisits of it. Deduplicated archives are written with fresh headers and read back;
what is returned comes from those files alone, revisits joined to the responses they name.

Archives are gzip files written by Spark's text writer with the end of a WARC record as line
separator, in the folder given or a new one below the shared folder. Within a task an archive
is closed at ``ARCHIVE_BYTES``, so that reading holds one archive at a time. A lost executor
costs the files of its tasks, which are written again.

Payloads are equal when SHA-1, SHA-256 and length all agree.

Defined results:

* a NULL payload is an empty one; payloads of any length are kept whole;
* payloads under ``least_bytes`` bytes are responses, however often they occur;
* a NULL page id counts as larger than any other; repeated rows are records of their own, and of
  equal page ids the record with the smaller id (by its UUID) is the response;
* a NULL URL gives a record without target; control characters, spaces and line ends in URLs are
  percent-encoded;
* an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.session import new_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARCHIVE_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many rows while a job runs."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean_uri(uri: str) -> str:
    return "".join(c if "!" <= c <= "~" or c > "\x9f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri)


def record(kind: str, record_id: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """A WARC record without the two line ends that close it."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>"]
    lines += [f"{name}: {value}" for name, value in fields.items() if value is not None]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        stop = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:stop].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start = stop + 4
        end = start + int(fields["Content-Length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it says")
        yield fields, archive[start:end]
        at = end + 4


def bare_id(field: str | None) -> str | None:
    return field[len("<urn:uuid:") : -1] if field else None


def unzip(content: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while content:
        d = zlib.decompressobj(31)
        out.append(d.decompress(content))
        content = d.unused_data
    return b"".join(out)


def write_archives(records: DataFrame, folder: str) -> None:
    """Writes columns archive and record (bytes), a folder per archive number."""
    (
        records.select("archive", F.col("record").cast("string").alias("value"))
        .write.partitionBy("archive")
        .option("lineSep", END)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(folder)
    )


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.load(folder).select("content")


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH_BYTES by the length of column number ``size``."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 200 + len(row[size] or b"")
        if weight >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


RECORDS = pa.schema([("archive", pa.int32()), ("record", pa.binary())])


def write_responses(pages: DataFrame, folder: str, id_col: str, url_col: str, payload_col: str) -> None:
    """A response record for every page."""
    rows = pages.select(
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{payload_col}`").cast("binary").alias("payload"),
        F.monotonically_increasing_id().alias("n"),
    )
    space = uuid.uuid4()

    def build(batches):
        def made():
            written = 0
            for batch in batches:
                for page, url, payload, n in zip(*(c.to_pylist() for c in batch.columns)):
                    payload = payload or b""
                    fields = {
                        "WARC-Date": DATE,
                        "WARC-Target-URI": None if url is None else clean_uri(url),
                        "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}",
                        "X-Page-ID": page,
                    }
                    out = record("response", str(uuid.uuid5(space, str(n))), fields, HTTP + payload)
                    yield written // ARCHIVE_BYTES, out
                    written += len(out)

        yield from _batches(made(), RECORDS, 1)

    write_archives(rows.mapInArrow(build, "archive int, record binary"), folder)


HEADERS = pa.schema(
    [("record_id", pa.string()), ("page", pa.string()), ("url", pa.string()), ("kind", pa.string()),
     ("digest", pa.string()), ("refers", pa.string()), ("n", pa.int64()), ("sha256", pa.binary()),
     ("payload", pa.binary())]
)
HEADER_TYPES = (
    "record_id string, page string, url string, kind string, digest string, refers string, n long, "
    "sha256 binary, payload binary"
)


def read_records(spark: SparkSession, folder: str, payloads: bool) -> DataFrame:
    """The records below a folder, with their payloads or without. Digests are worked out anew."""

    def read(batches):
        def found():
            for batch in batches:
                for content in batch.column(0):
                    for fields, block in parse(unzip(content.as_py())):
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = fields["WARC-Type"] == "response"
                        if response and sha1_base32(payload) != said:
                            raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
                        yield (
                            bare_id(fields["WARC-Record-ID"]), fields.get("X-Page-ID"),
                            fields.get("WARC-Target-URI"), fields["WARC-Type"], said,
                            bare_id(fields.get("WARC-Refers-To")), len(payload),
                            hashlib.sha256(payload).digest() if response else None,
                            payload if payloads else None,
                        )

        yield from _batches(found(), HEADERS, 8)

    return archive_files(spark, folder).mapInArrow(read, HEADER_TYPES)


def fresh_id(record_id: str) -> str:
    """The id of a record in the deduplicated archives."""
    return str(uuid.uuid5(uuid.UUID(record_id), "deduplicated"))


def revisits(headers: DataFrame, least_bytes: int, id_type: str) -> DataFrame:
    """The records that become revisits, with the id, page and URL of the response they refer to."""
    keys = ["digest", "sha256", "n"]
    order = F.struct(F.col("page").isNull().alias("none"), F.col("page").cast(id_type).alias("page_id"), "record_id", "url")
    known = headers.where((F.col("kind") == "response") & (F.col("n") >= least_bytes))
    first = known.groupBy(*keys).agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    return (
        known.select(*keys, "record_id")
        .join(first.where("copies > 1"), keys)
        .where(F.col("record_id") != F.col("first.record_id"))
        .select("record_id", F.col("first.record_id").alias("to_id"), F.col("first.url").alias("to_url"))
    )


def write_deduplicated(records: DataFrame, found: DataFrame, folder: str) -> None:
    """Responses whole, revisits without payload, all with fresh headers."""
    joined = records.join(found, "record_id", "left").select(
        "record_id", "page", "url", "digest", "to_id", "to_url", "payload"
    )

    def build(batches):
        def made():
            written = 0
            for batch in batches:
                for rid, page, url, digest, to, to_url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                    fields = {
                        "WARC-Date": DATE, "WARC-Target-URI": url,
                        "WARC-Payload-Digest": f"sha1:{digest}", "X-Page-ID": page,
                    }
                    if to is None:
                        out = record("response", fresh_id(rid), fields, HTTP + payload)
                    else:
                        fields |= {
                            "WARC-Profile": REVISIT_PROFILE,
                            "WARC-Refers-To": f"<urn:uuid:{fresh_id(to)}>",
                            "WARC-Refers-To-Target-URI": to_url, "WARC-Refers-To-Date": DATE,
                        }
                        out = record("revisit", fresh_id(rid), fields, HTTP)
                    yield written // ARCHIVE_BYTES, out
                    written += len(out)

        yield from _batches(made(), RECORDS, 1)

    write_archives(joined.mapInArrow(build, "archive int, record binary"), folder)


def deduplicate(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Archives of the pages, then deduplicated ones; one row per record read from the latter.

    Columns: id, payload_bytes and payload_digest (of the full payload), record_type, refers_to
    (the response's page id), record_id. The archives are in ``raw`` and ``deduplicated`` below
    ``folder``.
    """
    spark = pages.sparkSession
    folder = folder or new_dir(spark, "warc")
    id_type = pages.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    raw, final, headers, result = (f"{folder}/{x}" for x in ("raw", "deduplicated", "headers", "result"))
    with arrow_rows(spark, 200):
        write_responses(pages, raw, id_col, url_col, payload_col)
    if pages.isEmpty():
        return spark.createDataFrame(
            [], f"id {id_type}, payload_bytes long, payload_digest string, record_type string, "
            f"refers_to {id_type}, record_id string"
        )
    with arrow_rows(spark, 1):  # one archive at a time
        read_records(spark, raw, payloads=False).drop("payload").write.parquet(headers)
        found = revisits(spark.read.parquet(headers), least_bytes, id_type)
        write_deduplicated(read_records(spark, raw, payloads=True), found, final)
        read_records(spark, final, payloads=False).drop("payload", "sha256").write.parquet(result)
    records = spark.read.parquet(result)
    page = F.col("page").cast(id_type)
    responses = records.where("kind = 'response'")
    named = responses.select(
        F.col("record_id").alias("refers"), page.alias("refers_to"), F.col("n").alias("payload_bytes"),
        F.col("digest").alias("named_digest"),
    )
    again = records.where("kind = 'revisit'").join(named, "refers").where("digest = named_digest")
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    same = {"id": page, "payload_digest": F.col("digest"), "record_type": F.col("kind")}
    return (
        responses.withColumns(same)
        .withColumns({"payload_bytes": F.col("n"), "refers_to": F.lit(None).cast(id_type)})
        .select(*columns)
        .unionByName(again.withColumns(same).select(*columns))
    )
