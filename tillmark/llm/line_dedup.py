"""Repeated passages of several lines, found by their bytes wherever they stand.

Candidates are

* every run of lines that just reaches ``LONG`` words: the shortest one from each line on and the
  shortest one up to each line. They overlap, so together the repeated ones cover each run of whole
  lines of ``LONG`` words or more that occurs elsewhere, from its first line to its last, and a
  copy of a text goes in whole;
* chunks of two lines or more with fewer words, cut where a rolling hash over the hashes of the
  last ``SPAN`` lines says so; they depend on what stands there and not on how far down it stands.
  Lines of ``LONG`` words end a chunk, and so do ``MOST`` lines;
* a whole text of fewer words.

Candidates whose bytes occur elsewhere are removed, all but the first: the one with the smallest
document id, then text digest, then line. One that overlaps an equal one of its own text (lines
said again and again) counts by its place in that repetition, so the first occurrence stays.

Candidates are compared by the digests of their lines, line by line, and every line of them is
grouped by its bytes: where two lines share a digest, the bytes themselves are compared instead.

Passes over the texts: one shuffles two hashes a candidate and finds the repeated ones; a bitmap
of these (8 MB at any size) lets the second pass write few other candidates; the removals of each
document are then joined to the documents.

Defined results:

* a NULL text stays NULL, an empty one empty; lines without words are removed within a passage and
  up to ``MOST`` of them at its ends, never alone;
* rows with equal id and text count as one occurrence and are all treated alike;
* a NULL id comes before any other; repeats within one document are removed as well;
* an empty table gives an empty result; other columns are kept; working columns carry the
  prefix ``_line_``; a text of any length is cut whole;
* only whole lines are removed: a passage that begins or ends within a line keeps that line.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.bitmaps import bitmap, held
from tillmark.llm.caches import forget, trim
from tillmark.llm.names import free
from tillmark.session import new_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPAN = 2  # lines under the rolling hash
EVERY = 3  # one boundary in so many lines, on average
LONG = 50  # words that make one line a passage
MOST = 32  # lines of a chunk
BITS = 26  # of the bitmap of repeated candidates

_WORD64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_OUT = pow(_BASE, SPAN, 1 << 64)


def digest(line: bytes) -> bytes:
    return blake2b(line, digest_size=16).digest()


def coded(lines: list[str]) -> list[bytes]:
    return [x.encode("utf-8", "surrogatepass") for x in lines]


def chunks(lines: list[str], digests: list[bytes] | None = None) -> list[tuple[int, int]]:
    """First line and number of lines of every chunk."""
    out, first, rolling = [], 0, 0
    hashes = [int.from_bytes(d[:8], "little") for d in digests or map(digest, coded(lines))]
    for i, h in enumerate(hashes):
        rolling = rolling * _BASE + h & _WORD64
        if i >= SPAN:
            rolling = rolling - hashes[i - SPAN] * _OUT & _WORD64
        alone = len(lines[i]) >= 2 * LONG - 1 and len(lines[i].split()) >= LONG
        if alone and i > first:
            out.append((first, i - first))
            first = i
        mixed = (rolling ^ rolling >> 29) * 0xBF58476D1CE4E5B9 & _WORD64
        if alone or (mixed >> 32) % EVERY == 0 or i + 1 - first == MOST:
            out.append((first, i + 1 - first))
            first = i + 1
    if first < len(lines):
        out.append((first, len(lines) - first))
    return out


def candidates(lines: list[str], digests: list[bytes]) -> list[tuple[int, int]]:
    """First line and number of lines of all that may be removed, in this order."""
    counts = [len(x.split()) for x in lines]
    words = list(accumulate(counts, initial=0))
    found = {(f, n) for f, n in chunks(lines, digests) if n > 1 and words[f + n] > words[f]}
    if words[-1] >= LONG:
        at, n = np.array(words), len(lines)
        upto = np.searchsorted(at, at[:-1] + LONG).tolist()
        since = (np.searchsorted(at, at[1:] - LONG, "right") - 1).tolist()
        blank = 0  # lines without words just before
        for i in range(n):
            blank = 0 if counts[i] else blank + 1
            if blank <= MOST and since[i] >= 0:
                found.add((since[i], i + 1 - since[i]))
        for i in range(n - 1, -1, -1):
            blank = 0 if counts[i] else blank + 1
            if blank <= MOST and upto[i] <= n:
                found.add((i, upto[i] - i))
    elif words[-1]:
        found.add((0, len(lines)))
    return sorted(found)


def _bodies(text: str, exact: bool) -> tuple[list[bytes], list[bytes], list[tuple[int, int, bytes]]]:
    """The lines as bytes, their digests, and first line, number of lines and body of each candidate.

    A body holds the bytes of the lines, or their digests. The k-th line of an overlapping
    repetition is marked: 0xFF is no byte of a text, and no mark is as long as a digest.
    """
    lines = text.split("\n")
    raw = coded(lines)
    digests = [digest(x) for x in raw]
    joined, size, out = b"".join(digests), len(digests[0]), []
    starts: dict[bytes, int] = {}
    for f, n in candidates(lines, digests):
        body = b"\n".join(raw[f : f + n]) if exact else joined[size * f : size * (f + n)]
        start = starts.get(body)
        if start is None or f >= start + n:
            starts[body] = f
        else:
            body += b"\xff%d" % (f - start)
        out.append((f, n, body))
    return raw, digests, out


def passages(text: str) -> Iterator[tuple[int, int, bytes]]:
    """First line, number of lines and bytes of the passages that may be removed."""
    yield from _bodies(text, True)[2]


def _keys(bodies: list[bytes]) -> np.ndarray:
    """Two hashes of each body: (bodies, 2)."""
    raw = b"".join(blake2b(b, digest_size=16).digest() for b in bodies)
    return np.frombuffer(raw, np.int64).reshape(-1, 2)


def _candidate_rows(rows: DataFrame, exact: bool) -> DataFrame:
    """The candidates whose hash may be repeated, and each of their lines (``line`` is not NULL)."""
    spark = rows.sparkSession

    def hashes(batches):
        forget()
        for batch in batches:
            keys = _keys([b for t in batch.column(0).to_pylist() if t for _, _, b in _bodies(t, exact)[2]])
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=["h", "g"])
            del keys
        trim()

    counted = rows.select("text").mapInArrow(hashes, "h long, g long").groupBy("h", "g").count()
    sent = spark.sparkContext.broadcast(bitmap(counted.where("count > 1"), "h", BITS))
    kind = rows.schema["id"].dataType.simpleString()

    def bodies(batches):
        forget()
        words = sent.value
        for batch in batches:
            at, first, lines, body, known = [], [], [], [], {}
            for i, text in enumerate(batch.column(1).to_pylist()):
                if not text:
                    continue
                raw, digests, found = _bodies(text, exact)
                keep = held(words, _keys([b for _, _, b in found])[:, 0]) if found else ()
                done = 0
                for (f, n, b), again in zip(found, keep):
                    if again:
                        at.append(i), first.append(f), lines.append(n), body.append(b)
                        for j in range(max(f, done), 0 if exact else f + n):
                            known[digests[j], raw[j]] = None
                        done = max(done, f + n)
            n = len(at)
            at, first, lines = at + [None] * len(known), first + [None] * len(known), lines + [None] * len(known)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at), batch.column(2).take(at),
                    pa.array(first, pa.int32()), pa.array(lines, pa.int32()),
                    pa.array(body + [d for d, _ in known], pa.binary()),
                    pa.array([None] * n + [x for _, x in known], pa.binary()),
                ],
                names=["id", "row_key", "first", "lines", "body", "line"],
            )
            del at, first, lines, body, known
        trim()

    path = new_dir(spark, "line-candidates")
    schema = f"id {kind}, row_key string, first int, lines int, body binary, line binary"
    rows.select("id", "text", "row_key").mapInArrow(bodies, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """Every passage to be removed; they may overlap. ``rows`` holds id, text and the key of the row, ``row_key``.

    Columns: row_key, first line, number of lines, and the id of the document that keeps it.
    """
    found = _candidate_rows(rows, exact=False)
    by_bytes = found.where("line IS NOT NULL").select("body", "line").distinct()
    if by_bytes.groupBy("body").count().where("count > 1").limit(1).count():
        found = _candidate_rows(rows, exact=True)
    seen = found.where("line IS NULL").drop("line")
    place = F.struct("id", "row_key", "first")
    firsts = seen.groupBy("body").agg(F.min(place).alias("stays"), F.count("*").alias("n")).where("n > 1")
    return (
        seen.join(firsts.select("body", "stays"), "body")
        .where((F.col("row_key") != F.col("stays.row_key")) | (F.col("first") != F.col("stays.first")))
        .select("row_key", "first", "lines", F.col("stays.id").alias("kept_by"))
    )


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping removals of a document as runs of lines that do not, one for each keeper in turn,
    and the lines between and around them as runs that stay."""
    for batch in batches:
        out, left = [], []
        for found in batch.column(1).to_pylist():
            runs, stays, end = [], [], 0
            for r in sorted(found, key=lambda r: (r["first"], -r["lines"])):
                first, after = max(r["first"], end), r["first"] + r["lines"]
                if after <= end:
                    continue
                if first > end:
                    stays.append((end, first - end))
                if runs and first == end and r["kept_by"] == runs[-1]["kept_by"]:
                    runs[-1]["lines"] += after - first
                else:
                    runs.append({"first": first, "lines": after - first, "kept_by": r["kept_by"]})
                end = after
            out.append(runs)
            left.append([*stays, (end, REST)])
        kept = pa.array(
            [[{"first": a, "lines": n} for a, n in runs] for runs in left],
            pa.list_(pa.struct([("first", pa.int32()), ("lines", pa.int32())])),
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, batch.column(1).type), kept], names=["row", "removed", "stays"]
        )


# More lines than a text can have: the run behind the last one removed.
REST = 2**30


def added_names(docs: DataFrame) -> tuple[str, str]:
    """What the added columns are called, numbers of lines and removals: underscores are added to
    names that the table has itself."""
    return free("_line_count", docs.columns), free("_line_removed", docs.columns)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated passages taken out of their texts.

    Added columns (see ``added_names``): ``_line_count`` (lines before) and ``_line_removed``, an
    array of first line, number of lines and the id of the document that keeps them.
    """
    counted, taken = added_names(docs)
    joint, runs = free("_line_key", docs.columns), free("_line_stays", docs.columns)
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    key = F.md5(F.concat_ws("|", F.coalesce(ident.cast("string"), F.lit("")), ident.isNull().cast("string"), text))
    rows = docs.select(ident.alias("id"), text.alias("text"), key.alias("row_key"))
    found = new_dir(docs.sparkSession, "line-repeats")
    repeats = (
        repeated_chunks(rows)
        .groupBy(F.col("row_key").alias("row"))
        .agg(F.collect_list(F.struct("first", "lines", "kept_by")).alias("removed"))
    )
    stays = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("lines", T.IntegerType())]))
    schema = T.StructType([*repeats.schema.fields, T.StructField("stays", stays)])
    repeats.mapInArrow(_apart, schema).write.parquet(found)
    removed = docs.sparkSession.read.parquet(found).select(
        F.col("row").alias(joint), F.col("removed").alias(taken), F.col("stays").alias(runs)
    )
    lines = F.split(text, "\n", -1)
    joined = docs.withColumn(joint, key).join(removed, joint, "left")

    def rest(split: Column) -> Column:
        return F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(split, r["first"] + 1, r["lines"]))), "\n")

    # The lines are split once for all runs.
    left = F.get(F.transform(F.array(lines), rest), F.lit(0))
    return joined.select(
        *[
            F.when(F.col(taken).isNull(), text).otherwise(left).alias(c) if c == text_col else F.col(f"`{c}`")
            for c in docs.columns
        ],
        F.coalesce(F.size(lines), F.lit(0)).alias(counted), F.col(taken),
    )
