"""Exact duplicates by a streaming job with keyed state on disk.

The stream groups rows by the digest of their text. Its state lives in RocksDB, never
expires, and keeps per digest the number of copies, the largest identifier and the place
of that row's content (file and row number). The state is then read as a table. Rows whose
digest was hit more than once are compared with the bytes of the row that stays.

Only DataFrame functions are used: no Python runs on the executors.

Defined results:

* a NULL text counts as the empty text; texts of any length are read whole;
* of equal texts the row with the largest id stays, a NULL id is smaller than any other;
* rows repeated with the same id and text: the last one by file name and row number stays,
  so that exactly one row of a group has ``kept``;
* an empty table gives an empty result;
* columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.session import new_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Without fallocate a small state store takes the disk it fills, not 4 MB and more.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

# Bits of the filter that keeps unique texts out of the byte comparison: 1 MB at any size.
# A full filter lets rows through that the comparison then drops.
FILTER_BITS = 23


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(source: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]):
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # Where the row lies, even where a column is called like Spark's own.
    place = source.metadataColumn("_metadata")
    return source.select(
        F.col(f"`{id_col}`").alias("id"),
        text.alias("text"),
        digest(text.cast("binary")).alias("digest"),
        place["file_path"].alias("file"),
        place["row_index"].alias("row"),
    )


def _file_or_folder(path: str) -> str:
    """The path as a pattern: a stream takes a single file only where a pattern names it."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def follow(
    spark: SparkSession,
    path: str,
    id_col: str,
    text_col: str,
    digest: Callable[[Column], Column],
    state: str,
    batch_bytes: int,
) -> None:
    """Bring the state up to date with every file below ``path`` that it has not yet seen."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes)
    rows = _rows(stream.parquet(_file_or_folder(path)), id_col, text_col, digest)
    counted = rows.groupBy("digest").agg(
        F.max(F.struct("id", "file", "row")).alias("keep"), F.count("*").alias("copies")
    )
    before = {key: spark.conf.get(key, None) for key in STREAM_SETTINGS}
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (
            counted.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state_table(spark: SparkSession, state: str) -> DataFrame:
    """The keyed state as rows of digest, keep (id, file, row) and copies."""
    raw = spark.read.format("statestore").load(state)
    keep, copies = raw.schema["value"].dataType.names
    return raw.select(
        F.col("key").getField(raw.schema["key"].dataType.names[0]).alias("digest"),
        F.col("value").getField(keep).alias("keep"),
        F.col("value").getField(copies).alias("copies"),
    )


def _hit_filter(hits: DataFrame, bits: int) -> DataFrame:
    """One row: an array of 64-bit words, a bit set for each digest in ``hits``."""
    place = F.pmod(F.xxhash64("digest"), F.lit(1 << bits))
    words = (
        hits.select(
            F.shiftright(place, 6).alias("word"),
            F.expr(f"shiftleft(1L, cast(pmod(xxhash64(digest), {1 << bits}) & 63 as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bit"))
    )
    zeros = hits.sparkSession.range(1 << (bits - 6)).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    full = zeros.unionByName(words).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    return full.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bit"))), lambda w: w["bit"]).alias("words")
    )


def stream_dedup(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    state: str | None = None,
    batch_bytes: int = 8 << 30,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per row of the Parquet table at ``path``: id, keep_id, group_size, kept, digest.

    ``state`` names the folder of the stream's state; given again, only new files are read
    into it. A new folder below the shared one is used by default. ``batch_bytes`` bounds one
    micro-batch.
    """
    state = state or new_dir(spark, "dedup-state")
    follow(spark, path, id_col, text_col, digest, state, batch_bytes)
    known = new_dir(spark, "dedup-known")
    state_table(spark, state).write.parquet(known)
    groups = spark.read.parquet(known)
    rows = _rows(spark.read.parquet(path), id_col, text_col, digest)

    single = rows.join(groups.where("copies = 1").select("digest"), "digest").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest",
    )

    hits = groups.where("copies > 1")
    words = _hit_filter(hits, filter_bits).scalar()
    place = F.pmod(F.xxhash64("digest"), F.lit(1 << filter_bits))
    maybe = rows.where(
        F.getbit(F.element_at(words, (F.shiftright(place, 6) + 1).cast("int")), (place % 64).cast("int")) == 1
    )
    stays = maybe.join(
        hits.select("keep.file", "keep.row", "keep", "copies"), ["file", "row"]
    ).select("digest", "keep", "copies", F.col("text").alias("keep_text"))
    done = new_dir(spark, "dedup-checked")
    (
        maybe.join(stays, "digest")
        .select(
            "id", "digest", "file", "row", "keep", "copies",
            (F.col("text").cast("binary") == F.col("keep_text").cast("binary")).alias("same"),
        )
        .write.parquet(done)
    )
    checked = spark.read.parquet(done)
    if not checked.where("not same").isEmpty():
        checked = _split_collisions(rows, checked)
    return single.unionByName(
        checked.select(
            "id", F.col("keep.id").alias("keep_id"), F.col("copies").alias("group_size"),
            ((F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))).alias("kept"),
            "digest",
        )
    )


def _split_collisions(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """Groups of equal digests and different bytes, taken apart by their bytes."""
    odd = checked.where("not same").select("digest").distinct()
    texts = rows.join(odd, "digest")
    real = texts.groupBy("digest", "text").agg(
        F.max(F.struct("id", "file", "row")).alias("keep"), F.count("*").alias("copies")
    )
    apart = texts.join(real, ["digest", "text"]).select(
        "id", "digest", "file", "row", "keep", "copies", F.lit(True).alias("same")
    )
    return checked.join(odd, "digest", "left_anti").unionByName(apart)
