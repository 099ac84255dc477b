"""Quality rules over words and lines, and lines that many documents of one host share.

Everything is an expression of Spark's; no Python runs on rows. Within a text, windows of eight
words are hashed and sorted; windows whose hash occurs twice are compared by their words. Across
texts, normalised lines are hashed, counted per host, and those above the limits are counted again
by distinct documents before they are removed. A document left with too few of its words goes.

Results for odd input: NULL and empty texts have no words and fail; NULL ids are documents of their
own, repeated rows of one id are one document for the count and each get their row; rows without
a host share a host of their own; an empty table gives no rows. Other columns are not read, so
their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.session import new_dir

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
# A line is common to a host from this many of its documents on, if they also are more than
# this share of them.
COMMON_DOCUMENTS = 10
COMMON_PERCENT = 10
# What has to be left of a document's words.
LEFT_PERCENT = 50


def let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def _again(sorted_pairs: Column, key: str) -> Column:
    """The entries whose neighbour has the same key."""

    def same(x: Column, i: Column) -> Column:
        return (F.get(sorted_pairs, i - 1)[key] == x[key]) | (F.get(sorted_pairs, i + 1)[key] == x[key])

    return F.filter(sorted_pairs, same)


def repeated_words(words: Column, size: Column) -> Column:
    """How many words lie in a window of ``WINDOW`` words that occurs twice or more."""
    starts = F.sequence(F.lit(0), size - WINDOW)

    def hashes(h: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(at: Column) -> Column:
        def step(total: Column, i: Column) -> Column:
            gap = F.coalesce(F.get(at, i + 1) - F.get(at, i), F.lit(WINDOW))
            return total + F.least(gap, F.lit(WINDOW))

        return F.when(F.size(at) == 0, F.lit(0)).otherwise(
            F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), F.lit(0), step)
        )

    def exact(pairs: Column) -> Column:
        texts = F.transform(
            _again(pairs, "h"),
            lambda x: F.struct(
                F.array_join(F.slice(words, x["at"] + 1, WINDOW), " ").alias("w"), x["at"].alias("at")
            ),
        )
        return let(
            F.sort_array(texts),
            lambda t: let(F.sort_array(F.transform(_again(t, "w"), lambda x: x["at"])), covered),
        )

    def counted(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.sort_array(pairs), exact)
        )

    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(hashes(h), counted))
    return F.when(size < WINDOW, F.lit(0)).otherwise(found)


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def measured(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Counts of every row, and its lines as hashes with their numbers of words."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    split = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`").cast("string")), F.lit("-")).alias("host"),
        body.alias("text"),
        words_of(body).alias("words"),
        F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )
    sized = split.withColumn("size", F.size("words"))
    return sized.select(
        "row", "key", "host",
        F.col("size").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), F.col("size")).cast("long").alias("n_repeat_words"),
        F.transform(
            "lines",
            lambda x: F.struct(
                F.unhex(F.md5(normalised(x))).alias("hash"), F.size(words_of(x)).alias("words")
            ),
        ).alias("lines"),
    )


def common_lines(lines: DataFrame, hosts: DataFrame, count: Column) -> DataFrame:
    """(host, hash) of the lines that ``count`` puts above both limits."""
    many = lines.groupBy("host", "hash").agg(count.alias("docs"))
    many = many.where(F.col("docs") >= COMMON_DOCUMENTS)
    above = F.col("docs") * 100 > F.col("host_docs") * COMMON_PERCENT
    return many.join(hosts, "host").where(above).select("host", "hash")


def line_frequency(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """Counts, the base rule and the verdict of every row.

    A line counts by its normalised form (lower case, runs of white space as one space). Returns
    ``key``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_common_words (words of removed lines) and kept.
    """
    path = new_dir(spark, "line-rules")
    measured(docs, key, text, host).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    document = F.coalesce(F.col("key").cast("string"), F.concat(F.lit("row "), "row"))
    named = rows.withColumn("doc", document)
    hosts = named.groupBy("host").agg(F.count_distinct("doc").alias("host_docs"))
    lines = named.select("row", "doc", "host", F.inline("lines"))
    # A first count takes a document's own repeats in; few lines pass it, and these are counted
    # by distinct documents.
    hits = new_dir(spark, "line-rules-hits")
    lines.join(common_lines(lines, hosts, F.count(F.lit(1))), ["host", "hash"]).write.parquet(hits)
    hits = spark.read.parquet(hits)
    common = common_lines(hits, hosts, F.count_distinct("doc"))
    gone = hits.join(common, ["host", "hash"]).groupBy("row").agg(F.sum("words").alias("gone"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = rows.drop("lines").join(gone, "row", "left").select(
        F.col("key").alias(key), *counts, F.coalesce("gone", F.lit(0)).cast("long").alias("n_common_words")
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT
    )
    left = F.col("n_words") - F.col("n_common_words")
    enough = left * 100 >= F.col("n_words") * LEFT_PERCENT
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)
