"""Substring search that reads the postings of a few trigrams instead of every text.

A text that holds a needle holds all of the needle's runs of three characters. A posting table has a
row per text and distinct trigram, sorted by trigram so that files of others are skipped; the keys
that have all of the needle's are then put to the exact test. Postings of rows that changed or
went only cost work: the test decides. Needles without a run of three letters scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import matches


def _trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), F.lit(1)))


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(trigram, key) rows of a table; NULL and shorter texts have none."""
    return df.select(F.explode(_trigrams(F.col(text))).alias("trigram"), F.col(key).alias("key"))


def write_postings(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store postings in order of trigrams; ``mode="append"`` adds those of new rows."""
    rows.repartitionByRange("trigram", "key").sortWithinPartitions("trigram", "key").write.mode(mode).parquet(path)


def _needed(df: DataFrame, needle: str, literal: bool) -> list[str]:
    """The trigrams of a needle between its wildcards, worked out as those of the texts are."""
    pattern = F.lower(F.lit(needle.strip()))
    runs = F.array(pattern) if literal else F.split(pattern, r"\\.?|[%_]", -1)
    every = F.array_distinct(F.flatten(F.transform(runs, _trigrams)))
    return df.sparkSession.sql("SELECT 1").select(every).first()[0]


def find(
    df: DataFrame, key: str, text: str, index: DataFrame, needle: str, literal: bool = False
) -> DataFrame:
    """Rows whose text holds the needle, as ``matches`` tests it; all rows for a blank needle."""
    test = matches(text, needle, literal)
    if test is None:
        return df
    wanted = _needed(df, needle, literal)
    if not wanted:
        return df.where(test)
    held = index.where(F.col("trigram").isin(*wanted)).groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    likely = held.where(F.col("_n") >= len(wanted)).select(F.col("key").alias(key))
    return df.join(likely, key, "left_semi").where(test)
