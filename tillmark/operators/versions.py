"""Current rows out of a table that collects every change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_version(df: DataFrame, key: str | list[str], at: str) -> DataFrame:
    """The newest row per key. Rows without a time are older than all others.

    Equal times are decided by the other columns, so the outcome does not depend on the
    order of the rows. Spark cuts each key to its first row before the shuffle, so a key
    with very many versions does not travel whole.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [F.desc_nulls_last(c) for c in df.columns if c not in (*keys, at)]
    newest = W.partitionBy(*keys).orderBy(F.desc_nulls_last(at), *rest)
    return df.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")
