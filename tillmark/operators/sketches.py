"""Distinct counts from sketches that are stored per day and merged as reports need them.

An exact count of distinct customers has to see every (group, customer) pair again for every
period asked for. A HyperLogLog sketch of 2 to the power of ``precision`` registers stands for the
customers of one group and day in some kilobytes; sketches of any days and groups merge without
counting anybody twice. The estimate's relative standard error is ``1.04 / sqrt(2 ** precision)``,
and small groups are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRECISION = 14
DAY = "sketch_day"
MONTH = "sketch_month"


def error_bound(precision: int = PRECISION, deviations: float = 4.0) -> float:
    """The relative error that an estimate stays within, at so many standard deviations."""
    return deviations * 1.04 / (1 << precision) ** 0.5


def daily_sketches(
    df: DataFrame, value: str, time: str, by: Sequence[str] = (), precision: int = PRECISION
) -> DataFrame:
    """One sketch of ``value`` per group and day. NULL values are nobody, NULL times no day.

    Tasks send one sketch per group and day they hold, never the values.
    """
    kind = df.schema[value].dataType
    exact = isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
    counted = F.col(value) if exact else F.col(value).cast("string")
    return (
        df.where(F.col(time).isNotNull())
        .groupBy(*by, F.to_date(time).alias(DAY))
        .agg(F.hll_sketch_agg(counted, precision).alias("sketch"))
    )


def store_days(sketches: DataFrame, path: str) -> None:
    """Write sketches in a folder per month, each month's in place of what is stored of it.

    A month is stored whole: with a new day come the month's earlier ones, as sketches.
    """
    (
        sketches.withColumn(MONTH, F.trunc(DAY, "MM"))
        .repartition(MONTH)
        .sortWithinPartitions(DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored sketches of the days from ``first`` to ``last``; other months' folders are not read."""
    days = spark.read.parquet(path)
    for day, least in ((first, True), (last, False)):
        if day is not None:
            at = F.lit(day).cast("date")
            month = F.lit(day[:8] + "01").cast("date")
            test = (F.col(DAY) >= at) & (F.col(MONTH) >= month) if least else (F.col(DAY) <= at) & (F.col(MONTH) <= month)
            days = days.where(test)
    return days.drop(MONTH)


def distinct_count(sketch: Column | str = "sketch") -> Column:
    """Aggregate: the distinct values of all sketches of a group, as a whole number."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def merged_sketch(sketch: Column | str = "sketch") -> Column:
    """Aggregate: one sketch for all of a group, to be stored or merged again."""
    return F.hll_union_agg(sketch)
