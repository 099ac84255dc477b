"""Exact sums of money that stay on the fast path of the aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def money_sum(df: DataFrame, column: str) -> Column:
    """The sum of an amount of at most two decimals, as ``decimal(24,2)``.

    Decimal sums over ``decimal(10,2)`` need a buffer of more than 18 digits, which Spark
    updates through big integers. Whole cents in longs cost less per row. They are summed in
    two parts, millions of cents and the rest, and joined as decimals, so neither sum
    can overflow below 9e12 rows. Columns of more than 12 digits or two decimals are summed as
    they are.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, T.DecimalType) or kind.scale > 2 or kind.precision > 12:
        return F.sum(column)
    cents = (F.col(column) * 100).cast("long")
    million = F.lit(1_000_000).cast("long")
    high = F.sum(((cents - cents % million) / million).cast("long")).cast("decimal(19,0)")
    low = F.sum(cents % million).cast("decimal(19,0)")
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    return (high * F.lit("10000").cast("decimal(5,0)") + low * hundredth).cast("decimal(24,2)")
