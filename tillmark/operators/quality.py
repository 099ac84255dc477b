"""Integrity checks over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.operators.derive import order_totals


def orphans(
    child: DataFrame, parent: DataFrame, column: str, parent_key: str = "id"
) -> DataFrame:
    """Child rows whose reference points at no parent. An empty reference is no orphan."""
    keys = parent.select(F.col(parent_key).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column that must not have any, all counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_count").where("null_count > 0")


def order_total_mismatch(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders whose amounts differ from what their lines add up to.

    An order without lines should amount to its shipping alone.
    """
    sums = order_totals(details).select(
        F.col("order_id").alias("id"),
        F.col("total_amount").alias("line_total"),
        F.col("discount_amount").alias("line_discount"),
        F.col("payment_amount").alias("line_net"),
    )
    zero = F.lit(0).cast("decimal(12,2)")
    found = orders.join(sums, "id", "left").select(
        F.col("id").alias("order_id"),
        "total_amount",
        F.coalesce("line_total", zero).alias("expected_total"),
        F.coalesce("discount_amount", zero).alias("discount_amount"),
        F.coalesce("line_discount", zero).alias("expected_discount"),
        "payment_amount",
        (F.coalesce("line_net", zero) + F.coalesce("shipping_amount", zero)).alias(
            "expected_payment"
        ),
    )
    return found.where(
        (F.col("total_amount") != F.col("expected_total"))
        | (F.col("discount_amount") != F.col("expected_discount"))
        | (F.col("payment_amount") != F.col("expected_payment"))
    )
