"""The eight dashboard charts and the share-of-total view.

Facts are aggregated by their own key before they meet a dimension. A product, channel
or user that holds a large part of all rows is then reduced on the map side, and the
joins only see one row per key. Dimension joins carry no hint: Spark broadcasts a
dimension when its known size is below the threshold and sort-merges it otherwise.

All charts count orders of every status unless the name says otherwise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.fixed_values import (
    BEHAVIOR_LABELS,
    HOT_PRODUCTS,
    PAID,
    PAYMENT_LABELS,
    TREND_DAYS,
)
from tillmark.functions import Day, as_date, labelled, money_sum, ratio, region_name, since
from tillmark.operators.joins import range_lookup


def sales_trend(orders: DataFrame, as_of: Day, days: int = TREND_DAYS) -> DataFrame:
    """Orders and payments per day over the last ``days`` days, quiet days as zeros.

    The time filter starts ``days`` days back and has no upper bound, so the day just
    before the filled range, and later days, appear when they have orders. The calendar
    enters as zero rows ahead of the aggregation, which needs no join.
    """
    last = as_date(as_of)
    spark = orders.sparkSession
    observed = orders.where(since("create_time", last, days)).select(
        F.to_date("create_time").alias("order_date"),
        F.lit(1).cast("long").alias("n"),
        "payment_amount",
    )
    amount_type = orders.schema["payment_amount"].dataType
    calendar = spark.range(days).select(
        F.date_add(F.lit(last - dt.timedelta(days=days - 1)), F.col("id").cast("int")).alias(
            "order_date"
        ),
        F.lit(0).cast("long").alias("n"),
        F.lit(0).cast(amount_type).alias("payment_amount"),
    )
    days_seen = observed.unionByName(calendar)
    return (
        days_seen.groupBy("order_date")
        .agg(
            F.sum("n").alias("order_count"),
            F.coalesce(money_sum(days_seen, "payment_amount"), F.lit(0)).alias("total_amount"),
        )
        .orderBy("order_date")
    )


def user_distribution(addresses: DataFrame) -> DataFrame:
    """Distinct users per province, with the largest count beside every row."""
    counts = addresses.groupBy("province").agg(F.countDistinct("user_id").alias("value"))
    largest = counts.agg(F.max("value")).scalar()
    return counts.select(
        region_name("province").alias("name"),
        "value",
        F.greatest(F.lit(1).cast("long"), largest).alias("max"),
    ).orderBy(F.desc("value"), "name")


def category_sales(
    categories: DataFrame, products: DataFrame, details: DataFrame, by_id: bool = False
) -> DataFrame:
    """Net sales per category; categories without sales are kept with zero.

    Every category enters once more with zero, so none is lost and the names need one
    aggregation only.
    """
    per_product = details.groupBy("product_id").agg(
        money_sum(details, "actual_price").alias("sales")
    )
    names = categories.select(F.col("id").alias("category_id"), "category_name")
    sold = per_product.join(
        products.select(F.col("id").alias("product_id"), "category_id"), "product_id"
    ).join(names, "category_id")
    keys = ["category_id", "category_name"] if by_id else ["category_name"]
    return (
        sold.select(*keys, "sales")
        .unionByName(names.select(*keys, F.lit(0).cast("decimal(24,2)").alias("sales")))
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("sales"), F.lit(0)).alias("total_sales"))
        .orderBy(F.desc("total_sales"), "category_name")
    )


def channel_analysis(channels: DataFrame, orders: DataFrame, by_id: bool = False) -> DataFrame:
    """Orders and payments per channel; orders without a channel are left out."""
    per_channel = (
        orders.where(F.col("channel_id").isNotNull())
        .groupBy("channel_id")
        .agg(F.count("id").alias("n"), money_sum(orders, "payment_amount").alias("amount"))
    )
    names = channels.select(F.col("id").cast("long").alias("channel_id"), "channel_name")
    keys = ["channel_id", "channel_name"] if by_id else ["channel_name"]
    sold = per_channel.withColumn("channel_id", F.col("channel_id").cast("long"))
    none = names.withColumns(
        {"n": F.lit(0).cast("long"), "amount": F.lit(0).cast("decimal(24,2)")}
    )
    return (
        sold.join(names, "channel_id")
        .unionByName(none)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("order_count"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias("total_amount"),
        )
        .orderBy(F.desc("total_amount"), "channel_name")
    )


def user_behavior(behavior: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Events per behaviour type, under display names."""
    return (
        behavior.groupBy("behavior_type")
        .agg(F.count(F.lit(1)).alias("value"))
        .select(labelled("behavior_type", labels or BEHAVIOR_LABELS).alias("name"), "value")
        .orderBy(F.desc("value"), "name")
    )


def payment_methods(orders: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Paid orders per payment method. A paid order counts even if cancelled later."""
    return (
        orders.where(F.col("payment_status") == PAID)
        .groupBy("payment_method")
        .agg(F.count(F.lit(1)).alias("value"))
        .select(labelled("payment_method", labels or PAYMENT_LABELS).alias("name"), "value")
        .orderBy(F.desc("value"), "name")
    )


def hot_products(
    details: DataFrame, products: DataFrame, top: int = HOT_PRODUCTS, by_id: bool = False
) -> DataFrame:
    """The products sold most often, best first; ties go to the smaller name.

    Products sharing a name count together unless ``by_id`` is set.
    """
    per_product = details.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    named = per_product.join(
        products.select(F.col("id").alias("product_id"), "product_name"), "product_id"
    )
    keys = ["product_id", "product_name"] if by_id else ["product_name"]
    order = [F.desc("total_quantity"), F.asc("product_name")] + (["product_id"] if by_id else [])
    best = (
        named.groupBy(*keys)
        .agg(F.sum("quantity").alias("total_quantity"))
        .orderBy(*order)
        .limit(top)
    )
    # Only the rows of the report are left here, so numbering them in one task is cheap.
    return best.select(
        F.row_number().over(W.orderBy(*order)).alias("rank"), *keys, "total_quantity"
    )


def member_consumption(
    levels: DataFrame, users: DataFrame, orders: DataFrame, half_open: bool = False
) -> DataFrame:
    """Users and spending per member tier, by each user's total payments.

    Tier bounds are inclusive, so an amount between two tiers, above the last tier or a
    user without orders belongs to none. With ``half_open`` a tier reaches up to the
    start of the next one and the last tier is open. Empty tiers show zeros.
    """
    spend = (
        orders.groupBy(F.col("user_id").alias("id"))
        .agg(money_sum(orders, "payment_amount").alias("spent"))
        .where(F.col("spent").isNotNull())
        .join(users.select("id"), "id", "left_semi")
    )
    tiers = levels.select(F.col("id").alias("tier_id"), "level_name", "min_points", "max_points")
    if half_open:
        # One row per tier, so a single ordered window over them is small by nature.
        following = F.lead("min_points").over(W.orderBy("min_points"))
        highest = F.lit("9999999999999999999999.99").cast("decimal(24,2)")
        upper = F.coalesce(following.cast("decimal(24,2)") - F.lit("0.01").cast("decimal(3,2)"),
                           highest)
        tiers = tiers.withColumn("max_points", upper)
    placed = (
        range_lookup(
            spend, "spent", tiers.select("tier_id", "min_points", "max_points"),
            "min_points", "max_points",
        )
        .groupBy("tier_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("spent").alias("total"))
    )
    return (
        tiers.select("tier_id", "level_name")
        .join(placed, "tier_id", "left")
        .select(
            "tier_id",
            "level_name",
            F.coalesce("n", F.lit(0)).alias("user_count"),
            F.coalesce("total", F.lit(0)).alias("total_amount"),
            F.coalesce(ratio("total", "n", 6), F.lit(0)).alias("avg_amount"),
        )
        .orderBy("tier_id")
        .drop("tier_id")
    )


def share_of_total(
    df: DataFrame,
    name: str = "name",
    value: str = "value",
    threshold: float = 0.0,
    other: str = "Other",
) -> DataFrame:
    """Percentages of the total; two or more slices up to ``threshold`` become one.

    ``threshold`` is a share between 0 and 1. A single small slice keeps its name.
    """
    slices = df.select(F.col(name).alias("name"), F.col(value).alias("value"))
    total = slices.agg(F.sum("value").alias("t")).scalar()
    shares = slices.withColumn("total", total.cast("double")).withColumn(
        "small", F.col("value").cast("double") / F.nullif("total", F.lit(0.0)) <= threshold
    )
    small_slices = shares.agg(F.count_if("small")).scalar()
    folds = F.col("small") & (small_slices > 1)
    return (
        shares.withColumn("folded", F.coalesce(folds, F.lit(False)))
        .withColumn("name", F.when(F.col("folded"), F.lit(other)).otherwise(F.col("name")))
        .groupBy("name", "folded")
        .agg(F.sum("value").alias("value"), F.first("total").alias("total"))
        .select(
            "name",
            "value",
            F.try_divide(F.col("value").cast("double") * 100, F.col("total")).alias("percent"),
        )
        .orderBy(F.desc("value"), "name")
    )
