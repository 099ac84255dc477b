"""Reporting tables over completed orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.fixed_values import COMPLETED
from tillmark.functions import Day, days_between, money_sum, month_key, ratio


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == COMPLETED)


def sales_summary(orders: DataFrame, channels: DataFrame) -> DataFrame:
    """Sales per day and channel; orders without a channel form a group of their own."""
    per_day = (
        completed(orders)
        .groupBy(F.to_date("create_time").alias("sale_date"), "channel_id")
        .agg(
            F.count("id").alias("n"),
            money_sum(orders, "total_amount").alias("total"),
            money_sum(orders, "discount_amount").alias("discount"),
            money_sum(orders, "payment_amount").alias("paid"),
        )
    )
    dims = channels.select(F.col("id").alias("channel_id"), "channel_type", "channel_name")
    return (
        per_day.join(dims, "channel_id", "left")
        .groupBy("sale_date", "channel_type", "channel_name")
        .agg(
            F.sum("n").alias("order_count"),
            F.sum("total").alias("total_sales"),
            F.sum("discount").alias("total_discount"),
            F.sum("paid").alias("actual_sales"),
        )
        .withColumn("avg_order_value", ratio("actual_sales", "order_count"))
        .orderBy(F.desc("sale_date"), F.desc("total_sales"), "channel_name")
    )


def product_sales_ranking(
    details: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    top: int | None = None,
) -> DataFrame:
    """Completed sales per product, best first; with ``top`` only the first ranks, numbered.

    Lines meet their orders on the order id, which also serves the distinct order count:
    its first step groups by product and order and reuses that partitioning. Names join
    last, on one row per product.
    """
    done = completed(orders).select(F.col("id").alias("order_id"))
    per_product = (
        details.select("order_id", "product_id", "quantity", "total_price")
        .join(done, "order_id")
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("total_quantity"),
            money_sum(details, "total_price").alias("total_sales"),
            F.countDistinct("order_id").alias("order_count"),
        )
    )
    named = per_product.join(
        products.select(
            F.col("id").alias("product_id"), "product_name", "product_code", "category_id"
        ),
        "product_id",
    ).join(
        categories.select(F.col("id").alias("category_id"), "category_name"), "category_id"
    )
    out = named.select(
        "product_id",
        "product_name",
        "product_code",
        "category_name",
        "total_quantity",
        "total_sales",
        "order_count",
        ratio("total_sales", "total_quantity").alias("avg_price"),
    )
    order = [F.desc("total_sales"), F.asc("product_id")]
    if top is None:
        return out.orderBy(*order)
    best = out.orderBy(*order).limit(top)
    return best.withColumn("rank", F.rank().over(W.orderBy(F.desc("total_sales")))).orderBy(*order)


def online_offline_comparison(orders: DataFrame) -> DataFrame:
    """Monthly completed sales by order source."""
    return (
        completed(orders)
        .groupBy(month_key("create_time").alias("sale_month"), "order_source")
        .agg(
            F.count("id").alias("order_count"),
            money_sum(orders, "payment_amount").alias("sales_amount"),
            F.countDistinct("user_id").alias("customer_count"),
        )
        .withColumn("avg_order_value", ratio("sales_amount", "order_count"))
        .orderBy(F.desc("sale_month"), "order_source")
    )


def user_purchase_behavior(
    users: DataFrame, orders: DataFrame, channels: DataFrame, as_of: Day
) -> DataFrame:
    """Recency, frequency, spend and channels of every user with a completed order.

    Orders shrink to one row per user, day and channel first. After that a user's group
    is bounded by days times channels, however many orders the user placed.
    """
    per_day = (
        completed(orders)
        .groupBy("user_id", F.to_date("create_time").alias("day"), "channel_id")
        .agg(
            F.count("id").alias("n"),
            money_sum(orders, "payment_amount").alias("paid"),
            F.max("create_time").alias("latest"),
        )
    )
    names = channels.select(F.col("id").alias("channel_id"), "channel_name")
    per_user = (
        per_day.join(names, "channel_id", "left")
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("order_count"),
            F.sum("paid").alias("total_spent"),
            F.max("latest").alias("last_purchase_date"),
            F.collect_set("day").alias("days"),
            F.collect_set("channel_name").alias("names"),
        )
    )
    return (
        per_user.join(
            users.select(F.col("id").alias("user_id"), "username", "nickname"), "user_id"
        )
        .select(
            "user_id",
            "username",
            "nickname",
            "order_count",
            "total_spent",
            "last_purchase_date",
            days_between(as_of, "last_purchase_date").alias("days_since_last_purchase"),
            F.size("days").cast("long").alias("purchase_days"),
            ratio("total_spent", "order_count").alias("avg_order_value"),
            _joined("names").alias("used_channels"),
        )
        .orderBy(F.desc("total_spent"), "user_id")
    )


def _joined(names: str) -> Column:
    return F.when(F.size(names) > 0, F.array_join(F.sort_array(names), ", "))


def campaign_performance(campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Completed sales per campaign; a campaign without any shows zero counts and NULLs."""
    per_campaign = (
        completed(orders)
        .where(F.col("campaign_id").isNotNull())
        .groupBy("campaign_id")
        .agg(
            F.count("id").alias("n"),
            money_sum(orders, "total_amount").alias("gross_sales"),
            money_sum(orders, "discount_amount").alias("total_discount"),
            money_sum(orders, "payment_amount").alias("net_sales"),
            F.countDistinct("user_id").alias("customers"),
        )
    )
    percent = F.try_divide(
        F.col("total_discount").cast("decimal(24,2)") * 100,
        F.col("gross_sales").cast("decimal(24,2)"),
    )
    return (
        campaigns.select(F.col("id").alias("campaign_id"), "campaign_name", "campaign_type")
        .join(per_campaign, "campaign_id", "left")
        .select(
            "campaign_id",
            "campaign_name",
            "campaign_type",
            F.coalesce("n", F.lit(0)).alias("order_count"),
            "gross_sales",
            "total_discount",
            "net_sales",
            F.round(percent, 2).alias("discount_rate_percent"),
            F.coalesce("customers", F.lit(0)).alias("customer_count"),
            ratio("net_sales", "n").alias("avg_order_value"),
        )
        .orderBy(F.desc("net_sales"), "campaign_id")
    )
