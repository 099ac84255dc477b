"""Columns and tables that follow from others by rule: amounts, codes, calendars, grids."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.fixed_values import (
    CALENDAR_DAYS,
    COST_SHARE,
    HOLIDAY_REACH_DAYS,
    HOLIDAYS,
    MARKET_SHARE,
    WEEKEND_WEIGHT,
)
from tillmark.functions import Day, as_date, money_sum, order_number, product_code, session_key

MONEY = "decimal(12,2)"


def line_amounts(lines: DataFrame, rate: str = "discount_rate") -> DataFrame:
    """``total_price``, ``discount_price`` and ``actual_price`` from price, quantity and rate.

    Only lines of an order with a campaign are discounted. The discount is rounded to
    cents, ties to the even cent.
    """
    share = F.col(rate)
    if not isinstance(lines.schema[rate].dataType, T.DecimalType):
        share = share.cast("decimal(20,18)")
    total = (F.col("unit_price").cast(MONEY) * F.col("quantity")).cast(MONEY)
    cut = F.when(
        F.col("campaign_id").isNotNull(), F.bround(F.col("total_price") * share, 2)
    )
    return (
        lines.withColumn("total_price", total)
        .withColumn("discount_price", F.coalesce(cut, F.lit(0)).cast(MONEY))
        .withColumn(
            "actual_price", (F.col("total_price") - F.col("discount_price")).cast(MONEY)
        )
    )


def order_totals(details: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Order amounts rolled up from the lines; shipping comes from ``orders`` if given."""
    totals = details.groupBy("order_id").agg(
        money_sum(details, "total_price").alias("total_amount"),
        money_sum(details, "discount_price").alias("discount_amount"),
        money_sum(details, "actual_price").alias("net_amount"),
    )
    if orders is None:
        return totals.withColumnRenamed("net_amount", "payment_amount")
    shipping = orders.select(
        F.col("id").alias("order_id"), F.coalesce("shipping_amount", F.lit(0)).alias("shipping")
    )
    return totals.join(shipping, "order_id").select(
        "order_id",
        "total_amount",
        "discount_amount",
        F.col("shipping").alias("shipping_amount"),
        (F.col("net_amount") + F.col("shipping")).alias("payment_amount"),
    )


def order_lifecycle(orders: DataFrame) -> DataFrame:
    """Payment and delivery state that belong to the order status, and the times due."""
    status = F.col("order_status")
    return orders.withColumns(
        {
            "payment_status": F.when(status == 0, 0).otherwise(1),
            "delivery_status": F.when(status >= 3, 2).when(status == 2, 1).otherwise(0),
            "has_payment_time": status != 0,
            "has_delivery_time": status >= 2,
            "has_complete_time": status >= 3,
        }
    )


def session_id(behavior: DataFrame) -> DataFrame:
    return behavior.withColumn("session_id", session_key("user_id", "create_time"))


def price_ladder(products: DataFrame) -> DataFrame:
    """Cost and market price from the list price."""
    price = F.col("price").cast("decimal(10,2)")

    def share(text: str) -> Column:
        return F.round(price * F.lit(text).cast("decimal(3,1)"), 2).cast("decimal(10,2)")

    return products.withColumns(
        {"cost_price": share(COST_SHARE), "market_price": share(MARKET_SHARE)}
    )


def with_product_code(products: DataFrame, category: str, sequence: str) -> DataFrame:
    return products.withColumn("product_code", product_code(category, sequence))


def with_order_no(orders: DataFrame, sequence: str) -> DataFrame:
    return orders.withColumn("order_no", order_number("create_time", sequence))


def inventory_grid(details: DataFrame, orders: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per product and store it was sold through; pairs that never met are left out."""
    placed = orders.where(F.col("store_id").isNotNull()).select(
        F.col("id").alias("order_id"), "store_id"
    )
    return (
        details.select("order_id", "product_id")
        .join(placed, "order_id")
        .select("product_id", "store_id")
        .distinct()
        .join(stores.select(F.col("id").alias("store_id")), "store_id", "left_semi")
        .select("product_id", "store_id")
    )


def default_addresses(addresses: DataFrame) -> DataFrame:
    """Marks the address with the lowest id of each user as the default.

    The first id is found by a partial aggregate, so only one row per user and task
    is shuffled for it.
    """
    first = addresses.groupBy("user_id").agg(F.min("id").alias("_first"))
    return (
        addresses.join(first, "user_id")
        .withColumn("is_default", F.when(F.col("id") == F.col("_first"), 1).otherwise(0))
        .drop("_first")
    )


def with_default_address(orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Online orders get the default address of their user; others get none."""
    chosen = (
        addresses.where(F.col("is_default") == 1)
        .groupBy("user_id")
        .agg(F.max("id").alias("_address"))
    )
    online = F.col("order_source") == "online"
    return (
        orders.join(chosen, "user_id", "left")
        .withColumn("address_id", F.when(online, F.col("_address")))
        .drop("_address")
    )


def calendar(spark: SparkSession, as_of: Day, days: int = CALENDAR_DAYS) -> DataFrame:
    """``days`` dates ending at ``as_of``."""
    return spark.range(days).select(
        F.date_sub(F.lit(as_date(as_of)), F.col("id").cast("int")).alias("date")
    )


def calendar_weights(
    dates: DataFrame,
    as_of: Day,
    holidays: list[tuple[int, int, float]] | None = None,
    reach: int = HOLIDAY_REACH_DAYS,
) -> DataFrame:
    """Sales weight of each date: weekends and days near a holiday count more.

    Holidays are those of the year of ``as_of``. Each one is spread over the days within
    reach first; the dates then look up their factors by equality. A date near several
    holidays takes the product.
    """
    year = as_date(as_of).year
    days = [(dt.date(year, m, d), float(w)) for m, d, w in (holidays or HOLIDAYS)]
    listed = F.array(
        *[F.struct(F.lit(d).alias("day"), F.lit(w).alias("weight")) for d, w in days]
    )
    spread = (
        dates.sparkSession.range(1)
        .select(F.inline(listed))
        .withColumn("away", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
        .select(
            F.date_add("day", F.col("away")).alias("date"),
            (F.col("weight") / (F.abs("away") + 1)).alias("factor"),
        )
        .groupBy("date")
        .agg(F.product("factor").alias("factor"))
    )
    weekend = F.when(F.weekday("date") >= 5, WEEKEND_WEIGHT).otherwise(1.0)
    return dates.join(spread, "date", "left").withColumn(
        "weight", weekend * F.coalesce("factor", F.lit(1.0))
    ).drop("factor")


def weighted_pick(unit: Column, weights: dict[str, float]) -> Column:
    """One of the names, chosen by a number in (0, 1) in proportion to the weights."""
    total = float(sum(weights.values()))
    reached = 0.0
    names = list(weights)
    choice = None
    for name in names[:-1]:
        reached += weights[name]
        test = unit < reached / total
        choice = F.when(test, name) if choice is None else choice.when(test, name)
    return F.lit(names[-1]) if choice is None else choice.otherwise(names[-1])


def weighted_sample(
    df: DataFrame,
    size: int,
    unit: Column,
    weight: Column | str,
    tie: str,
    by: list[str] | None = None,
) -> DataFrame:
    """``size`` rows per group without replacement, likelier the higher their weight.

    Each row draws ``-ln(u) / weight`` and the smallest draws win, which equals taking
    the largest ``u ** (1 / weight)`` (Efraimidis and Spirakis, 2006). Small samples of groups are
    cut to ``size`` rows on the map side, so a group of any size is shuffled as at most ``size``
    rows per task. Samples without groups, and those above ``MAP_SIDE_ROWS``, go by a threshold:
    draws are counted in a histogram, the bucket in which the sample ends is counted once more in
    finer ones, and only rows up to there are kept, dealt out by bucket, so no task holds more of a
    sample than its share. Rows of weight zero or less are never drawn.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    drawn = df.where(w > 0).withColumn("_draw", -F.ln(unit) / w)
    order = [F.asc("_draw"), F.asc(tie)]
    if by and size <= MAP_SIDE_ROWS:
        rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
        return drawn.withColumn("_rank", rank).where(F.col("_rank") <= size).drop("_rank", "_draw")
    by = by or []
    # Even steps of the draw's logarithm; what has none comes first, as it does in the order.
    step = F.floor(F.ln("_draw") * (1 << _FINE)).cast("long")
    drawn = drawn.withColumn("_step", F.coalesce(step, F.lit(-(1 << 62))))
    wide = F.shiftright("_step", _WITHIN)
    cuts = _cuts(drawn.select(*by, wide.alias("_step")), size, by, None)
    near = _beside(drawn, cuts, by).where(wide == F.col("_cut.step"))
    cuts = _cuts(near.select(*by, "_step", F.col("_cut.before").alias("_above")), size, by, "_above")
    kept = _beside(drawn, cuts, by).where(F.col("_cut").isNull() | (F.col("_step") <= F.col("_cut.step")))
    rank = F.row_number().over(W.partitionBy(*by, "_step").orderBy(*order))
    last = F.col("_step") == F.col("_cut.step")
    return (
        kept.withColumn("_rank", rank)
        .where(F.col("_cut").isNull() | ~last | (F.col("_rank") + F.col("_cut.before") <= size))
        .drop("_rank", "_draw", "_step", "_cut")
    )


# Samples of groups up to this size are cut ahead of the shuffle, as Spark does it by itself up to
# this number of rows (spark.sql.optimizer.windowGroupLimitThreshold).
MAP_SIDE_ROWS = 1000
# Fine steps to a unit of the logarithm, as a power of two, and those within a wide step: a wide one
# holds draws that differ by 1.6 percent at most, and there are under 100,000 in all.
_FINE, _WITHIN = 22, 16


def _cuts(steps: DataFrame, size: int, by: list[str], above: str | None) -> DataFrame:
    """Per group the step in which its ``size`` smallest rows end, and the rows before that step.

    Groups with no more rows than that have none.
    """
    offset = F.min(above) if above else F.lit(0)
    counted = steps.groupBy(*by, "_step").agg(F.count(F.lit(1)).alias("n"), offset.alias("offset"))
    upto = W.partitionBy(*by).orderBy("_step").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(upto), F.lit(0)) + F.col("offset")
    ends = counted.withColumn("before", before).where(
        (F.col("before") <= size) & (F.col("before") + F.col("n") > size)
    )
    return ends.groupBy(*by).agg(F.max(F.struct(F.col("_step").alias("step"), "before")).alias("_cut"))


def _beside(rows: DataFrame, cuts: DataFrame, by: list[str]) -> DataFrame:
    """Rows with the cut of their group, NULL where it has none."""
    if not by:
        return rows.withColumn("_cut", cuts.scalar())
    named = cuts.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_cut")
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    joined = rows.join(named, reduce(lambda a, b: a & b, same), "left")
    return joined.drop(*[f"_by{i}" for i in range(len(by))])
