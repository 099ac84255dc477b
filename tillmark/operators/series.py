"""Daily sales series and the features a forecast is fitted on.

A series is one row per day. ``series`` names its key column; without one all orders
form a single series. The orders are reduced to days before any window runs, so a
window partition holds at most the days of the history, not the orders of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.fixed_values import HISTORY_DAYS, MIN_HISTORY_DAYS
from tillmark.functions import Day, money_sum, since

LAGS = range(1, 8)
ROLLING = (7, 14)
CALENDAR = ["dayofweek", "month", "day", "is_weekend"]
LAG_COLUMNS = [f"lag_{i}" for i in LAGS]
ROLLING_COLUMNS = [f"rolling_mean_{n}" for n in ROLLING]
NO_KEY = "(none)"
FEATURES = CALENDAR + LAG_COLUMNS + ROLLING_COLUMNS


def _by_day(order: str = "date"):
    return W.partitionBy("series_key").orderBy(order)


def daily_series(
    orders: DataFrame,
    as_of: Day,
    days: int = HISTORY_DAYS,
    series: Column | str | None = None,
) -> DataFrame:
    """Orders and payments per day, from the first to the last day observed.

    Each observed day is stretched up to the day before the next one, and the added
    days carry zeros. That fills the gaps in the same pass, with no calendar join.
    Orders without a key form the series ``(none)``.
    """
    key = F.lit("all") if series is None else (F.col(series) if isinstance(series, str) else series)
    daily = (
        orders.where(since("create_time", as_of, days))
        .groupBy(
            F.coalesce(key.cast("string"), F.lit(NO_KEY)).alias("series_key"),
            F.to_date("create_time").alias("first"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(money_sum(orders, "payment_amount"), F.lit(0)).alias("amount"),
        )
    )
    following = F.lead("first").over(_by_day("first"))
    until = F.coalesce(F.date_sub(following, 1), F.col("first"))
    stretched = daily.withColumn("until", until).withColumn(
        "date", F.explode(F.sequence("first", "until"))
    )
    seen = F.col("date") == F.col("first")
    return stretched.select(
        "series_key",
        "date",
        F.when(seen, F.col("n")).otherwise(F.lit(0)).alias("order_count"),
        F.when(seen, F.col("amount")).otherwise(F.lit(0)).alias("total_amount"),
    )


def region_orders(orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Orders with the ``province`` of their user's first address, for a series per region.

    Orders of users without an address stay, without a province.
    """
    first = addresses.groupBy("user_id").agg(F.min_by("province", "id").alias("province"))
    return orders.join(first, "user_id", "left")


def category_orders(
    orders: DataFrame, details: DataFrame, products: DataFrame, categories: DataFrame, as_of: Day,
    days: int = HISTORY_DAYS,
) -> DataFrame:
    """One row per order and category in it, with the net amount of its lines, for a series per category.

    Only lines of orders since ``days`` days before ``as_of`` are read on; products of no known
    category share none.
    """
    recent = orders.where(since("create_time", as_of, days)).select(
        F.col("id").alias("order_id"), "create_time"
    )
    names = categories.select(F.col("id").alias("category_id"), "category_name")
    kinds = products.select(F.col("id").alias("product_id"), "category_id").join(
        names, "category_id", "left"
    )
    lines = details.join(recent, "order_id").join(kinds.select("product_id", "category_name"), "product_id", "left")
    return lines.groupBy("order_id", "create_time", "category_name").agg(
        money_sum(details, "actual_price").alias("payment_amount")
    )


def calendar_columns(date: Column | str) -> dict[str, Column]:
    """Day of week with Monday as 0, month, day of month and a weekend flag."""
    d = F.col(date) if isinstance(date, str) else date
    return {
        "dayofweek": F.weekday(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "is_weekend": F.when(F.weekday(d) >= 5, 1).otherwise(0),
    }


def calendar_features(series_df: DataFrame) -> DataFrame:
    return series_df.withColumns(calendar_columns("date"))


def lag_features(series_df: DataFrame, value: str = "total_amount") -> DataFrame:
    return series_df.withColumns(
        {f"lag_{i}": F.lag(value, i).over(_by_day()).cast("double") for i in LAGS}
    )


def rolling_features(
    series_df: DataFrame, value: str = "total_amount", mode: str = "clean"
) -> DataFrame:
    """Means over 7 and 14 days, NULL until that many days exist.

    ``legacy`` frames end at the day itself, so the target leaks into its own feature.
    ``clean`` frames end the day before.
    """
    shift = _shift(mode)
    out = {}
    for n in ROLLING:
        frame = _by_day().rowsBetween(-(n - 1) - shift, -shift)
        mean = F.sum(value).over(frame).cast("double") / F.lit(float(n))
        out[f"rolling_mean_{n}"] = F.when(F.count(value).over(frame) == n, mean)
    return series_df.withColumns(out)


def _shift(mode: str) -> int:
    if mode not in ("legacy", "clean"):
        raise ValueError(f"mode must be 'legacy' or 'clean', not {mode!r}")
    return 0 if mode == "legacy" else 1


def feature_frame(series_df: DataFrame, mode: str = "clean") -> DataFrame:
    """Complete feature rows of every series with at least two weeks of days."""
    days = F.count(F.lit(1)).over(W.partitionBy("series_key"))
    full = rolling_features(lag_features(calendar_features(series_df)), mode=mode)
    return (
        full.withColumn("_days", days)
        .where(F.col("_days") >= MIN_HISTORY_DAYS)
        .drop("_days")
        .na.drop(subset=FEATURES)
    )


def standardise(
    features: DataFrame, columns: list[str] | None = None, key: str = "series_key"
) -> DataFrame:
    """Columns scaled to mean 0 and population deviation 1 within each series.

    A column that is constant in a series becomes 0 there.
    """
    w = W.partitionBy(key)
    scaled = {}
    for c in columns or FEATURES:
        spread = F.stddev_pop(c).over(w)
        centred = F.col(c) - F.avg(c).over(w)
        scaled[c] = F.when(spread > 0, centred / spread).otherwise(F.lit(0.0))
    return features.withColumns(scaled)
