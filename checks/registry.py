"""One callable per operator, over the tables of a test directory."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark import session
from tillmark.fixed_values import BEHAVIOR_WEIGHTS, PAYMENT_WEIGHTS
from tillmark.functions import age, hashed_unit, money_sum
from tillmark.operators import (
    dashboard,
    derive,
    directory,
    forecast,
    marts,
    quality,
    series,
    sketches,
    trigrams,
    versions,
)
from tillmark.operators.joins import range_lookup
from tillmark.plans.sync_job import arguments
from tillmark.schemas import SCHEMAS, conform
from tillmark.sources import sync, tables
from tillmark.sources.adapters import MONEY, Retail
from tillmark.streaming.landing import follow_landing

AS_OF = "2001-08-02"
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, for comparison with another engine."""

    def one(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def empties(df: DataFrame, *columns: str) -> DataFrame:
    """Whole-number columns with gaps as doubles, which every client shows alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def query(fn: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.tune(spark)
        return plain(fn(Retail(spark, sf_dir)))

    REGISTRY[fn.__name__] = run
    return fn


# --- dashboard -------------------------------------------------------------------------


@query
def sales_trend(r: Retail) -> DataFrame:
    return dashboard.sales_trend(r.orders(), AS_OF)


@query
def user_distribution(r: Retail) -> DataFrame:
    return dashboard.user_distribution(r.addresses())


@query
def category_sales(r: Retail) -> DataFrame:
    return dashboard.category_sales(r.categories(), r.products(), r.details())


@query
def channel_analysis(r: Retail) -> DataFrame:
    return dashboard.channel_analysis(r.channels(), r.orders())


@query
def user_behavior(r: Retail) -> DataFrame:
    return dashboard.user_behavior(r.behavior())


@query
def payment_methods(r: Retail) -> DataFrame:
    return dashboard.payment_methods(r.orders())


@query
def hot_products(r: Retail) -> DataFrame:
    return dashboard.hot_products(r.details(), r.products())


@query
def member_consumption(r: Retail) -> DataFrame:
    return dashboard.member_consumption(r.levels(), r.users(), r.orders())


@query
def report_order(r: Retail) -> DataFrame:
    """The place of every row in the sorted reports, as they come."""
    reports = {
        "sales_trend": (dashboard.sales_trend(r.orders(), AS_OF), F.date_format("order_date", "yyyy-MM-dd")),
        "user_distribution": (dashboard.user_distribution(r.addresses()), "name"),
        "category_sales": (dashboard.category_sales(r.categories(), r.products(), r.details()), "category_name"),
        "channel_analysis": (dashboard.channel_analysis(r.channels(), r.orders()), "channel_name"),
        "payment_methods": (dashboard.payment_methods(r.orders()), "name"),
        "hot_products": (dashboard.hot_products(r.details(), r.products()), "product_name"),
        "member_consumption": (dashboard.member_consumption(r.levels(), r.users(), r.orders()), "level_name"),
    }
    came = W.orderBy("came")
    return _stacked([
        # Partitions of a sorted result are numbered in its order.
        df.select(F.lit(report).alias("report"), (F.col(c) if isinstance(c, str) else c).alias("label"),
                  F.monotonically_increasing_id().alias("came"))
        .select("report", F.row_number().over(came).alias("position"), "label")
        for report, (df, c) in reports.items()
    ])


@query
def member_consumption_half_open(r: Retail) -> DataFrame:
    return dashboard.member_consumption(r.levels(), r.users(), r.orders(), half_open=True)


@query
def member_tier_lookup(r: Retail) -> DataFrame:
    """Tiers of all users; every third one owes a tenth of a cent more than it spent, every
    fifth one spent a hundred billion times as much."""
    orders = r.orders()
    spend = orders.groupBy("user_id").agg(money_sum(orders, "payment_amount").alias("spent"))
    spent = F.col("spent").cast("decimal(24,3)")
    odd = (
        F.when(F.col("user_id") % 3 == 0, F.lit("-0.001").cast("decimal(4,3)") - spent)
        .when(F.col("user_id") % 5 == 0, spent * F.lit(10**11).cast("decimal(12,0)"))
        .otherwise(spent)
    )
    tiers = r.levels().select(
        "level_name", F.col("min_points").cast("decimal(30,2)").alias("low"),
        F.col("max_points").cast("decimal(30,2)").alias("high"),
    )
    owing = tiers.select(F.concat(F.lit("owes "), "level_name").alias("level_name"),
                         (-F.col("high")).alias("low"), (-F.col("low")).alias("high"))
    rich = tiers.where("low > 0").select(
        F.concat(F.lit("rich "), "level_name").alias("level_name"),
        *[(F.col(c).cast("decimal(12,2)") * F.lit(10**11).cast("decimal(12,0)"))
          .cast("decimal(30,2)").alias(c) for c in ("low", "high")],
    )
    every = tiers.unionByName(owing).unionByName(rich)
    placed = spend.withColumn("spent", odd.cast("decimal(34,3)"))
    return range_lookup(placed, "spent", every, "low", "high").select(
        "user_id", "spent", "level_name"
    )


@query
def hot_products_by_id(r: Retail) -> DataFrame:
    return dashboard.hot_products(r.details(), r.products(), by_id=True)


@query
def share_of_total(r: Retail) -> DataFrame:
    sales = dashboard.category_sales(r.categories(), r.products(), r.details())
    return dashboard.share_of_total(sales, "category_name", "total_sales", threshold=0.165)


# --- marts -----------------------------------------------------------------------------


@query
def view_sales_summary(r: Retail) -> DataFrame:
    return marts.sales_summary(r.orders_with_discounts(), r.channels())


@query
def view_product_sales_ranking(r: Retail) -> DataFrame:
    return marts.product_sales_ranking(r.details(), r.orders(), r.products(), r.categories())


@query
def product_sales_top(r: Retail) -> DataFrame:
    return marts.product_sales_ranking(
        r.details(), r.orders(), r.products(), r.categories(), top=100
    )


@query
def view_online_offline_comparison(r: Retail) -> DataFrame:
    return marts.online_offline_comparison(r.orders())


@query
def view_user_purchase_behavior(r: Retail) -> DataFrame:
    return marts.user_purchase_behavior(r.users(), r.orders(), r.channels(), AS_OF)


@query
def view_campaign_performance(r: Retail) -> DataFrame:
    return marts.campaign_performance(r.campaigns(), r.orders_with_discounts())


# --- forecast --------------------------------------------------------------------------


def _by_channel(r: Retail) -> DataFrame:
    return series.daily_series(r.orders(), AS_OF, series="channel_id")


def _single(r: Retail) -> DataFrame:
    return series.daily_series(r.orders(), AS_OF)


def _weekly_naive(r: Retail) -> DataFrame:
    rows = series.feature_frame(_by_channel(r))
    return rows.withColumns(
        {"actual": F.col("total_amount").cast("double"), "predicted": F.col("lag_7")}
    )


@query
def daily_series(r: Retail) -> DataFrame:
    return _by_channel(r)


@query
def daily_series_by_region(r: Retail) -> DataFrame:
    return series.daily_series(series.region_orders(r.orders(), r.addresses()), AS_OF, series="province")


@query
def daily_series_by_category(r: Retail) -> DataFrame:
    sold = series.category_orders(r.orders(), r.details(), r.products().drop("category_name"), r.categories(), AS_OF)
    return series.daily_series(sold, AS_OF, series="category_name")


@query
def calendar_features(r: Retail) -> DataFrame:
    return series.calendar_features(_by_channel(r)).select("series_key", "date", *series.CALENDAR)


@query
def lag_features(r: Retail) -> DataFrame:
    return series.lag_features(_by_channel(r)).select("series_key", "date", *series.LAG_COLUMNS)


@query
def rolling_features(r: Retail) -> DataFrame:
    return series.rolling_features(_by_channel(r), mode="legacy").select(
        "series_key", "date", *series.ROLLING_COLUMNS
    )


@query
def feature_frame_legacy(r: Retail) -> DataFrame:
    return series.feature_frame(_by_channel(r), "legacy")


@query
def feature_frame_clean(r: Retail) -> DataFrame:
    return series.feature_frame(_by_channel(r), "clean")


@query
def standardise(r: Retail) -> DataFrame:
    scaled = series.standardise(series.feature_frame(_by_channel(r)))
    return scaled.select(
        "series_key", "date", *[F.round(c, 6).alias(c) for c in series.FEATURES]
    )


@query
def fit_metrics(r: Retail) -> DataFrame:
    """The error relative to the square of the mean amount."""
    rows = _weekly_naive(r)
    mean = rows.groupBy("series_key").agg(F.avg("actual").alias("mean"))
    found = forecast.fit_metrics(rows, ["series_key"]).join(mean, "series_key")
    relative = F.col("mse") / F.nullif(F.pow("mean", F.lit(2.0)), F.lit(0.0))
    return found.select(
        "series_key", F.round(relative, 9).alias("mse"), F.round("r2_score", 9).alias("r2_score")
    )


@query
def forecast_accuracy(r: Retail) -> DataFrame:
    found = forecast.fit_metrics(_weekly_naive(r), ["series_key"])
    span = _by_channel(r).groupBy("series_key").agg(
        F.min("total_amount").cast("double").alias("lowest"),
        F.max("total_amount").cast("double").alias("highest"),
    )
    return found.join(span, "series_key").select(
        "series_key", forecast.accuracy("r2_score", "mse", "lowest", "highest").alias("accuracy")
    )


@query
def forecast_weekly_repeat(r: Retail) -> DataFrame:
    return forecast.weekly_repeat(_by_channel(r))


@query
def forecast_growth(r: Retail) -> DataFrame:
    history = _by_channel(r)
    grown = forecast.growth_rate(history, forecast.weekly_repeat(history))
    return grown.select(
        "series_key",
        "history_days",
        F.round("predicted_total", 2).alias("predicted_total"),
        F.round("growth_rate", 6).alias("growth_rate"),
        forecast.verdict("growth_rate").alias("conclusion"),
    )


@query
def forecast_points(r: Retail) -> DataFrame:
    points, _ = forecast.sales_prediction(r.orders(), AS_OF, "linear", "legacy")
    return points.withColumn("predicted", F.round("predicted", 2))


@query
def sales_prediction_linear(r: Retail) -> DataFrame:
    _, report = forecast.sales_prediction(r.orders(), AS_OF, "linear", "legacy")
    return report


@query
def linear_forecast(r: Retail) -> DataFrame:
    """Steps and dates, and how far each step is from what a model on the days before all steps says to
    the days before it; series too short to hold the steps out have no such answer."""
    session.use_checkpoints(r.spark)
    history = _by_channel(r).checkpoint()
    ahead = forecast.linear_forecast(history).checkpoint()
    known = ahead.select(
        "series_key", "date", F.lit(1).cast("long").alias("order_count"),
        F.col("predicted_amount").alias("total_amount"),
    )
    longer = history.withColumn("total_amount", F.col("total_amount").cast("double"))
    again = forecast.linear_fit(longer.unionByName(known), holdout=forecast.FORECAST_DAYS)
    own = again.where("part = 'holdout'").select("series_key", "date", F.greatest(F.lit(0.0), "predicted").alias("own"))
    change = F.abs(F.col("own") - F.col("predicted_amount")) / (1 + F.col("predicted_amount"))
    return ahead.join(own, ["series_key", "date"], "left").select(
        "series_key", "date", "step", F.round(change, 6).alias("change")
    )


@query
def linear_forecast_legacy(r: Retail) -> DataFrame:
    """The model really fitted and stepped; its exact fit makes the result known."""
    ahead = forecast.linear_forecast(_by_channel(r), mode="legacy")
    return ahead.withColumn("predicted_amount", F.round("predicted_amount", 2))


@query
def linear_fit_legacy(r: Retail) -> DataFrame:
    """Fitted and actual days; days held out, which no formula knows, with their actual value."""
    fitted = forecast.linear_fit(_by_channel(r), mode="legacy")
    known = F.when(F.col("part") == "in_sample", F.round("predicted", 2))
    return fitted.withColumns({"actual": F.round("actual", 2), "predicted": known})


@query
def linear_fit(r: Retail) -> DataFrame:
    """What least squares must satisfy: per series the residuals of the fit add up to nothing, by
    themselves and times the newest lag, relative to the amounts. Held-out days are counted."""
    rows = series.feature_frame(_by_channel(r), "clean").select("series_key", "date", "lag_1")
    fitted = forecast.linear_fit(_by_channel(r)).join(rows, ["series_key", "date"])
    gap = F.col("actual") - F.col("predicted")
    size = F.sum(F.abs("actual"))
    inside = F.col("part") == "in_sample"
    return (
        fitted.groupBy("series_key", "part")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("actual"), 6).alias("mean_actual"),
            F.round(F.abs(F.sum(gap)) / (1 + size), 6).alias("gap"),
            F.round(F.abs(F.sum(gap * F.col("lag_1"))) / (1 + F.sqrt(F.sum(F.col("actual") ** 2) * F.sum(F.col("lag_1").cast("double") ** 2))), 6)
            .alias("lag_gap"),
        )
        .withColumns({c: F.when(inside, F.col(c)) for c in ("gap", "lag_gap")})
    )


def _transformed(made: forecast.Prediction, rows: DataFrame) -> DataFrame:
    """What Spark's own model says to feature rows, on the scale of their series."""
    amount = F.col("total_amount").cast("double")
    scale = made.history.groupBy("series_key").agg(
        F.avg(amount).alias("centre"), F.stddev_pop(amount).alias("spread")
    )
    scaled = rows.join(scale, "series_key").withColumn(
        "spread", F.when(F.col("spread") > 0, F.col("spread")).otherwise(1.0)
    )
    amounts = series.LAG_COLUMNS + series.ROLLING_COLUMNS
    scaled = scaled.withColumns(
        {c: (F.col(c).cast("double") - F.col("centre")) / F.col("spread") for c in amounts}
    )
    features = VectorAssembler(inputCols=series.FEATURES, outputCol="features").transform(scaled)
    return made.model.transform(features).withColumn(
        "again", F.col("scaled_prediction") * F.col("spread") + F.col("centre")
    )


@query
def sales_prediction(r: Retail) -> DataFrame:
    """The default forecast's report beside the model's own answers to its training days: errors
    worked out anew, and whether the forest is off on the whole, as a shifted one would be."""
    made = forecast.explained_prediction(r.orders(), AS_OF)
    again = _transformed(made, series.feature_frame(made.history, "legacy"))
    actual = F.col("total_amount").cast("double")
    spread = made.history.groupBy("series_key").agg(
        F.min("total_amount").cast("double").alias("lowest"), F.max("total_amount").cast("double").alias("highest")
    )
    own = again.groupBy("series_key").agg(
        F.count(F.lit(1)).alias("fit_days"), F.avg(actual).alias("mean"), F.avg("again").alias("mean_fitted"),
        F.avg(F.pow(actual - F.col("again"), F.lit(2.0))).alias("own_mse"), F.var_pop(actual).alias("variance"),
    ).withColumn("own_r2", 1 - F.col("own_mse") / F.col("variance")).join(spread, "series_key")
    shown = forecast.accuracy("own_r2", "own_mse", "lowest", "highest")
    return made.report.join(own, "series_key").select(
        "series_key", "status", "prediction_start_index", "model_type", "fit_days",
        F.round("mean", 4).alias("mean_amount"),
        F.round(F.abs(F.col("mse") - F.bround("own_mse", 2)) / (1 + F.col("own_mse")), 9).alias("mse_gap"),
        F.round(F.abs(F.col("r2_score") - F.bround("own_r2", 2)), 2).alias("r2_gap"),
        F.round(F.abs(F.col("accuracy") - shown), 2).alias("accuracy_gap"),
        (F.abs(F.col("mean_fitted") - F.col("mean")) < 0.02 * F.col("mean")).alias("centred"),
    )


def _curve(r: Retail, by: str | None) -> DataFrame:
    """History and steps. Of each step the bounds within which a forest can answer, which only
    averages amounts it was trained on, on the scale of the series; and how far it is from the
    model's own answer to the days before it."""
    made = forecast.explained_prediction(r.orders(), AS_OF, series=by)
    predictions = made.predictions.checkpoint()
    amount = F.col("total_amount").cast("double")
    scale = made.history.groupBy("series_key").agg(
        F.avg(amount).alias("centre"), F.stddev_pop(amount).alias("deviation"), F.max("date").alias("newest")
    ).withColumn("deviation", F.when(F.col("deviation") > 0, F.col("deviation")).otherwise(1.0))
    trained = series.feature_frame(made.history, "legacy").join(scale, "series_key")
    reach = trained.agg(
        F.min((amount - F.col("centre")) / F.col("deviation")).alias("least"),
        F.max((amount - F.col("centre")) / F.col("deviation")).alias("most"),
    )

    def bound(name: str) -> Column:
        value = reach.select(name).scalar() * F.col("deviation") + F.col("centre")
        return F.greatest(F.lit(0.0), value)

    # Days so far and ahead in one series; the first step reads its lags one day too far back.
    days = made.history.select("series_key", "date", amount.alias("total_amount")).unionByName(
        predictions.select("series_key", "date", F.col("predicted_amount").alias("total_amount"))
    )
    w = W.partitionBy("series_key").orderBy("date")
    late = F.col("step") == 0
    lags = {f"lag_{i}": F.when(late, F.lag("total_amount", i + 1).over(w)).otherwise(F.lag("total_amount", i).over(w))
            for i in series.LAGS}
    means = {f"rolling_mean_{n}": F.avg("total_amount").over(w.rowsBetween(-n, -1)) for n in series.ROLLING}
    rows = days.join(predictions.select("series_key", "date", "step"), ["series_key", "date"], "left")
    rows = series.calendar_features(rows.withColumns(lags | means)).where("step IS NOT NULL")
    own = _transformed(made, rows).select(
        "series_key", "date", F.greatest(F.lit(0.0), "again").alias("again")
    )
    ahead = predictions.join(own, ["series_key", "date"]).join(scale, "series_key")
    ahead = ahead.withColumns({"low": bound("least"), "high": bound("most")}).select(
        "series_key", "date", F.lit(None).cast("double").alias("historical"),
        F.round("low", 2).alias("low"), F.round("high", 2).alias("high"),
        F.col("predicted_amount").between(F.col("low") - 0.01, F.col("high") + 0.01).alias("in_range"),
        F.round(F.abs(F.col("again") - F.col("predicted_amount")) / (1 + F.col("again")), 6).alias("gap"),
    )
    past = made.history.select("series_key", "date", amount.alias("historical"))
    return past.unionByName(ahead, allowMissingColumns=True)


@query
def sales_prediction_curve(r: Retail) -> DataFrame:
    return _curve(r, None)


@query
def sales_prediction_by_channel(r: Retail) -> DataFrame:
    return _curve(r, "channel_id")


# --- sources and sync ------------------------------------------------------------------


@query
def full_scan(r: Retail) -> DataFrame:
    return r.raw("orders")


@query
def incremental_scan(r: Retail) -> DataFrame:
    return tables.after_mark(r.raw("orders"), "o_orderdate", "2001-01-01 00:00:00")


@query
def high_water_mark(r: Retail) -> DataFrame:
    return tables.high_water_mark(r.raw("events"), "ts")


@query
def export_roundtrip(r: Retail) -> DataFrame:
    """A full copy, after a second export that fails on the way."""
    base = session.new_dir(r.spark, "roundtrip")
    customer = r.raw("customer")
    sync.export_full(customer, base, "customer")
    name = F.when(F.col("c_acctbal") < 0, F.expr("raise_error('broken off')")).otherwise(F.col("c_name"))
    try:
        sync.export_full(customer.withColumn("c_name", name), base, "customer")
    except Exception as e:
        if "broken off" not in str(e):
            raise
    else:
        raise AssertionError("the second export should have failed")
    return sync.read_synced(r.spark, base, "customer")


@query
def incremental_merge(r: Retail) -> DataFrame:
    base = session.new_dir(r.spark, "merge")
    orders = r.raw("orders")
    early = orders.where(F.col("o_orderdate") <= F.lit("2000-12-31").cast("date"))
    # The first batch has a narrower type and lacks a column that only later rows carry.
    narrow = early.withColumn("o_custkey", F.col("o_custkey").cast("int"))
    first = sync.export_incremental(narrow, base, "orders", "o_orderdate")
    wider = orders.withColumn("o_added", F.lit(1))
    sync.export_incremental(wider, base, "orders", "o_orderdate", first.mark)
    merged = sync.read_synced(r.spark, base, "orders")
    return merged.withColumn("o_added", F.coalesce("o_added", F.lit(0)))


@query
def compacted_merge(r: Retail) -> DataFrame:
    """The newest event per user from batches compacted once, and batches after that."""
    base = session.new_dir(r.spark, "compacted")
    events = r.raw("events")
    ends = events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).agg(F.min("t"), F.max("t"))
    first, last = ends.first()
    mark = sync.Mark()
    for i in range(1, 7):
        cut = F.timestamp_micros(F.lit(first + (last - first) * i // 6)).cast(events.schema["ts"].dataType)
        mark = sync.export_incremental(events.where(F.col("ts") <= cut), base, "events", "ts", mark).mark
        if i == 4:
            sync.compact(r.spark, base, "events", "user_id", "ts", n_buckets=16)
    return sync.read_synced(r.spark, base, "events", "user_id", "ts")


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query
def watermark_columns(r: Retail) -> DataFrame:
    """The column an incremental export of each table would follow, and its rows with a time."""
    found = {"py_user": r.users(), "sales_order": r.orders(), "user_behavior": r.behavior(),
             "sales_detail": r.details()}
    picked = {t: tables.time_column(df.columns) for t, df in found.items()}
    return _stacked([
        df.agg(F.count(picked[t] or F.lit(None)).alias("timed_rows")).select(
            F.lit(t).alias("table_name"), F.lit(picked[t]).cast("string").alias("column_name"),
            "timed_rows",
        )
        for t, df in found.items()
    ])


@query
def export_all(r: Retail) -> DataFrame:
    base = session.new_dir(r.spark, "export")
    names = ["region", "nation", "customer", "orders"]
    done = {d.table: d for d in sync.export_all(r.spark, r.raw, base, names)}
    return _stacked([
        sync.read_synced(r.spark, base, t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"), F.lit(done[t].mode).alias("mode"), "row_count"
        )
        for t in names
    ])


@query
def table_list(r: Retail) -> DataFrame:
    """Tables of a catalogue database, without its views, with their rows."""
    database = f"listed_{uuid.uuid4().hex}"
    place = session.new_dir(r.spark, "listed")
    r.spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    try:
        for name in ("nation", "customer", "orders"):
            path = f"{r.base}/{name}.parquet"
            r.spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{path}'")
        r.spark.sql(f"CREATE VIEW {database}.rich AS SELECT * FROM {database}.customer WHERE c_acctbal > 0")
        listed = tables.list_tables(r.spark, database)
    finally:
        r.spark.sql(f"DROP DATABASE {database} CASCADE")
    return _stacked([
        r.raw(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in listed
    ])


@query
def run_modes(r: Retail) -> DataFrame:
    """Rows exported by a second run of the sync job in each of its modes."""
    parts = []
    for flag in ("", "--full", "--hook"):
        args = arguments(["--url", "jdbc:none", "--base", "none", *flag.split()])
        base = session.new_dir(r.spark, "modes")
        incremental = not (args.full or args.hook)
        for _ in range(2):
            done = sync.sync_all(r.spark, lambda _: r.behavior(), base, ["user_behavior"], incremental)
        held = sync.read_synced(r.spark, base, "user_behavior").agg(F.count(F.lit(1)).alias("held_rows"))
        parts.append(held.select(
            F.lit(flag).alias("flag"), F.lit(done[0].mode).alias("mode"),
            F.lit(done[0].rows).cast("long").alias("second_run_rows"), "held_rows",
        ))
    return _stacked(parts)


@query
def sync_all(r: Retail) -> DataFrame:
    base = session.new_dir(r.spark, "sync")
    source = {
        "py_user": r.users, "sales_order": r.orders, "user_behavior": r.behavior
    }
    for _ in range(2):
        sync.sync_all(r.spark, lambda t: source[t](), base, source)
    marks = sync.load_marks(r.spark, base)
    counts = [
        sync.read_synced(r.spark, base, t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"),
            "row_count",
            F.lit(marks[t].mark).cast("string").alias("mark"),
        )
        for t in source
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def bulk_insert(r: Retail) -> DataFrame:
    path = session.new_dir(r.spark, "insert")
    orders = r.raw("orders")
    tables.replace_rows(orders.where("o_orderstatus = 'F'"), path)
    tables.append_rows(orders.where("o_orderstatus <> 'F'"), path)
    return r.spark.read.parquet(path)


@query
def truncate_load(r: Retail) -> DataFrame:
    path = session.new_dir(r.spark, "truncate")
    events = r.raw("events")
    tables.append_rows(events, path)
    tables.replace_rows(events, path)
    return r.spark.read.parquet(path)


@query
def type_mapping(r: Retail) -> DataFrame:
    text = r.orders().select(
        "*", F.concat(F.lit("NO"), F.col("id").cast("string")).alias("order_no")
    )
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    # Methods in place of channel numbers: text that does not fit the type.
    text = text.withColumn("channel_id", F.coalesce("channel_id", "payment_method"))
    fitted = conform(text, SCHEMAS["sales_order"])
    out = fitted.select(
        "id", "order_no", "user_id", "channel_id", "payment_amount", "create_time", "store_id",
        F.array_join("invalid_columns", ",").alias("invalid_columns"),
    )
    return empties(out, "channel_id", "store_id")


@query
def latest_version(r: Retail) -> DataFrame:
    return versions.latest_version(r.raw("events"), "user_id", "ts")


@query
def sketched_customers(r: Retail) -> DataFrame:
    """Customers per channel and month, per channel and in all: exact, and whether the estimate from
    the stored daily sketches lies within its bound."""
    orders = r.orders().select("channel_id", "user_id", "create_time")
    path = session.new_dir(r.spark, "sketches")
    sketches.store_days(sketches.daily_sketches(orders, "user_id", "create_time", ["channel_id"]), path)
    days = sketches.read_days(r.spark, path)
    timed = orders.where("create_time IS NOT NULL")
    nothing = F.lit(None).cast("string")

    def counted(df: DataFrame, day: str, count: Column, period: str) -> list[DataFrame]:
        month = df.withColumn("month", F.date_format(day, "yyyy-MM"))
        parts = [
            month.groupBy("channel_id", "month").agg(count.alias("n")).withColumn("period", F.lit("month")),
            df.groupBy("channel_id").agg(count.alias("n")).withColumns({"month": nothing, "period": F.lit("all")}),
            df.agg(count.alias("n")).withColumns(
                {"channel_id": F.lit(None).cast("long"), "month": nothing, "period": F.lit("total")}),
        ]
        keys = ["period", F.col("channel_id").cast("long").alias("channel_id"), "month"]
        return [p.select(*keys, F.col("n").alias(period)) for p in parts]

    exact = _stacked(counted(timed, "create_time", F.count_distinct("user_id"), "customer_count"))
    estimate = _stacked(counted(days, sketches.DAY, sketches.distinct_count(), "estimate"))
    both = exact.unionByName(estimate, allowMissingColumns=True).groupBy("period", "channel_id", "month").agg(
        F.max("customer_count").alias("customer_count"), F.max("estimate").alias("estimate")
    )
    gap = F.abs(F.col("estimate") - F.col("customer_count"))
    return empties(both.select(
        F.when(F.col("period") == "total", "all").otherwise(F.col("period")).alias("period"),
        "channel_id", "month", "customer_count",
        (gap <= sketches.error_bound() * F.col("customer_count")).alias("within_bound"),
    ), "channel_id")


@query
def landing_stream(r: Retail) -> DataFrame:
    base = session.new_dir(r.spark, "stream")
    schema = r.raw("events").schema
    follow_landing(
        r.spark, r.base, schema, base, "events", f"{base}/offsets", glob="events.parquet"
    )
    return sync.read_synced(r.spark, base, "events", "user_id", "ts")


# --- directory -------------------------------------------------------------------------


def _overdrawn(r: Retail) -> DataFrame:
    return r.raw("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))


def _newcomers(r: Retail) -> DataFrame:
    """Suppliers under their own names, and customers of one segment once more."""
    suppliers = r.raw("supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("id"),
        F.col("s_name").alias("username"),
        F.lit("supplier").alias("nickname"),
    )
    again = r.raw("customer").where("c_mktsegment = 'BUILDING'").select(
        (F.col("c_custkey") + 2_000_000_000).alias("id"),
        F.col("c_name").alias("username"),
        F.lit("again").alias("nickname"),
    )
    twice = r.raw("supplier").where("s_acctbal < 0").select(
        (F.col("s_suppkey") + 3_000_000_000).alias("id"),
        F.col("s_name").alias("username"),
        F.lit("twice").alias("nickname"),
    )
    return suppliers.unionByName(again).unionByName(twice)


@query
def user_search_page(r: Retail) -> DataFrame:
    return directory.user_search_page(r.users(), username=" customer#0000001 ", page=2)


@query
def user_search_trigrams(r: Retail) -> DataFrame:
    """Users that hold each of some needles, through postings where these have three letters."""
    users = r.users().select("id", "username")
    path = session.new_dir(r.spark, "postings")
    trigrams.write_postings(trigrams.postings(users, "id", "username"), path)
    index = r.spark.read.parquet(path)
    return _stacked([
        trigrams.find(users, "id", "username", index, needle).select(F.lit(needle).alias("needle"), "id")
        for needle in ("MER#00000012", "00%77", "omer%0_9", "99")
    ])


@query
def user_search_after(r: Retail) -> DataFrame:
    return directory.user_search_after(r.users(), last_id=1000)


@query
def user_age(r: Retail) -> DataFrame:
    """Ages, taking the day of a user's first order for a birthday."""
    first = r.orders().groupBy("user_id").agg(
        F.min(F.to_date("create_time")).cast("string").alias("birthday")
    )
    return first.select("user_id", "birthday", age("birthday", AS_OF).alias("age"))


@query
def user_by_id(r: Retail) -> DataFrame:
    return directory.user_by_id(r.users(), 42)


@query
def user_by_name(r: Retail) -> DataFrame:
    return directory.user_by_name(r.users(), "Customer#000000042")


@query
def name_conflicts(r: Retail) -> DataFrame:
    return directory.name_conflicts(r.users(), _newcomers(r))


@query
def registration_check(r: Retail) -> DataFrame:
    customer = r.raw("customer")
    free = F.concat(F.lit("New"), "c_name")
    requests = customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 3 == 0, free).otherwise(F.upper("c_name")).alias("username"),
        F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_name")).alias("password"),
        F.when(F.col("c_acctbal") < 0, "other").otherwise(F.col("c_name")).alias(
            "confirm_password"
        ),
    )
    checked = directory.registration_check(r.users(), requests, ignore_case=True)
    return checked.select("id", "reject_reason")


@query
def apply_inserts(r: Retail) -> DataFrame:
    nameless = r.raw("supplier").select(
        (F.col("s_suppkey") + 4_000_000_000).alias("id"),
        F.lit(None).cast("string").alias("username"), F.lit("nameless").alias("nickname"),
    )
    return directory.apply_inserts(r.users(), _newcomers(r).unionByName(nameless))


@query
def apply_updates(r: Retail) -> DataFrame:
    changes = r.raw("customer").where("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.lit("X")).alias("nickname"),
        F.lit("secret").alias("password"), F.lit(2).alias("at"),
    )
    earlier = changes.withColumns({"nickname": F.lit("overtaken"), "at": F.lit(1)})
    return directory.apply_updates(r.users(), changes.unionByName(earlier), "at")


@query
def apply_deletes(r: Retail) -> DataFrame:
    return directory.apply_deletes(r.users(), _overdrawn(r))


@query
def cascade_delete(r: Retail) -> DataFrame:
    before = {
        "py_user": r.users(),
        "user_address": r.addresses(),
        "user_behavior": r.behavior(),
        "sales_order": r.orders(),
        "sales_detail": r.details(),
    }
    after = directory.cascade_delete(before, "py_user", _overdrawn(r))
    key = {"sales_detail": "order_id"}
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(key.get(t, "id")).alias("key_sum")
        ).withColumn("table_name", F.lit(t))
        for t, df in after.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def cascade_set_null(r: Retail) -> DataFrame:
    before = {
        "sales_channel": r.channels(),
        "sales_order": r.orders().select("id", "user_id", "channel_id"),
    }
    closed = r.channels().where("channel_name = 'App'")
    left = directory.cascade_delete(before, "sales_channel", closed)
    return empties(left["sales_order"], "channel_id")


# --- quality ---------------------------------------------------------------------------


@query
def orphans(r: Retail) -> DataFrame:
    """Lines of every seventh product point at orders that do not exist."""
    lost = F.when(F.col("product_id") % 7 == 0, F.col("order_id") + 1_000_000_000)
    details = r.details().withColumn("order_id", F.coalesce(lost, "order_id"))
    return quality.orphans(details, r.orders(), "order_id")


@query
def duplicates(r: Retail) -> DataFrame:
    return quality.duplicates(r.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def null_violations(r: Retail) -> DataFrame:
    return quality.null_violations(
        r.orders(), ["id", "user_id", "channel_id", "campaign_id", "payment_amount"]
    )


@query
def order_total_mismatch(r: Retail) -> DataFrame:
    orders = r.orders().withColumns(
        {
            "total_amount": F.col("payment_amount"),
            "discount_amount": F.lit(0).cast(MONEY),
            "shipping_amount": F.lit(0).cast(MONEY),
        }
    )
    return quality.order_total_mismatch(orders, r.details())


# --- derived ---------------------------------------------------------------------------


@query
def order_totals(r: Retail) -> DataFrame:
    orders = r.orders().select(
        "id", F.when(F.col("order_source") == "online", 10).cast(MONEY).alias("shipping_amount")
    )
    return derive.order_totals(r.details(), orders)


@query
def line_amounts(r: Retail) -> DataFrame:
    campaign = F.col("l_orderkey") % 10 < 3
    lines = r.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_rate"),
        F.when(campaign, 1).alias("campaign_id"),
    )
    prices = r.products().select(
        F.col("id").alias("product_id"), F.col("price").alias("unit_price")
    )
    return empties(derive.line_amounts(lines.join(prices, "product_id")), "campaign_id")


@query
def calendar_weights(r: Retail) -> DataFrame:
    days = r.orders().groupBy(F.to_date("create_time").alias("date")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    return derive.calendar_weights(days, AS_OF)


@query
def order_lifecycle(r: Retail) -> DataFrame:
    return derive.order_lifecycle(r.orders().select("id", "order_status"))


@query
def session_id(r: Retail) -> DataFrame:
    return derive.session_id(r.behavior()).select("id", "session_id")


@query
def price_ladder(r: Retail) -> DataFrame:
    return derive.price_ladder(r.products()).select("id", "price", "cost_price", "market_price")


@query
def product_code(r: Retail) -> DataFrame:
    return derive.with_product_code(r.products(), "category_name", "id").select(
        "id", "product_code"
    )


@query
def order_no(r: Retail) -> DataFrame:
    return derive.with_order_no(r.orders(), "id").select("id", "order_no")


@query
def inventory_grid(r: Retail) -> DataFrame:
    """Products and stores that met in an order; the order's channel stands for its store."""
    orders = r.orders().withColumn("store_id", F.col("channel_id").cast("int"))
    return derive.inventory_grid(r.details(), orders, r.stores())


def _delivery_addresses(r: Retail) -> DataFrame:
    """Each order counts as one address its user has had something sent to."""
    return r.orders().select("id", "user_id")


@query
def default_address(r: Retail) -> DataFrame:
    return derive.default_addresses(_delivery_addresses(r))


@query
def order_default_address(r: Retail) -> DataFrame:
    marked = derive.default_addresses(_delivery_addresses(r))
    orders = r.orders().select("id", "user_id", "order_source")
    return empties(derive.with_default_address(orders, marked), "address_id")


@query
def weighted_pick(r: Retail) -> DataFrame:
    picked = derive.weighted_pick(hashed_unit("id", seed=7), PAYMENT_WEIGHTS)
    return r.orders().groupBy(picked.alias("payment_method")).agg(
        F.count(F.lit(1)).alias("order_count")
    )


@query
def weighted_sample(r: Retail) -> DataFrame:
    weight = F.coalesce(
        F.create_map(*[F.lit(x) for p in BEHAVIOR_WEIGHTS.items() for x in p])[
            F.col("behavior_type")
        ],
        F.lit(1),
    )
    rows = r.behavior().withColumn("day", F.to_date("create_time"))
    return derive.weighted_sample(
        rows, 20, hashed_unit("id", seed=42), weight, tie="id", by=["day"]
    )
