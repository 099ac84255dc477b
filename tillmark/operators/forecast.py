"""Sales forecasts for many series in one job.

``legacy`` mode reproduces the published dashboard numbers, including two flaws: the
rolling means contain the target day, and the first step reads its lags one day too far
back. ``clean`` mode has neither and adds an error measured on days held out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.fixed_values import (
    FORECAST_DAYS,
    GROWTH_VERDICT_ELSE,
    GROWTH_VERDICTS,
    HISTORY_DAYS,
    MIN_HISTORY_DAYS,
    NO_FORECAST_VERDICT,
)
from tillmark.functions import Day, clamp
from tillmark.operators.series import (
    FEATURES,
    LAG_COLUMNS,
    LAGS,
    ROLLING,
    ROLLING_COLUMNS,
    daily_series,
    feature_frame,
)
from tillmark.session import new_dir, use_checkpoints

# Executors get the functions below with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOLDOUT_DAYS = 14
MEMORY = max(ROLLING)
METRICS = "series_key string, mse double, r2_score double"
PREDICTION = "series_key string, date date, step int, predicted_amount double"


def _newest_first():
    return W.partitionBy("series_key").orderBy(F.desc("date"))


def _long_enough(series_df: DataFrame, days: int = MIN_HISTORY_DAYS) -> DataFrame:
    n = F.count(F.lit(1)).over(W.partitionBy("series_key"))
    return series_df.withColumn("_n", n).where(F.col("_n") >= days).drop("_n")


def _nothing(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


# --- linear ----------------------------------------------------------------------------


# From so many days on the legacy fit is the only exact one.
REPEAT_DAYS = 27


def weekly_repeat(series_df: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    """The legacy linear forecast in closed form, for series of 27 days or more.

    With the leak, ``y = 7 * rolling_mean_7 - (lag_1 + ... + lag_6)`` fits every training
    row exactly, and stepping it forward repeats the last days: step 0 is the newest day,
    step i of each week the day ``7 - i`` from the end. Shorter series have other exact fits,
    so they get no row here; ``linear_forecast`` fits them.
    """
    ranked = _long_enough(series_df, REPEAT_DAYS).withColumn("k", F.row_number().over(_newest_first()))
    newest = F.max("date").over(W.partitionBy("series_key"))
    source_day = "CASE WHEN i % 7 = 0 THEN 1 ELSE 7 - i % 7 END"
    steps = F.expr(f"filter(sequence(0, {days - 1}), i -> {source_day} = k)")
    return (
        ranked.withColumn("newest", newest)
        .where(F.col("k") <= 7)
        .withColumn("step", F.explode(steps))
        .select(
            "series_key",
            F.date_add("newest", F.col("step") + 1).alias("date"),
            "step",
            F.greatest(F.lit(0.0), F.col("total_amount").cast("double")).alias("predicted_amount"),
        )
    )


def _calendar_matrix(dates: pd.Series) -> np.ndarray:
    week = dates.dt.dayofweek
    return np.column_stack([week, dates.dt.month, dates.dt.day, (week >= 5).astype(int)])


def _next_row(recent: np.ndarray, calendar: np.ndarray, late: bool) -> np.ndarray:
    """Features of the day after ``recent``; ``late`` takes the lags one day too far back."""
    first = 2 if late else 1
    lags = [recent[-(j + first - 1)] for j in LAGS]
    return np.concatenate([calendar, lags, [recent[-n:].mean() for n in ROLLING]])


def _fit(x: np.ndarray, y: np.ndarray):
    """Least squares on standardised columns; returns a function of raw feature rows."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1.0
    scaled = (x - mean) / spread
    # In clean mode the weekly mean is, but for rounding, that of the seven lags: that
    # direction is left out.
    weights, *_ = np.linalg.lstsq(scaled, y - y.mean(), rcond=1e-7)
    return lambda rows: (np.atleast_2d(rows) - mean) / spread @ weights + y.mean()


def _training_rows(
    dates: pd.Series, amounts: np.ndarray, mode: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and amounts of the days that have a full past, and which days these are."""
    shift = 0 if mode == "legacy" else 1
    first = MEMORY - 1 + shift
    at = np.arange(first, len(amounts))
    lags = [amounts[at - i] for i in LAGS]
    means = [
        np.lib.stride_tricks.sliding_window_view(amounts, n).mean(axis=1)[at - shift - n + 1]
        for n in ROLLING
    ]
    x = np.column_stack([_calendar_matrix(dates)[at], *lags, *means]).astype(float)
    return x, amounts[at], at


def _ahead(dates: pd.Series, amounts: np.ndarray, days: int, mode: str) -> tuple[pd.Series, np.ndarray]:
    x, y, _ = _training_rows(dates, amounts, mode)
    predict = _fit(x, y)
    coming = pd.Series(pd.date_range(dates.iloc[-1], periods=days + 1)[1:])
    calendar = _calendar_matrix(coming)
    values = amounts
    for i in range(days):
        row = _next_row(values[-MEMORY:], calendar[i], late=(mode == "legacy" and i == 0))
        values = np.append(values, max(0.0, float(predict(row)[0])))
    return coming, values[-days:]


def _fitted(dates: pd.Series, amounts: np.ndarray, mode: str, holdout: int) -> Iterator[tuple]:
    """(part, days, actual, predicted) in sample, and held out where enough rows are left."""
    x, y, at = _training_rows(dates, amounts, mode)
    yield "in_sample", dates.iloc[at], y, _fit(x, y)(x)
    if len(y) > 2 * holdout:
        model = _fit(x[:-holdout], y[:-holdout])
        yield "holdout", dates.iloc[at[-holdout:]], y[-holdout:], model(x[-holdout:])


def _histories(series_df: DataFrame, need: int) -> DataFrame:
    """One row per series of at least ``need`` days, its amounts in order of days.

    A history is bounded by its days (90 as the dashboard has it): less to send than the sums of
    products that a fit would need in its place.
    """
    day = F.struct("date", F.col("total_amount").cast("double").alias("amount"))
    ordered = F.sort_array(F.collect_list(day))
    rows = series_df.groupBy("series_key").agg(ordered.alias("days")).where(F.size("days") >= need)
    return rows.select("series_key", F.col("days.date").alias("dates"), F.col("days.amount").alias("amounts"))


def _per_series(batches, make) -> Iterator[pd.DataFrame]:
    """What ``make(key, dates, amounts)`` gives for every series of a batch, as one frame."""
    for batch in batches:
        frames = [
            frame
            for key, dates, amounts in zip(batch["series_key"], batch["dates"], batch["amounts"])
            for frame in make(key, pd.Series(pd.to_datetime(dates)), np.array(amounts, float))
        ]
        if frames:
            yield pd.concat(frames)


def linear_forecast(
    series_df: DataFrame, days: int = FORECAST_DAYS, mode: str = "clean"
) -> DataFrame:
    """One least-squares model per series, stepped forward day by day.

    Series reach Python as one row each, many at a time.
    """
    def steps(key, dates, amounts):
        coming, values = _ahead(dates, amounts, days, mode)
        yield pd.DataFrame(
            {"series_key": key, "date": coming.dt.date, "step": np.arange(days, dtype="int32"),
             "predicted_amount": values}
        )

    need = MIN_HISTORY_DAYS if mode == "legacy" else MIN_HISTORY_DAYS + 1
    return _histories(series_df, need).mapInPandas(lambda b: _per_series(b, steps), PREDICTION)


def linear_fit(
    series_df: DataFrame, mode: str = "clean", holdout: int = HOLDOUT_DAYS
) -> DataFrame:
    """Fitted values of the linear model, in sample and for the days held out.

    ``part`` is ``in_sample`` for the model on all rows and ``holdout`` for the last
    ``holdout`` rows under a model that has not seen them.
    """
    def parts(key, dates, amounts):
        for part, at, actual, predicted in _fitted(dates, amounts, mode, holdout):
            yield pd.DataFrame(
                {"series_key": key, "date": at.dt.date, "part": part, "actual": actual,
                 "predicted": predicted}
            )

    need = MIN_HISTORY_DAYS if mode == "legacy" else MIN_HISTORY_DAYS + 1
    return _histories(series_df, need).mapInPandas(
        lambda b: _per_series(b, parts),
        "series_key string, date date, part string, actual double, predicted double",
    )


# --- forest ----------------------------------------------------------------------------

_AMOUNT_FEATURES = LAG_COLUMNS + ROLLING_COLUMNS
# Depth of the trees for many series, and of those the dashboard grows on its one series.
DEPTH, ONE_SERIES_DEPTH = 12, 30


def _scales(series_df: DataFrame) -> DataFrame:
    """Mean and deviation of each series; one row per series."""
    amount = F.col("total_amount").cast("double")
    return series_df.groupBy("series_key").agg(
        F.avg(amount).alias("centre"),
        F.when(F.stddev_pop(amount) > 0, F.stddev_pop(amount)).otherwise(1.0).alias("spread"),
    )


def _scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c).cast("double") - F.col("centre")) / F.col("spread") for c in columns}
    )


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def fit_forest(
    series_df: DataFrame,
    mode: str = "legacy",
    trees: int = 100,
    depth: int = DEPTH,
    bins: int = 128,
    seed: int = 42,
) -> RandomForestRegressionModel:
    """One forest trained by Spark on the rows of all series, each on its own scale.

    All rows are trained on. ``depth`` bounds the model, which is sent to every executor: trees of
    depth 12 have 8,191 nodes at most, whatever the number of series. ``bins`` is a parameter of the
    model: a feature is split at 127 places at most, which are all there are for one history of
    90 days and quantiles where many series meet, so a series may be fitted differently
    beside others than alone.
    """
    # The key order fixes which rows a tree's bootstrap draws, so a rerun agrees.
    rows = _scaled(
        feature_frame(series_df, mode).join(_scales(series_df), "series_key"),
        ["total_amount", *_AMOUNT_FEATURES],
    ).sort("series_key", "date")
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="total_amount",
        predictionCol="scaled_prediction",
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        featureSubsetStrategy="all",
        seed=seed,
    )
    return forest.fit(_assembled(rows).select("features", "total_amount"))


def forest_fit(
    series_df: DataFrame, model: RandomForestRegressionModel, mode: str = "legacy"
) -> DataFrame:
    """Fitted values of the forest on its training rows."""
    rows = feature_frame(series_df, mode).join(_scales(series_df), "series_key")
    scored = model.transform(
        _assembled(
            _scaled(rows.withColumn("actual", F.col("total_amount").cast("double")),
                    _AMOUNT_FEATURES)
        )
    )
    return scored.select(
        "series_key",
        "date",
        F.lit("in_sample").alias("part"),
        "actual",
        (F.col("scaled_prediction") * F.col("spread") + F.col("centre")).alias("predicted"),
    )


def forest_nodes(model: RandomForestRegressionModel) -> DataFrame:
    """The nodes of a forest: tree, node, feature (-1 for a leaf), threshold, children and value.

    This is what saving the model writes; all features are numbers, so a node has one threshold.
    """
    spark = SparkSession.active()
    path = new_dir(spark, "forest")
    model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        split["featureIndex"].alias("feature"),
        F.coalesce(F.get(split["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("threshold"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["prediction"].alias("value"),
    )


def _node_tables(model: RandomForestRegressionModel) -> list[tuple[np.ndarray, ...]]:
    """Every tree as arrays by node number: feature, threshold, left and right child, value.

    As large as the model, which its depth and number of trees bound.
    """
    nodes = forest_nodes(model).toPandas().sort_values(["tree", "node"])
    kinds = {"feature": "i4", "threshold": "f8", "left": "i4", "right": "i4", "value": "f8"}
    return [
        tuple(tree[c].to_numpy(k) for c, k in kinds.items()) for _, tree in nodes.groupby("tree")
    ]


def _predicted(trees: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    """The mean of all trees' values for every row of ``x``."""
    total = np.zeros(len(x))
    for feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), np.int64)
        inner = np.flatnonzero(feature[at] >= 0)
        while len(inner):
            node = at[inner]
            low = x[inner, feature[node]] <= threshold[node]
            at[inner] = np.where(low, left[node], right[node])
            inner = inner[feature[at[inner]] >= 0]
        total += value[at]
    return total / len(trees)


def forest_forecast(
    series_df: DataFrame,
    model: RandomForestRegressionModel,
    days: int = FORECAST_DAYS,
    mode: str = "legacy",
) -> DataFrame:
    """Step the forest forward, all days in one pass over one row per series.

    A row holds the last 14 amounts of its series; a batch of rows is stepped at once. The model's
    nodes are sent once.
    """
    by_date = F.array_sort(F.collect_list(F.struct("date", "scaled")))
    scaled = (F.col("total_amount").cast("double") - F.col("centre")) / F.col("spread")
    state = (
        _long_enough(series_df)
        .withColumn("k", F.row_number().over(_newest_first()))
        .where(F.col("k") <= MEMORY)
        .join(_scales(series_df), "series_key")
        .withColumn("scaled", scaled)
        .groupBy("series_key", "centre", "spread")
        .agg(by_date["scaled"].alias("recent"), F.max("date").alias("newest"))
    )
    sent = series_df.sparkSession.sparkContext.broadcast(_node_tables(model))

    def step(batches):
        for batch in batches:
            if not len(batch):
                continue
            values = np.array(batch["recent"].tolist())
            floor = (-batch["centre"] / batch["spread"]).to_numpy()
            newest = pd.to_datetime(batch["newest"])
            for i in range(days):
                calendar = _calendar_matrix(newest + pd.Timedelta(days=i + 1))
                late = 1 if mode == "legacy" and i == 0 else 0
                recent = values[:, -MEMORY:]
                lags = [recent[:, -(j + late)] for j in LAGS]
                means = [recent[:, -n:].sum(axis=1) / n for n in ROLLING]
                x = np.column_stack([calendar, *lags, *means]).astype(float)
                values = np.column_stack([values, np.maximum(floor, _predicted(sent.value, x))])
            ahead = values[:, -days:] * batch["spread"].to_numpy()[:, None]
            ahead = np.maximum(0.0, ahead + batch["centre"].to_numpy()[:, None])
            yield pd.DataFrame(
                {
                    "series_key": np.repeat(batch["series_key"].to_numpy(), days),
                    "date": [
                        (d + pd.Timedelta(days=i + 1)).date() for d in newest for i in range(days)
                    ],
                    "step": np.tile(np.arange(days, dtype="int32"), len(batch)),
                    "predicted_amount": ahead.ravel(),
                }
            )

    return state.mapInPandas(step, PREDICTION)


# --- evaluation and report -------------------------------------------------------------


def fit_metrics(
    fitted: DataFrame, by: list[str], actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Mean squared error and R² per group.

    For constant actual values R² is 1 if the fit is exact and 0 otherwise.
    """
    error = F.pow(F.col(actual) - F.col(predicted), 2)
    grouped = fitted.groupBy(*by).agg(
        F.sum(error).alias("sse"),
        F.var_pop(actual).alias("variance"),
        F.count(F.lit(1)).alias("n"),
    )
    r2 = F.when(
        F.col("variance") > 0, 1 - F.col("sse") / (F.col("variance") * F.col("n"))
    ).otherwise(F.when(F.col("sse") == 0, 1.0).otherwise(0.0))
    return grouped.select(*by, (F.col("sse") / F.col("n")).alias("mse"), r2.alias("r2_score"))


def growth_rate(history: DataFrame, predictions: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    """Predicted total against the last ``days`` actual days, in percent.

    0 when the history is shorter than that or its total is not positive.
    """
    past = history.select(
        "series_key", "total_amount", F.row_number().over(_newest_first()).alias("k")
    )
    ahead = predictions.select("series_key", "predicted_amount")
    totals = (
        past.unionByName(ahead, allowMissingColumns=True)
        .groupBy("series_key")
        .agg(
            F.sum(F.when(F.col("k") <= days, F.col("total_amount")))
            .cast("double")
            .alias("previous"),
            F.count("k").alias("history_days"),
            F.min("total_amount").cast("double").alias("lowest"),
            F.max("total_amount").cast("double").alias("highest"),
            F.sum("predicted_amount").alias("predicted_total"),
        )
    )
    grows = (F.col("history_days") >= days) & (F.col("previous") > 0)
    rate = (F.col("predicted_total") - F.col("previous")) / F.col("previous") * 100
    return totals.select(
        "series_key",
        "history_days",
        "lowest",
        "highest",
        "predicted_total",
        F.when(F.col("predicted_total").isNull(), None)
        .when(grows, rate)
        .otherwise(0.0)
        .alias("growth_rate"),
    )


def verdict(rate: Column | str) -> Column:
    c = F.col(rate) if isinstance(rate, str) else rate
    out = F.when(c.isNull(), F.lit(NO_FORECAST_VERDICT))
    for bound, text in GROWTH_VERDICTS:
        out = out.when(c > bound, F.lit(text))
    return out.otherwise(F.lit(GROWTH_VERDICT_ELSE))


def accuracy(r2: str, mse: str, lowest: str, highest: str) -> Column:
    """Percent in 0 to 100, from R² where positive, else from the error over the range."""
    spread = F.pow(F.col(highest) - F.col(lowest), 2)
    by_range = F.coalesce(100 * (1 - F.try_divide(F.col(mse), spread)), F.lit(0.0))
    chosen = F.when(F.col(r2) > 0, 100 * F.col(r2)).otherwise(by_range)
    return F.bround(clamp(chosen, 0.0, 100.0), 2)


def stitched(history: DataFrame, predictions: DataFrame) -> DataFrame:
    """History followed by forecast, each with the other's column empty."""
    past = history.select(
        "series_key",
        "date",
        F.col("total_amount").cast("double").alias("historical"),
        F.lit(None).cast("double").alias("predicted"),
    )
    ahead = predictions.select(
        "series_key",
        "date",
        F.lit(None).cast("double").alias("historical"),
        F.col("predicted_amount").alias("predicted"),
    )
    return past.unionByName(ahead)


def forecast_report(
    history: DataFrame,
    predictions: DataFrame,
    metrics: DataFrame,
    model_type: str,
    days: int = FORECAST_DAYS,
) -> DataFrame:
    """One row per series: growth, verdict, error measures and accuracy.

    ``metrics`` has the in-sample ``mse`` and ``r2_score`` per series. Series without a
    prediction come out with the status ``insufficient_history``.
    """
    parts = growth_rate(history, predictions, days).unionByName(
        metrics.select("series_key", "mse", "r2_score"), allowMissingColumns=True
    )
    # One row of each part per series; the maximum picks the one value there is.
    whole = parts.groupBy("series_key").agg(
        *[F.max(c).alias(c) for c in parts.columns if c != "series_key"]
    )
    done = F.col("predicted_total").isNotNull()
    return whole.select(
        "series_key",
        F.when(done, "ok").otherwise("insufficient_history").alias("status"),
        F.col("history_days").alias("prediction_start_index"),
        F.when(done, F.lit(model_type)).otherwise("N/A").alias("model_type"),
        F.when(done, accuracy("r2_score", "mse", "lowest", "highest")).alias("accuracy"),
        F.bround("mse", 2).alias("mse"),
        F.bround("r2_score", 2).alias("r2_score"),
        F.bround("growth_rate", 2).alias("growth_rate"),
        F.bround("predicted_total", 2).alias("predicted_total"),
        verdict("growth_rate").alias("conclusion"),
    )


@dataclass(frozen=True)
class Prediction:
    """A forecast with what it was made from; ``model`` is the forest, if there is one."""

    history: DataFrame
    predictions: DataFrame
    fitted: DataFrame | None
    report: DataFrame
    model: RandomForestRegressionModel | None = None

    @property
    def points(self) -> DataFrame:
        return stitched(self.history, self.predictions)


def explained_prediction(
    orders: DataFrame,
    as_of: Day,
    model_type: str = "random_forest",
    mode: str | None = None,
    days: int = FORECAST_DAYS,
    history_days: int = HISTORY_DAYS,
    series: Column | str | None = None,
) -> Prediction:
    """The forecast of ``sales_prediction`` with its history, fitted values and model."""
    if model_type not in ("random_forest", "linear"):
        raise ValueError(f"unknown model {model_type!r}")
    # Fit and steps read the series again; it is small, and written once.
    use_checkpoints(orders.sparkSession)
    history = daily_series(orders, as_of, history_days, series).checkpoint(eager=True)
    model = fitted = None
    if model_type == "linear":
        mode, label = mode or "clean", "Linear Regression"
        predictions = linear_forecast(history, days, mode)
        fitted = linear_fit(history, mode).where(F.col("part") == "in_sample")
    else:
        mode, label = mode or "legacy", "Random Forest"
        if feature_frame(history, mode).isEmpty():
            predictions = _nothing(history, PREDICTION)
        else:
            model = fit_forest(history, mode, depth=ONE_SERIES_DEPTH if series is None else DEPTH)
            predictions = forest_forecast(history, model, days, mode)
            fitted = forest_fit(history, model, mode)
    metrics = _nothing(history, METRICS) if fitted is None else fit_metrics(fitted, ["series_key"])
    report = forecast_report(history, predictions, metrics, label, days)
    return Prediction(history, predictions, fitted, report, model)


def sales_prediction(
    orders: DataFrame,
    as_of: Day,
    model_type: str = "random_forest",
    mode: str | None = None,
    days: int = FORECAST_DAYS,
    history_days: int = HISTORY_DAYS,
    series: Column | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The forecast as (points, report).

    ``random_forest`` runs in legacy mode by default, as the dashboard does. Without
    ``series`` its trees have the dashboard's depth of ``ONE_SERIES_DEPTH``; with it one forest of
    ``DEPTH`` learns from all series.
    """
    made = explained_prediction(orders, as_of, model_type, mode, days, history_days, series)
    return made.points, made.report
