import datetime as dt
import random
from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tillmark.fixed_values import GROWTH_VERDICT_ELSE, GROWTH_VERDICTS, NO_FORECAST_VERDICT
from tillmark.operators import forecast, series

START = dt.date(2024, 1, 1)
SERIES = "series_key string, date date, order_count long, total_amount decimal(20,2)"


def days(frame, amounts, key="all"):
    rows = [(key, START + dt.timedelta(days=i), 1, D(str(round(a, 2))))
            for i, a in enumerate(amounts)]
    return frame(SERIES, rows)


def noisy(n, seed=1):
    rnd = random.Random(seed)
    return [round(rnd.uniform(100, 900), 2) for _ in range(n)]


def by_hand(h, steps, predict, late_first):
    """The stepwise forecast written out plainly over Python lists."""
    p = []
    for i in range(steps):
        day = START + dt.timedelta(days=len(h) + i)
        known = h + p
        shift = 1 if late_first and i == 0 else 0
        lags = [known[-(j + shift)] for j in range(1, 8)]
        row = [day.weekday(), day.month, day.day, int(day.weekday() >= 5), *lags,
               sum(known[-7:]) / 7, sum(known[-14:]) / 14]
        p.append(max(0.0, predict(row)))
    return p


def ols(h, leak):
    x, y = [], []
    for t in range(13 if leak else 14, len(h)):
        day = START + dt.timedelta(days=t)
        end = t + 1 if leak else t
        x.append([day.weekday(), day.month, day.day, int(day.weekday() >= 5),
                  *[h[t - j] for j in range(1, 8)],
                  sum(h[end - 7:end]) / 7, sum(h[end - 14:end]) / 14, 1.0])
        y.append(h[t])
    w, *_ = np.linalg.lstsq(np.array(x), np.array(y), rcond=None)
    return lambda row: float(np.dot([*row, 1.0], w))


def predicted(df):
    return [r.predicted_amount for r in df.orderBy("step").collect()]


def test_series_fills_gaps_per_key_but_not_beyond_the_ends(frame):
    stamp = dt.datetime.fromisoformat
    orders = frame(
        "channel_id long, payment_amount decimal(10,2), create_time timestamp_ntz",
        [(1, D(5), stamp("2024-01-01 10:00:00")), (1, D(5), stamp("2024-01-11 10:00:00")),
         (None, D(7), stamp("2024-01-03 00:00:00")), (1, D(9), stamp("2023-01-01 00:00:00"))],
    )
    rows = series.daily_series(orders, "2024-01-31", series="channel_id").collect()
    one = sorted((r.date, r.order_count) for r in rows if r.series_key == "1")
    assert [d for d, _ in one] == [START + dt.timedelta(days=i) for i in range(11)]
    assert sum(n for _, n in one) == 2
    assert [r.date for r in rows if r.series_key == series.NO_KEY] == [dt.date(2024, 1, 3)]


def test_fourteen_days_leave_one_legacy_row_and_thirteen_none(frame):
    assert series.feature_frame(days(frame, noisy(14)), "legacy").count() == 1
    assert series.feature_frame(days(frame, noisy(14)), "clean").count() == 0
    assert series.feature_frame(days(frame, noisy(13)), "legacy").count() == 0


def test_clean_features_never_see_their_own_day(frame):
    amounts = noisy(40)
    changed = list(amounts)
    changed[30] += 1000
    at = START + dt.timedelta(days=30)

    def features(values, mode):
        row = series.feature_frame(days(frame, values), mode).where(F.col("date") == at).first()
        return [row[c] for c in series.FEATURES]

    assert features(amounts, "clean") == features(changed, "clean")
    assert features(amounts, "legacy") != features(changed, "legacy")


@pytest.mark.parametrize("mode", ["legacy", "clean"])
def test_linear_forecast_matches_the_plain_recursion(frame, mode):
    h = noisy(91)
    leak = mode == "legacy"
    want = by_hand(h, 30, ols(h, leak), late_first=leak)
    got = predicted(forecast.linear_forecast(days(frame, h), mode=mode))
    assert np.allclose(got, want, rtol=1e-6)


def test_legacy_linear_model_collapses_to_a_weekly_repeat(frame):
    h = noisy(91, seed=3)
    fitted = predicted(forecast.linear_forecast(days(frame, h), mode="legacy"))
    closed = predicted(forecast.weekly_repeat(days(frame, h)))
    assert np.allclose(fitted, closed, rtol=1e-6)
    assert closed[0] == h[-1] and closed[1] == h[-6] and closed[6] == h[-1] and closed[7] == closed[0]


def test_many_series_are_forecast_apart(frame):
    a, b = noisy(60, 1), noisy(45, 2)
    both = days(frame, a, "a").union(days(frame, b, "b")).union(days(frame, noisy(10), "short"))
    out = forecast.linear_forecast(both)
    assert {r.series_key for r in out.collect()} == {"a", "b"}
    alone = predicted(forecast.linear_forecast(days(frame, b, "b")))
    assert np.allclose(predicted(out.where("series_key = 'b'")), alone)


def test_standardised_columns(frame):
    rows = series.standardise(series.feature_frame(days(frame, noisy(50)))).toPandas()
    for c in ("lag_1", "rolling_mean_7", "dayofweek"):
        assert abs(rows[c].mean()) < 1e-9 and abs(rows[c].std(ddof=0) - 1) < 1e-9
    flat = series.standardise(series.feature_frame(days(frame, [5.0] * 30))).toPandas()
    assert (flat["lag_1"] == 0).all()


def test_metrics(frame):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 2.5), ("a", 4.0, 3.5), ("flat", 3.0, 3.0), ("off", 3.0, 4.0)]
    df = frame("series_key string, actual double, predicted double", rows)
    found = {r.series_key: r for r in forecast.fit_metrics(df, ["series_key"]).collect()}
    y, e = np.array([1, 2, 4.0]), np.array([0, 0.5, 0.5])
    assert found["a"].mse == pytest.approx((e**2).mean())
    assert found["a"].r2_score == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert (found["flat"].r2_score, found["off"].r2_score) == (1.0, 0.0)


def test_growth_needs_a_full_positive_base(frame):
    def rate(amounts, ahead):
        history = days(frame, amounts)
        coming = frame("series_key string, predicted_amount double", [("all", ahead)])
        return forecast.growth_rate(history, coming).first().growth_rate

    assert rate([10.0] * 40, 330.0) == pytest.approx(10.0)
    assert rate([10.0] * 29, 330.0) == 0.0
    assert rate([10.0] * 10 + [0.0] * 30, 330.0) == 0.0


def test_verdict_bands(spark, frame):
    rates = [10.01, 10.0, 0.0, -10.0, None]
    df = frame("rate double", [(r,) for r in rates])
    texts = [r[0] for r in df.select(forecast.verdict("rate")).collect()]
    above = [t for _, t in GROWTH_VERDICTS]
    assert texts == [above[0], above[1], above[2], GROWTH_VERDICT_ELSE, NO_FORECAST_VERDICT]


def test_accuracy(frame):
    df = frame("r2 double, mse double, low double, high double",
               [(0.87654, 1.0, 0.0, 1.0), (-1.0, 25.0, 0.0, 10.0), (-1.0, 400.0, 0.0, 10.0),
                (0.0, 1.0, 5.0, 5.0), (1.5, 0.0, 0.0, 1.0)])
    found = [r[0] for r in df.select(forecast.accuracy("r2", "mse", "low", "high")).collect()]
    assert found == [87.65, 75.0, 0.0, 0.0, 100.0]


def test_short_history_is_reported_as_such(frame):
    history = days(frame, noisy(13)).union(days(frame, noisy(40), "long"))
    coming = forecast.weekly_repeat(history)
    metrics = coming.select("series_key").distinct().withColumns(
        {"mse": F.lit(0.0), "r2_score": F.lit(1.0)}
    )
    rows = {r.series_key: r for r in
            forecast.forecast_report(history, coming, metrics, "Linear Regression").collect()}
    assert (rows["all"].status, rows["all"].model_type) == ("insufficient_history", "N/A")
    assert rows["all"].conclusion == NO_FORECAST_VERDICT
    assert (rows["long"].status, rows["long"].prediction_start_index) == ("ok", 40)


def test_holdout_is_scored_by_a_model_that_has_not_seen_it(frame):
    fitted = forecast.linear_fit(days(frame, noisy(91)))
    parts = {r["part"]: r["count"] for r in fitted.groupBy("part").count().collect()}
    assert parts == {"in_sample": 77, "holdout": 14}
    exact = forecast.linear_fit(days(frame, noisy(91)), mode="legacy")
    scores = {r["part"]: r.r2_score for r in forecast.fit_metrics(exact, ["part"]).collect()}
    assert scores["in_sample"] == pytest.approx(1.0)


def test_forest_steps_match_the_plain_recursion(frame):
    h = noisy(60, seed=5)
    df = days(frame, h)
    model = forecast.fit_forest(df, trees=5, depth=4)
    centre, spread = np.mean(np.round(h, 2)), np.std(np.round(h, 2))

    def predict(row):
        scaled = row[:4] + [(v - centre) / spread for v in row[4:]]
        return model.predict(Vectors.dense(scaled)) * spread + centre

    want = by_hand(h, 10, predict, late_first=True)
    got = predicted(forecast.forest_forecast(df, model, days=10))
    assert np.allclose(got, want, rtol=1e-9)
    scores = forecast.fit_metrics(forecast.forest_fit(df, model), ["series_key"]).first()
    assert 0 < scores.r2_score < 1


def test_one_forest_forecasts_many_series(frame):
    both = days(frame, noisy(40, 1), "a").union(days(frame, noisy(30, 2), "b"))
    both = both.union(days(frame, noisy(9), "short"))
    model = forecast.fit_forest(both, "clean", trees=3, depth=3)
    rows = forecast.forest_forecast(both, model, days=3, mode="clean").collect()
    ends = {"a": START + dt.timedelta(days=39), "b": START + dt.timedelta(days=29)}
    assert sorted((r.series_key, r.step, r.date) for r in rows) == [
        (k, i, ends[k] + dt.timedelta(days=i + 1)) for k in ("a", "b") for i in range(3)
    ]
    assert all(r.predicted_amount >= 0 for r in rows)


def test_stitched_points_have_one_value_each(frame):
    history = days(frame, noisy(30))
    rows = forecast.stitched(history, forecast.weekly_repeat(history)).collect()
    assert len(rows) == 60
    assert all((r.historical is None) != (r.predicted is None) for r in rows)


def test_short_legacy_series_are_really_fitted(frame):
    """From 14 to 26 days the closed form does not hold; the forecast comes from a fit."""
    h = noisy(20, seed=3)
    df = days(frame, h)
    assert forecast.weekly_repeat(df).count() == 0
    orders = frame(
        "create_time date, payment_amount double",
        [(START + dt.timedelta(days=i), round(float(v), 2)) for i, v in enumerate(h)],
    ).withColumn("payment_amount", F.col("payment_amount").cast("decimal(12,2)"))
    points, report = forecast.sales_prediction(
        orders.withColumn("id", F.lit(1)), START + dt.timedelta(days=20), "linear", "legacy"
    )
    got = [r.predicted for r in points.where("predicted is not null").orderBy("date").collect()]
    want = predicted(forecast.linear_forecast(df, mode="legacy"))
    assert np.allclose(got, want, rtol=1e-6) and len(got) == 30
    row = report.first()
    assert row.status == "ok" and row.mse >= 0


def test_model_size_does_not_follow_the_number_of_series(frame):
    many = None
    for i in range(12):
        part = days(frame, noisy(60, i), f"s{i:02d}")
        many = part if many is None else many.union(part)
    model = forecast.fit_forest(many, "clean", trees=4, depth=3)
    tables = forecast._node_tables(model)
    assert len(tables) == 4 and all(len(t[0]) <= 15 for t in tables)
    assert sum(len(t[0]) for t in tables) == model.totalNumNodes
    x = np.random.default_rng(0).normal(size=(50, 13)) * 5
    want = [model.predict(Vectors.dense(r)) for r in x]
    assert np.allclose(forecast._predicted(tables, x), want)


@pytest.mark.parametrize("name, query, column", [
    ("forest_forecast", "sales_prediction_curve", "gap"), ("forest_forecast", "sales_prediction_by_channel", "gap"),
    ("linear_forecast", "linear_forecast", "change"),
])
def test_one_wrong_step_turns_its_check_red(spark, monkeypatch, name, query, column):
    from conftest import SMALL

    from checks.registry import REGISTRY

    right = getattr(forecast, name)
    amount = F.col("predicted_amount")

    def wrong(*args, **more):
        shifted = F.when(F.col("step") == 9, amount * 1.05 + 1).otherwise(amount)
        return right(*args, **more).withColumn("predicted_amount", shifted)

    monkeypatch.setattr(forecast, name, wrong)
    assert REGISTRY[query](spark, SMALL).where(F.col(column) > 0).count() > 0


def test_a_shifted_forest_turns_its_check_red(spark, monkeypatch):
    from conftest import SMALL

    from checks.registry import REGISTRY

    right = forecast.forest_fit
    monkeypatch.setattr(
        forecast, "forest_fit", lambda *a: right(*a).withColumn("predicted", F.col("predicted") * 1.05)
    )
    assert REGISTRY["sales_prediction"](spark, SMALL).where("mse_gap > 0").count() == 1
