import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillmark.fixed_values import BEHAVIOR_WEIGHTS, HOLIDAYS
from tillmark.functions import (
    age,
    clamp,
    hashed_unit,
    is_blank,
    order_number,
    page_count,
    product_code,
    session_key,
)
from tillmark.operators import derive, quality

LINES = ("order_id long, unit_price decimal(10,2), quantity int, discount_rate decimal(10,6), "
         "campaign_id long")


def test_line_amounts_round_ties_to_even_and_need_a_campaign(frame):
    df = frame(LINES, [
        (1, D("0.50"), 1, D("0.05"), 1),    # 0.025 -> 0.02
        (2, D("1.50"), 1, D("0.05"), 1),    # 0.075 -> 0.08
        (3, D("10.00"), 2, D("0.10"), None),
    ])
    found = {r.order_id: (r.total_price, r.discount_price, r.actual_price)
             for r in derive.line_amounts(df).collect()}
    assert found == {
        1: (D("0.50"), D("0.02"), D("0.48")),
        2: (D("1.50"), D("0.08"), D("1.42")),
        3: (D("20.00"), D("0.00"), D("20.00")),
    }


DETAILS = ("order_id long, total_price decimal(10,2), discount_price decimal(10,2), "
           "actual_price decimal(10,2)")


def test_order_totals_and_mismatches(frame):
    details = frame(DETAILS, [(1, D("20.00"), D("1.00"), D("19.00")), (1, D("5"), D("0"), D("5"))])
    money = "decimal(10,2)"
    orders = frame(
        f"id long, total_amount {money}, discount_amount {money}, shipping_amount {money}, "
        f"payment_amount {money}",
        [(1, D("25.00"), D("1.00"), D("10.00"), D("34.00")),
         (2, D("3.00"), None, None, D("3.00")), (3, D("0"), None, D("10"), D("10"))],
    )
    row = derive.order_totals(details, orders).collect()
    assert [tuple(r) for r in row] == [(1, D("25.00"), D("1.00"), D("10.00"), D("34.00"))]
    assert [r.order_id for r in quality.order_total_mismatch(orders, details).collect()] == [2]


def test_lifecycle(frame):
    rows = derive.order_lifecycle(frame("order_status int", [(s,) for s in range(6)])).collect()
    assert [r.payment_status for r in rows] == [0, 1, 1, 1, 1, 1]
    assert [r.delivery_status for r in rows] == [0, 0, 1, 2, 2, 2]
    assert [r.has_payment_time for r in rows] == [False] + [True] * 5
    assert [r.has_complete_time for r in rows] == [False] * 3 + [True] * 3


def test_calendar_weights_match_a_plain_loop(spark):
    as_of = dt.date(2023, 12, 31)

    def weight(day):
        w = 1.5 if day.weekday() >= 5 else 1.0
        for m, d, lift in HOLIDAYS:
            away = abs((day - dt.date(as_of.year, m, d)).days)
            if away <= 3:
                w *= lift / (away + 1)
        return w

    rows = derive.calendar_weights(derive.calendar(spark, as_of), as_of).collect()
    assert len(rows) == 365
    assert all(r.weight == pytest.approx(weight(r.date)) for r in rows)
    near = [(12, 10, 2), (12, 12, 4)]
    both = derive.calendar_weights(derive.calendar(spark, as_of), as_of, near)
    day = both.where(F.col("date") == dt.date(2023, 12, 11)).first()  # a Monday
    assert day.weight == pytest.approx((2 / 2) * (4 / 2))


def test_first_address_is_default_and_only_online_orders_use_it(frame):
    marked = derive.default_addresses(frame("id long, user_id long", [(5, 1), (3, 1), (9, 2)]))
    assert {(r.id, r.is_default) for r in marked.collect()} == {(5, 0), (3, 1), (9, 1)}
    orders = frame("id long, user_id long, order_source string",
                   [(1, 1, "online"), (2, 1, "offline"), (3, 7, "online")])
    out = {r.id: r.address_id for r in derive.with_default_address(orders, marked).collect()}
    assert out == {1: 3, 2: None, 3: None}


def test_codes_and_small_functions(frame):
    df = frame("u long, t timestamp_ntz, n long, c string, b string",
               [(7, dt.datetime(2024, 3, 9, 23, 59), 42, "手机数码", "1990-12-31"),
                (8, dt.datetime(2024, 3, 9), 1234567, "ab", "not a date")])
    one, two = df.select(
        session_key("u", "t").alias("s"), product_code("c", "n").alias("p"),
        order_number("t", "n").alias("o"), age("b", "2024-01-01").alias("age"),
        clamp(F.col("n"), 0, 100).alias("clamped"), page_count("n", 20).alias("pages"),
        is_blank(F.lit("  ")).alias("blank"),
    ).collect()
    assert (one.s, one.p, one.o, one.age) == ("SESSION_7_20240309", "手机000042", "20240309000042", 34)
    assert (one.clamped, one.pages, one.blank) == (42, 3, True)
    assert (two.p, two.o, two.age, two.clamped) == ("ab1234567", "202403091234567", None, 100)


def test_price_ladder(frame):
    row = derive.price_ladder(frame("price decimal(10,2)", [(D("99.99"),)])).first()
    assert (row.cost_price, row.market_price) == (D("69.99"), D("119.99"))


def test_pick_and_sample_follow_the_weights_and_ignore_partitioning(spark):
    df = spark.range(20000)
    picked = df.select(derive.weighted_pick(hashed_unit("id", seed=1), BEHAVIOR_WEIGHTS).alias("b"))
    shares = {r.b: r["count"] / 20000 for r in picked.groupBy("b").count().collect()}
    assert all(abs(shares[b] - w / 100) < 0.02 for b, w in BEHAVIOR_WEIGHTS.items())

    weight = F.when(F.col("id") < 10000, 9).otherwise(1)
    sample = derive.weighted_sample(df, 1000, hashed_unit("id", seed=2), weight, "id")
    ids = {r.id for r in sample.collect()}
    again = derive.weighted_sample(df.repartition(17), 1000, hashed_unit("id", seed=2), weight, "id")
    assert len(ids) == 1000 and ids == {r.id for r in again.collect()}
    assert 0.85 < sum(i < 10000 for i in ids) / 1000 < 0.95

    grouped = derive.weighted_sample(
        df.withColumn("g", F.col("id") % 3), 5, hashed_unit("id"), F.lit(1), "id", by=["g"]
    )
    assert [r["count"] for r in grouped.groupBy("g").count().collect()] == [5, 5, 5]
    none = derive.weighted_sample(df, 10, hashed_unit("id"), F.lit(0), "id")
    assert none.count() == 0


def test_totals_beyond_the_long_range(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from tillmark.functions import money_sum, ratio

    rows = spark.range(200).select(F.lit(Decimal("9999999999.99")).cast("decimal(12,2)").alias("a"))
    wide = spark.range(2_000).select(F.lit(Decimal("99999999999999.99")).cast("decimal(16,2)").alias("a"))
    for df, n, one in ((rows, 200, "9999999999.99"), (wide, 2000, "99999999999999.99")):
        total = df.agg(money_sum(df, "a").alias("t")).first().t
        assert total == n * Decimal(one)
        mean = df.agg(money_sum(df, "a").alias("t"), F.count("*").alias("n")).select(ratio("t", "n").alias("m"))
        assert mean.first().m == Decimal(one)
    signs = spark.createDataFrame([(Decimal("-1.05"),), (Decimal("0.10"),), (Decimal("-12345.67"),), (None,)], "a decimal(10,2)")
    assert signs.agg(money_sum(signs, "a").alias("t")).first().t == Decimal("-12346.62")
    none = signs.where("false")
    assert none.agg(money_sum(none, "a").alias("t")).first().t is None
