"""Samples and pages of any size, against plain sorting; range lookup over many stretches."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillmark.functions import hashed_unit
from tillmark.operators import derive, directory, joins


@pytest.fixture(scope="module")
def rows(spark):
    group = F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 7).cast("string"))
    df = spark.range(9000).select("id", group.alias("g"), (F.col("id") % 11 - 1).cast("double").alias("w"))
    return df.repartition(6)


def plain(rows, size, by):
    """Ids of the smallest draws, by sorting all of them."""
    unit = hashed_unit("id", seed=3)
    found = rows.where("w > 0").select("id", "g", (-F.ln(unit) / F.col("w")).alias("draw")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.g if by else None, []).append((r.draw, r.id))
    return sorted(i for v in groups.values() for _, i in sorted(v)[:size])


@pytest.mark.parametrize("by", [None, ["g"]])
@pytest.mark.parametrize("size", [1, 7, 999, 1001, 3000, 7363, 7364, 20000])
def test_samples_of_any_size(rows, by, size):
    got = derive.weighted_sample(rows, size, hashed_unit("id", seed=3), "w", "id", by=by)
    assert got.columns == rows.columns
    assert sorted(r.id for r in got.collect()) == plain(rows, size, by)


def test_equal_draws_go_by_the_tie(spark):
    df = spark.range(5000).repartition(4)
    got = derive.weighted_sample(df, 1200, F.lit(0.5), F.lit(2), "id")
    assert sorted(r.id for r in got.collect()) == list(range(1200))


def test_a_sample_has_no_single_task(rows):
    text = derive.weighted_sample(rows, 5000, hashed_unit("id"), "w", "id")._jdf.queryExecution().executedPlan().toString()
    final = text.split("Subquery")[0]
    assert "SinglePartition" not in final and "TakeOrdered" not in final


def test_pages_of_sparse_and_dense_ids(spark, frame):
    r = random.Random(8)
    ids = {*range(3000), *(r.randrange(1 << 62) for _ in range(500)), *(1 << k for k in range(62)), *range(-40, 0),
           *((1 << 50) + i * 7 for i in range(2000))}
    users = spark.createDataFrame([(i, f"u{i}", "user") for i in ids], "id long, username string, role string").repartition(5)
    want = sorted(ids, reverse=True)
    for page in (1, 2, 3, 17, 60, 111, len(want) // 50 + 1, len(want) // 50 + 2, 4000):
        got = directory.user_search_page(users, page=page, limit=50).collect()
        assert [x.id for x in got] == want[(page - 1) * 50 : page * 50]
        assert all((x.total, x.pages) == (len(want), -(-len(want) // 50)) for x in got)


def test_no_job_before_the_page_is_asked_for(spark, frame):
    users = frame("id long, username string, role string", [(i, "u", "user") for i in range(100)])
    told = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    page = directory.user_search_page(users, page=3)
    assert not told.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert page.count() == 20


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_range_lookup_over_stretches(frame, parts):
    """Values that most points have, ranges over many stretches, repeated ranges and points."""
    r = random.Random(parts)
    values = [r.choice([D("5.00"), D("5.00"), D(r.randrange(-900, 900)) / 7]).quantize(D("0.01")) for _ in range(900)]
    points = [(i, v, f"p{i}") for i, v in enumerate(values)] + [(1, values[1], "p1"), (2000, None, "none")]
    ranges = [(D("5.00"), D("5.00"), 1), (D("-200"), D("200"), 2), (D("5.01"), D("5.00"), 3), (D("5.00"), D("9.00"), 4),
              (D("-9.00"), D("5.00"), 4), (D("-9.00"), D("5.00"), 4), (None, D("1"), 5), (D("1"), None, 6)]
    ranges += [(D(a) / 10, D(a + r.randrange(60)) / 10, 10 + a % 5) for a in (r.randrange(-1400, 1400) for _ in range(300))]
    p = frame("id long, v decimal(12,2), text string", points)
    q = frame("low decimal(9,2), high decimal(9,2), tier int", ranges)
    want = sorted(
        (i, str(v), t, str(a.quantize(D("0.01"))), str(b.quantize(D("0.01"))), n)
        for i, v, t in points if v is not None for a, b, n in ranges if a is not None and b is not None and a <= v <= b
    )
    found = joins.range_lookup(p, "v", q, "low", "high", parts=parts)
    assert found.columns == ["id", "v", "text", "low", "high", "tier"]
    got = sorted((x.id, str(x.v), x.text, str(x.low), str(x.high), x.tier) for x in found.collect())
    assert got == want


def test_a_value_of_most_points_has_many_tasks(spark, frame):
    p = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).cast("long").alias("v"))
    q = frame("tier int, low int, high int", [(1, 0, 100), (2, 101, 100_000)])
    found = joins.range_lookup(p, "v", q, "low", "high", parts=20)
    spread = found.where("tier = 1").groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = [r["count"] for r in spread.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(counts) >= 18_000 and max(counts) < 0.6 * sum(counts)


def test_nothing_to_look_up(frame):
    p, q = frame("v long", []), frame("low long, high long", [(1, 5)])
    assert joins.range_lookup(p, "v", q, "low", "high").count() == 0
    assert joins.range_lookup(frame("v long", [(1,)]), "v", q.where("false"), "low", "high").count() == 0
