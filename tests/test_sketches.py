import random

import pytest

from tillmark.operators import sketches
from tillmark.session import new_dir


def rows(seed, n=6000):
    r = random.Random(seed)
    return [
        (r.choice("aab"), f"2024-0{r.randrange(1, 4)}-{r.randrange(1, 29):02d}", r.choice([None, *range(2500)]))
        for _ in range(n)
    ]


def days(frame, data, value="long"):
    df = frame(f"g string, d string, u {value}", data)
    return df.selectExpr("g", "cast(d as timestamp) as t", "u")


def test_rolled_up_sketches_meet_the_exact_counts(spark, frame):
    data = rows(1)
    path = new_dir(spark, "sketches")
    sketches.store_days(sketches.daily_sketches(days(frame, data), "u", "t", ["g"]), path)
    # A month that is stored again takes the place of the first.
    again = [x for x in data if x[1].startswith("2024-02")]
    sketches.store_days(sketches.daily_sketches(days(frame, again), "u", "t", ["g"]), path)
    stored = sketches.read_days(spark, path)
    for g in "ab":
        exact = len({u for x, _, u in data if x == g and u is not None})
        got = stored.where(f"g = '{g}'").agg(sketches.distinct_count().alias("n")).first().n
        assert abs(got - exact) <= sketches.error_bound() * exact
    span = sketches.read_days(spark, path, "2024-02-01", "2024-02-29")
    exact = len({u for _, d, u in data if d.startswith("2024-02") and u is not None})
    # Merging in two steps is merging at once.
    steps = span.groupBy("g").agg(sketches.merged_sketch().alias("sketch"))
    for part in (span, steps):
        got = part.agg(sketches.distinct_count().alias("n")).first().n
        assert abs(got - exact) <= sketches.error_bound() * exact
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sketch_month" in plan


@pytest.mark.parametrize("kind", ["long", "string"])
def test_small_groups_are_exact(frame, kind):
    make = str if kind == "string" else int
    data = [("a", "2024-01-01", make(i % 7)) for i in range(100)] + [("b", "2024-01-01", None), ("c", None, make(1))]
    made = sketches.daily_sketches(days(frame, data, kind), "u", "t", ["g"])
    got = {r.g: r.n for r in made.groupBy("g").agg(sketches.distinct_count().alias("n")).collect()}
    assert got == {"a": 7, "b": 0}
    none = sketches.daily_sketches(days(frame, [], kind), "u", "t", ["g"])
    assert none.count() == 0


def test_other_types_and_no_groups(frame):
    df = frame("u decimal(10,2), t date", []).unionByName(
        frame("i int", [(i,) for i in range(50)]).selectExpr("cast(i % 20 as decimal(10,2)) as u", "date'2024-01-01' as t")
    )
    assert sketches.daily_sketches(df, "u", "t").agg(sketches.distinct_count().alias("n")).first().n == 20
