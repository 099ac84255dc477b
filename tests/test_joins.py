import random
from decimal import Decimal as D

import pytest

from tillmark.operators import joins


def pairs(df):
    return sorted((r.id, r.tier) for r in df.select("id", "tier").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_range_lookup_agrees_with_brute_force(frame, seed):
    rnd = random.Random(seed)

    def amount(top):
        return D(rnd.randrange(top)) / 100

    points = [(i, amount(10 ** rnd.randrange(1, 10))) for i in range(120)] + [(999, None)]
    ranges = []
    for t in range(60):
        a, b = sorted((amount(10 ** rnd.randrange(1, 10)), amount(10 ** rnd.randrange(1, 10))))
        ranges.append((t, a, b))
    ranges += [(100, points[0][1], points[0][1]), (101, D("5"), D("4")), (102, D(0), D("99999999"))]
    want = sorted((i, t) for i, v in points if v is not None for t, a, b in ranges if a <= v <= b)
    p = frame("id long, v decimal(20,2)", points)
    r = frame("tier long, lo decimal(20,2), hi decimal(20,2)", ranges)
    assert pairs(joins.range_lookup(p, "v", r, "lo", "hi")) == want
    plan = joins.range_lookup(p, "v", r, "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_integer_bounds_leave_gaps(frame):
    p = frame("id long, v decimal(20,2)", [(1, D("1000.00")), (2, D("1000.50")), (3, D("1001.00"))])
    r = frame("tier long, lo int, hi int", [(1, 0, 1000), (2, 1001, 5000)])
    assert pairs(joins.range_lookup(p, "v", r, "lo", "hi")) == [(1, 1), (3, 2)]


def test_range_lookup_signs_scales_and_sizes(frame):
    """Negative, sub-cent and huge values, bounds of other scales, overlapping ranges."""
    values = ["-5", "5.004", "5.006", "20000000000000000", "3", "0", "-0.001", "123456789012345678901.123"]
    points = [(i, D(v)) for i, v in enumerate(values)]
    ranges = [(1, D("-10"), D("-1")), (2, D("5.00"), D("5.00")), (3, D("5.01"), D("6")),
              (4, D("1e16"), D("3e16")), (5, D("-99999999999999999999"), D("99999999999999999999")),
              (6, D("0"), D("0")), (7, D("3"), D("2"))]
    p = frame("id long, v decimal(30,3)", points)
    r = frame("tier long, lo decimal(25,2), hi decimal(25,2)", ranges)
    want = sorted((i, t) for i, v in points for t, a, b in ranges if a <= v <= b)
    assert pairs(joins.range_lookup(p, "v", r, "lo", "hi")) == want
    rnd = random.Random(5)

    def any_value():
        return D(rnd.randrange(-(10 ** rnd.randrange(1, 20)), 10 ** rnd.randrange(1, 20))) / 1000

    points = [(i, any_value()) for i in range(150)]
    ranges = [(t, *sorted((any_value(), any_value()))) for t in range(80)]
    want = sorted((i, t) for i, v in points for t, a, b in ranges if a <= v <= b)
    p = frame("id long, v decimal(30,3)", points)
    r = frame("tier long, lo decimal(30,3), hi decimal(30,3)", ranges)
    assert pairs(joins.range_lookup(p, "v", r, "lo", "hi")) == want


def test_range_lookup_refuses_what_is_not_exact(frame):
    p = frame("id long, v double", [(1, 1.0)])
    r = frame("tier long, lo int, hi int", [(1, 0, 2)])
    with pytest.raises(TypeError):
        joins.range_lookup(p, "v", r, "lo", "hi")
