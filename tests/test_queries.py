import math

import pytest
from conftest import SMALL

import __spark_entry__ as driver
from checks.compare import compare, oracle_connection
from checks.oracle import ORACLE
from checks.registry import REGISTRY

WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALL)


def test_entry(spark):
    assert driver.entry(spark).count() == 10
    assert set(REGISTRY) <= set(driver.queries())
    assert set(driver.oracle_sql()) & set(REGISTRY) == set(REGISTRY) - WITHOUT_SQL
    assert set(ORACLE) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WITHOUT_SQL))
def test_query_agrees_with_its_sql(spark, oracle, name):
    same, note = compare(spark, oracle, name, SMALL)
    assert same, note
    assert "types differ" not in note, note


def test_default_forecast(spark):
    from checks.registry import AS_OF
    from tillmark.operators import forecast
    from tillmark.sources.adapters import Retail

    row = forecast.sales_prediction(Retail(spark, SMALL).orders(), AS_OF)[1].collect()[0]
    assert (row.status, row.model_type) == ("ok", "Random Forest")
    assert 0 < row.r2_score < 1 and row.accuracy == pytest.approx(100 * row.r2_score, abs=0.6)
    assert math.isfinite(row.growth_rate)


def plan(spark, name):
    return REGISTRY[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    assert "TakeOrderedAndProject" in plan(spark, "hot_products")
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan(spark, "hot_products")
    assert "GreaterThanOrEqual(o_orderdate" in plan(spark, "sales_trend")
    assert "WindowGroupLimit" in plan(spark, "weighted_sample")
    for name in REGISTRY:
        if name in ("sales_prediction", "sync_all", "landing_stream"):
            continue
        text = plan(spark, name)
        assert "CartesianProduct" not in text, name
        if not name.startswith("member_consumption"):  # broadcasts its few tiers
            assert "NestedLoopJoin" not in text, name


def test_summing_parts_gives_the_whole(spark):
    total = sum(r.total_sales for r in REGISTRY["category_sales"](spark, SMALL).collect())
    lines = REGISTRY["order_totals"](spark, SMALL)
    net = sum(r.payment_amount - r.shipping_amount for r in lines.collect())
    assert total == pytest.approx(net)
