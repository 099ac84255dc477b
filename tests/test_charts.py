import datetime as dt
from decimal import Decimal as D

import pytest
from test_dashboard import ORDERS, order

from tillmark.fixed_values import MEMBER_TIERS, NO_DATA
from tillmark.operators import dashboard
from tillmark.plans import charts
from tillmark.plans.views import register_views
from tillmark.schemas import SCHEMAS

AS_OF = "2024-01-10"


def shop(spark, frame, orders=(), details=(), behavior=(), filled=True):
    """All thirteen tables by their declared schemas, with the given facts."""
    t = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    t["sales_order"] = frame(ORDERS, list(orders))
    t["sales_detail"] = frame(
        "order_id long, product_id long, quantity int, total_price decimal(10,2), "
        "actual_price decimal(10,2)", list(details))
    t["user_behavior"] = frame("behavior_type string", list(behavior))
    if filled:
        t["member_level"] = frame(
            "id long, level_name string, min_points int, max_points int",
            [(i, n, a, b) for i, (n, a, b, _) in enumerate(MEMBER_TIERS)])
        t["py_user"] = frame("id long, username string, nickname string", [(1, "u", "n")])
        t["sales_channel"] = frame("id long, channel_name string, channel_type string",
                                   [(1, "Web", "online")])
        t["product_category"] = frame("id long, category_name string", [(1, "A")])
        t["product"] = frame(
            "id long, product_name string, product_code string, category_id long",
            [(1, "p1", "c1", 1), (2, "p2", "c2", 1)])
        t["user_address"] = frame("id long, user_id long, province string", [(1, 1, "北京市")])
    return t


def test_payload_shapes(spark, frame):
    t = shop(spark, frame, [order(1), order(2, method="card")],
             [(1, 1, 3, D("9"), D("8")), (1, 2, 5, D("5"), D("5"))], [("cart",)])
    run = {name: f(t, AS_OF) for name, f in charts.CHARTS.items() if name != "sales_prediction"}
    trend = run["sales_trend"]
    assert len(trend["dates"]) == 30 and trend["dates"][0] == "12-12"
    assert trend["amounts"][trend["dates"].index("01-05")] == 20.0
    assert run["user_distribution"] == {"regions": [{"name": "北京", "value": 1}], "max": 1}
    assert run["category_sales"] == {"categories": ["A"], "data": [{"name": "A", "value": 13.0}]}
    assert run["channel_analysis"] == {"channels": ["Web"], "orders": [2], "amounts": [20.0]}
    assert run["user_behavior"] == {"data": [{"name": "加购", "value": 1}]}
    assert run["payment_methods"]["methods"] == ["支付宝", "银行卡"]
    assert run["hot_products"] == {"products": ["p1", "p2"], "sales": [3, 5]}
    assert run["member_consumption"]["counts"] == [1, 0, 0, 0, 0]
    assert run["member_consumption"]["avg_amounts"][0] == 20.0


def test_payloads_of_empty_tables(spark, frame):
    t = shop(spark, frame, filled=False)
    run = {name: f(t, AS_OF) for name, f in charts.CHARTS.items() if name != "sales_prediction"}
    assert run["sales_trend"] == {"dates": ["01-10"], "orders": [0], "amounts": [0]}
    assert run["user_distribution"] == {"regions": [{"name": "北京", "value": 0}], "max": 1}
    assert run["hot_products"] == {"products": [NO_DATA], "sales": [0]}
    assert run["payment_methods"]["data"] == [{"name": NO_DATA, "value": 1}]
    assert run["member_consumption"]["levels"] == [NO_DATA]
    assert run["channel_analysis"]["channels"] == [NO_DATA]


def test_default_prediction_without_enough_days(spark, frame):
    for orders in ([], [order(1), order(2)]):
        out = charts.sales_prediction(shop(spark, frame, orders), AS_OF)
        assert out["error"] and out["historical"] == [0]


@pytest.mark.parametrize("n", [5, 40])
def test_prediction_payload(spark, frame, n):
    first = dt.datetime(2024, 1, 10) - dt.timedelta(days=n)
    orders = [order(i, str(first + dt.timedelta(days=i)), amount=f"{100 + i * 7 % 31}.00")
              for i in range(n)]
    out = charts.sales_prediction(shop(spark, frame, orders), AS_OF, model_type="linear")
    if n == 5:
        assert out["error"] and out["model_type"] == "N/A" and out["predicted"] == [0]
        return
    assert out["prediction_start_index"] == 40 and len(out["dates"]) == 70
    assert out["historical"][40:] == [None] * 30 and out["predicted"][:40] == [None] * 40
    assert out["model_type"] == "Linear Regression" and 0 <= out["accuracy"] <= 100


def test_too_many_points_are_refused(spark):
    with pytest.raises(ValueError, match="no chart"):
        charts.points(spark.range(20), most=10)


def test_placeholder_row(spark, frame):
    empty = dashboard.user_behavior(frame("behavior_type string", []))
    filled = charts.with_placeholder(empty, name=NO_DATA, value=1)
    assert [tuple(r) for r in filled.collect()] == [(NO_DATA, 1)]
    some = dashboard.user_behavior(frame("behavior_type string", [("view",)]))
    assert charts.with_placeholder(some, name=NO_DATA, value=1).count() == 1


def test_views_answer_sql(spark, frame):
    t = shop(spark, frame)
    t["sales_order"] = spark.createDataFrame([], SCHEMAS["sales_order"])
    names = register_views(t, AS_OF)
    assert {"sales_order", "view_sales_summary", "view_campaign_performance"} <= set(names)
    for name in names:
        assert spark.sql(f"SELECT count(*) AS n FROM {name}").first().n >= 0
