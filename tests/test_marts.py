import datetime as dt
from decimal import Decimal as D

from test_dashboard import ORDERS, order

from pyspark.sql import functions as F

from tillmark.operators import marts
from tillmark.schemas import SCHEMAS

CHANNELS = "id long, channel_name string, channel_type string"


def with_amounts(df, discount="1.00"):
    cut = F.lit(D(discount)).cast("decimal(10,2)")
    return df.withColumns(
        {
            "discount_amount": cut,
            "total_amount": (F.col("payment_amount") + cut).cast("decimal(10,2)"),
            "order_source": F.lit("online"),
        }
    )


def test_summary_keeps_orders_without_channel_and_only_completed(frame):
    orders = with_amounts(frame(ORDERS, [
        order(1, amount="10.00"), order(2, amount="10.01"), order(3, channel=None),
        order(4, status=4),
    ]))
    channels = frame(CHANNELS, [(1, "Web", "online")])
    rows = {r.channel_name: r for r in marts.sales_summary(orders, channels).collect()}
    assert set(rows) == {"Web", None}
    assert rows["Web"].order_count == 2
    assert rows["Web"].avg_order_value == D("10.01")  # 10.005 goes up
    assert rows["Web"].total_discount == D("2.00")


def test_user_behaviour_has_null_channels_not_an_empty_text(frame):
    users = frame("id long, username string, nickname string", [(1, "a", "A"), (2, "b", "B")])
    orders = frame(ORDERS, [
        order(1, "2024-01-01 10:00:00", user=1), order(2, "2024-01-01 18:00:00", user=1, channel=2),
        order(3, "2024-01-04 10:00:00", user=1), order(4, user=2, channel=None),
    ])
    channels = frame(CHANNELS, [(1, "Web", "online"), (2, "App", "online")])
    rows = {r.user_id: r for r in
            marts.user_purchase_behavior(users, orders, channels, "2024-01-10").collect()}
    assert rows[1].used_channels == "App, Web"
    assert (rows[1].order_count, rows[1].purchase_days) == (3, 2)
    assert rows[1].last_purchase_date == dt.datetime(2024, 1, 4, 10)
    assert rows[1].days_since_last_purchase == 6
    assert rows[2].used_channels is None


def test_campaign_without_completed_orders_is_kept(frame):
    campaigns = frame("id long, campaign_name string, campaign_type string",
                      [(1, "one", "gift"), (2, "two", "gift"), (3, "three", "gift")])
    orders = with_amounts(frame(ORDERS, [
        order(1, campaign=1, amount="99.00"), order(2, campaign=2, status=1),
    ]))
    rows = {r.campaign_id: r for r in marts.campaign_performance(campaigns, orders).collect()}
    assert rows[1].discount_rate_percent == D("1.00") and rows[1].customer_count == 1
    for i in (2, 3):
        assert (rows[i].order_count, rows[i].net_sales, rows[i].avg_order_value) == (0, None, None)


def test_campaign_with_zero_total_has_no_percentage(frame):
    campaigns = frame("id long, campaign_name string, campaign_type string", [(1, "one", "gift")])
    orders = with_amounts(frame(ORDERS, [order(1, campaign=1, amount="0.00")]), discount="0.00")
    assert marts.campaign_performance(campaigns, orders).first().discount_rate_percent is None


def test_ranking_top_numbers_ties_alike(frame):
    products = frame("id long, product_name string, product_code string, category_id long",
                     [(i, f"p{i}", f"c{i}", 1) for i in range(4)])
    details = frame("order_id long, product_id long, quantity int, total_price decimal(10,2)",
                    [(1, 0, 1, D("5")), (1, 1, 2, D("9")), (1, 2, 1, D("9")), (2, 3, 1, D("99"))])
    orders = frame("id long, order_status int", [(1, 3), (2, 4)])
    categories = frame("id long, category_name string", [(1, "A")])
    top = marts.product_sales_ranking(details, orders, products, categories, top=3).collect()
    assert [(r.product_id, r["rank"]) for r in top] == [(1, 1), (2, 1), (0, 3)]
    assert top[0].avg_price == D("4.50")


def test_online_offline_by_month(frame):
    orders = with_amounts(frame(ORDERS, [
        order(1, "2024-01-31 23:59:59"), order(2, "2024-02-01 00:00:00", user=2), order(3, user=1),
    ]))
    rows = marts.online_offline_comparison(orders).collect()
    assert [(r.sale_month, r.order_count, r.customer_count) for r in rows] == [
        ("2024-02", 1, 1), ("2024-01", 2, 1)
    ]


def test_native_tables_are_filtered_and_pruned_in_the_scan(spark, base):
    orders = spark.createDataFrame([], SCHEMAS["sales_order"])
    orders.write.parquet(base)
    stored = spark.read.schema(SCHEMAS["sales_order"]).parquet(base)
    plan = marts.online_offline_comparison(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,3)" in plan
    assert "discount_amount" not in plan and "remark" not in plan
