import datetime as dt
from decimal import Decimal as D

from tillmark.operators import dashboard

AS_OF = dt.date(2024, 1, 10)
ORDERS = (
    "id long, user_id long, channel_id long, campaign_id long, order_status int, "
    "payment_status int, payment_method string, payment_amount decimal(10,2), "
    "create_time timestamp_ntz"
)


def order(i, when="2024-01-05 10:00:00", amount="10.00", user=1, channel=1, campaign=None,
          status=3, paid=1, method="alipay"):
    return (i, user, channel, campaign, status, paid, method, D(amount),
            dt.datetime.fromisoformat(when))


def test_trend_fills_thirty_days_across_new_year(frame):
    orders = frame(ORDERS, [order(1, "2023-12-30 08:00:00"), order(2, "2024-01-02 09:00:00")])
    rows = dashboard.sales_trend(orders, AS_OF).collect()
    assert [r.order_date for r in rows] == [
        dt.date(2023, 12, 12) + dt.timedelta(days=i) for i in range(30)
    ]
    assert {r.order_date: r.order_count for r in rows if r.order_count} == {
        dt.date(2023, 12, 30): 1, dt.date(2024, 1, 2): 1
    }
    assert sum(r.total_amount for r in rows) == D("20.00")


def test_trend_keeps_the_day_before_the_window_only_when_it_has_orders(frame):
    first = frame(ORDERS, [order(1, "2023-12-11 00:00:00"), order(2, "2023-12-10 23:59:59")])
    rows = dashboard.sales_trend(first, AS_OF).collect()
    assert len(rows) == 31 and rows[0].order_date == dt.date(2023, 12, 11)
    later = frame(ORDERS, [order(1, "2024-01-12 00:00:00", status=4)])
    assert dashboard.sales_trend(later, AS_OF).collect()[-1].order_date == dt.date(2024, 1, 12)


def test_trend_accepts_a_leap_day(frame):
    orders = frame(ORDERS, [order(1, "2024-02-29 12:00:00")])
    rows = dashboard.sales_trend(orders, "2024-03-01").collect()
    assert [r.order_date for r in rows if r.order_count] == [dt.date(2024, 2, 29)]


def test_user_distribution_strips_suffixes_and_keeps_null(frame):
    rows = [
        (1, 1, "北京市"), (2, 1, "北京市"), (3, 2, "北京市"), (4, 3, "内蒙古自治区"),
        (5, 4, "广西壮族自治区"), (6, 5, "香港特别行政区"), (7, 6, None), (8, 7, "Elsewhere"),
    ]
    out = dashboard.user_distribution(frame("id long, user_id long, province string", rows))
    found = {r.name: (r.value, r.max) for r in out.collect()}
    assert found == {
        "北京": (2, 2), "内蒙古": (1, 2), "广西壮族": (1, 2), "香港特别行政": (1, 2),
        None: (1, 2), "Elsewhere": (1, 2),
    }


PRODUCTS = "id long, product_name string, category_id long"
DETAILS = "order_id long, product_id long, quantity int, actual_price decimal(10,2)"


def test_category_sales_keeps_empty_and_merges_equal_names(frame):
    categories = frame("id long, category_name string", [(1, "A"), (2, "A"), (3, "B")])
    products = frame(PRODUCTS, [(1, "x", 1), (2, "y", 2)])
    details = frame(DETAILS, [(1, 1, 1, D("2.50")), (1, 2, 1, D("1.00")), (2, 9, 1, D("7.00"))])
    out = dashboard.category_sales(categories, products, details).collect()
    assert [(r.category_name, r.total_sales) for r in out] == [("A", D("3.50")), ("B", D("0"))]
    apart = dashboard.category_sales(categories, products, details, by_id=True).collect()
    assert {(r.category_id, r.total_sales) for r in apart} == {
        (1, D("2.50")), (2, D("1.00")), (3, D("0"))
    }


def test_channel_analysis_drops_orders_without_channel(frame):
    channels = frame("id long, channel_name string", [(1, "Web"), (2, "Shop")])
    orders = frame(ORDERS, [order(1), order(2, channel=None), order(3, status=4)])
    out = dashboard.channel_analysis(channels, orders).collect()
    assert [tuple(r) for r in out] == [("Web", 2, D("20.00")), ("Shop", 0, D("0.00"))]


def test_labels_pass_unknown_codes_through(frame):
    orders = frame(ORDERS, [
        order(1, method="points"), order(2, method="alipay", status=4), order(3, paid=0),
    ])
    found = {r.name: r.value for r in dashboard.payment_methods(orders).collect()}
    assert found == {"points": 1, "支付宝": 1}
    events = frame("behavior_type string", [("view",), ("view",), ("error",)])
    assert [tuple(r) for r in dashboard.user_behavior(events).collect()] == [
        ("浏览", 2), ("error", 1)
    ]


def test_hot_products_ties_and_name_clash(frame):
    names = [f"p{i:02d}" for i in range(11)]
    products = frame(PRODUCTS, [(i, n, 1) for i, n in enumerate(names)] + [(99, "p10", 1)])
    details = frame(DETAILS, [(1, i, 2, D("1")) for i in range(11)])
    top = dashboard.hot_products(details, products).collect()
    assert [r.product_name for r in top] == names[:10]
    assert [r["rank"] for r in top] == list(range(1, 11))
    more = details.union(frame(DETAILS, [(2, 99, 1, D("1"))]))
    best = dashboard.hot_products(more, products).first()
    assert (best.product_name, best.total_quantity) == ("p10", 3)
    assert dashboard.hot_products(more, products, by_id=True).first().total_quantity == 2


LEVELS = "id long, level_name string, min_points int, max_points int"


def members(frame, totals, half_open=False, tiers=((1, "low", 0, 1000), (2, "high", 1001, 5000))):
    users = frame("id long", [(i,) for i in range(len(totals) + 1)])
    orders = frame(ORDERS, [order(i, user=i, amount=t) for i, t in enumerate(totals)])
    out = dashboard.member_consumption(frame(LEVELS, list(tiers)), users, orders, half_open)
    return {r.level_name: tuple(r)[1:] for r in out.collect()}


def test_member_tiers_are_inclusive_and_have_gaps(frame):
    found = members(frame, ["1000.00", "1001.00", "1000.50"])
    assert found["low"] == (1, D("1000.00"), D("1000.000000"))
    assert found["high"] == (1, D("1001.00"), D("1001.000000"))


def test_half_open_tiers_close_the_gaps(frame):
    found = members(frame, ["1000.00", "1001.00", "1000.50", "9999.00"], half_open=True)
    assert found["low"][:2] == (2, D("2000.50"))
    assert found["high"][:2] == (2, D("11000.00"))


def test_empty_tier_and_users_without_orders(frame):
    found = members(frame, ["5.00"], tiers=((1, "a", 0, 10), (2, "b", 11, 20)))
    assert found == {"a": (1, D("5.00"), D("5.000000")), "b": (0, D("0.00"), D("0.000000"))}


def test_member_average_rounds_half_up_at_six_digits(frame):
    found = members(frame, ["1.00", "1.00", "0.01"], tiers=((1, "a", 0, 10),))
    assert found["a"] == (3, D("2.01"), D("0.670000"))


def test_share_of_total_folds_two_or_more_small_slices(frame):
    df = frame("name string, value decimal(10,2)",
               [("a", D("80")), ("b", D("10")), ("c", D("6")), ("d", D("4"))])
    out = {r.name: (r.value, r.percent) for r in dashboard.share_of_total(df, threshold=0.1).collect()}
    assert out == {"a": (D("80"), 80.0), "Other": (D("20"), 20.0)}
    alone = {r.name for r in dashboard.share_of_total(df, threshold=0.05).collect()}
    assert alone == {"a", "b", "c", "d"}
    zero = dashboard.share_of_total(frame("name string, value decimal(10,2)", [("a", D("0"))]))
    assert zero.first().percent is None


def test_results_do_not_depend_on_partitioning(frame, spark):
    orders = frame(ORDERS, [order(i, user=i % 7, amount=f"{i}.37") for i in range(200)])
    few, many = orders.coalesce(1), orders.repartition(13)
    assert dashboard.sales_trend(few, AS_OF).collect() == dashboard.sales_trend(many, AS_OF).collect()
