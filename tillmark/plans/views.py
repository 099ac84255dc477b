"""The retail tables and reporting views under their names, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillmark.functions import Day
from tillmark.operators import marts
from tillmark.sources.tables import Tables


def mart_views(t: Tables, as_of: Day) -> dict[str, DataFrame]:
    orders = t["sales_order"]
    return {
        "view_sales_summary": marts.sales_summary(orders, t["sales_channel"]),
        "view_product_sales_ranking": marts.product_sales_ranking(
            t["sales_detail"], orders, t["product"], t["product_category"]
        ),
        "view_online_offline_comparison": marts.online_offline_comparison(orders),
        "view_user_purchase_behavior": marts.user_purchase_behavior(
            t["py_user"], orders, t["sales_channel"], as_of
        ),
        "view_campaign_performance": marts.campaign_performance(
            t["marketing_campaign"], orders
        ),
    }


def register_views(t: Tables, as_of: Day) -> list[str]:
    """Create a temporary view per table and per reporting view; returns their names."""
    frames = {**t, **mart_views(t, as_of)}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)
