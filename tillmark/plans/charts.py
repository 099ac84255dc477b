"""Chart payloads: dashboard results as plain lists, ready to be sent as JSON.

Only here do results leave Spark, a partition at a time. A caller may set the most points it
will take; without that every row is delivered.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tillmark.fixed_values import (
    NO_DATA,
    NO_FORECAST_VERDICT,
    NO_REGION,
    PAGE_SIZE,
)
from tillmark.functions import Day, as_date
from tillmark.operators import dashboard, directory, forecast
from tillmark.sources.tables import Tables

Payload = dict[str, Any]


def points(df: DataFrame, most: int | None = None) -> list[Row]:
    if most is None:
        return list(df.toLocalIterator())
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no chart; write the result to a table")
    return rows


def with_placeholder(df: DataFrame, **values: Any) -> DataFrame:
    """``df``, or one row of the given values when it is empty."""
    row = df.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row.where(~df.exists()))


def _short(day: dt.date) -> str:
    return day.strftime("%m-%d")


def _pairs(rows: list[Row], name: str = "name", value: str = "value") -> list[Payload]:
    return [{"name": r[name], "value": _number(r[value])} for r in rows]


def _number(v: Any) -> Any:
    return v if v is None or isinstance(v, int) else float(v)


def _column(rows: list[Row], name: str) -> list[Any]:
    return [r[name] if isinstance(r[name], str) else _number(r[name]) for r in rows]


_EMPTY_PAIR = [{"name": NO_DATA, "value": 1}]


def sales_trend(t: Tables, as_of: Day) -> Payload:
    rows = points(dashboard.sales_trend(t["sales_order"], as_of))
    if not any(r.order_count for r in rows):
        return {"dates": [_short(as_date(as_of))], "orders": [0], "amounts": [0]}
    return {
        "dates": [_short(r.order_date) for r in rows],
        "orders": _column(rows, "order_count"),
        "amounts": _column(rows, "total_amount"),
    }


def user_distribution(t: Tables, as_of: Day) -> Payload:
    rows = points(dashboard.user_distribution(t["user_address"]))
    if not rows:
        return {"regions": [{"name": NO_REGION, "value": 0}], "max": 1}
    return {"regions": _pairs(rows), "max": rows[0]["max"]}


def category_sales(t: Tables, as_of: Day) -> Payload:
    rows = points(
        dashboard.category_sales(t["product_category"], t["product"], t["sales_detail"])
    )
    if not rows:
        return {"categories": [NO_DATA], "data": _EMPTY_PAIR}
    return {
        "categories": _column(rows, "category_name"),
        "data": _pairs(rows, "category_name", "total_sales"),
    }


def channel_analysis(t: Tables, as_of: Day) -> Payload:
    rows = points(dashboard.channel_analysis(t["sales_channel"], t["sales_order"]))
    if not rows:
        return {"channels": [NO_DATA], "orders": [0], "amounts": [0]}
    return {
        "channels": _column(rows, "channel_name"),
        "orders": _column(rows, "order_count"),
        "amounts": _column(rows, "total_amount"),
    }


def user_behavior(t: Tables, as_of: Day) -> Payload:
    rows = points(dashboard.user_behavior(t["user_behavior"]))
    return {"data": _pairs(rows) or _EMPTY_PAIR}


def payment_methods(t: Tables, as_of: Day) -> Payload:
    rows = points(dashboard.payment_methods(t["sales_order"]))
    return {"methods": _column(rows, "name") or [NO_DATA], "data": _pairs(rows) or _EMPTY_PAIR}


def hot_products(t: Tables, as_of: Day) -> Payload:
    """Best seller last, the order in which a horizontal bar chart draws upwards."""
    rows = points(dashboard.hot_products(t["sales_detail"], t["product"]))
    rows.sort(key=lambda r: -r["rank"])
    return {
        "products": _column(rows, "product_name") or [NO_DATA],
        "sales": _column(rows, "total_quantity") or [0],
    }


def member_consumption(t: Tables, as_of: Day) -> Payload:
    rows = points(
        dashboard.member_consumption(t["member_level"], t["py_user"], t["sales_order"])
    )
    if not rows:
        return {"levels": [NO_DATA], "counts": [0], "total_amounts": [0], "avg_amounts": [0]}
    return {
        "levels": _column(rows, "level_name"),
        "counts": _column(rows, "user_count"),
        "total_amounts": _column(rows, "total_amount"),
        "avg_amounts": _column(rows, "avg_amount"),
    }


def sales_prediction(t: Tables, as_of: Day, model_type: str = "random_forest") -> Payload:
    curve, report = forecast.sales_prediction(t["sales_order"], as_of, model_type)
    found = points(report)
    if not found or found[0].status != "ok":
        return {
            "error": "insufficient_history",
            "dates": [_short(as_date(as_of))],
            "historical": [0],
            "predicted": [0],
            "prediction_start_index": 0,
            "model_type": "N/A",
            "accuracy": 0,
            "mse": 0,
            "r2_score": 0,
            "growth_rate": 0,
            "predicted_total": 0,
            "conclusion": NO_FORECAST_VERDICT,
        }
    rows = points(curve.orderBy("date"))
    summary = found[0].asDict()
    del summary["series_key"], summary["status"]
    return {
        "dates": [_short(r.date) for r in rows],
        "historical": _column(rows, "historical"),
        "predicted": _column(rows, "predicted"),
        **summary,
    }


CHARTS: dict[str, Callable[..., Payload]] = {
    f.__name__: f
    for f in (
        sales_trend,
        user_distribution,
        category_sales,
        channel_analysis,
        user_behavior,
        payment_methods,
        hot_products,
        member_consumption,
        sales_prediction,
    )
}


def user_list(
    users: DataFrame,
    role: str = "user",
    username: str | None = None,
    page: int = 1,
    limit: int = PAGE_SIZE,
) -> Payload:
    """One page of the directory. The total also holds for a page past the end."""
    rows = points(directory.user_search_page(users, role, username, page, limit), limit)
    total = rows[0].total if rows else directory.find_users(users, role, username).count()
    data = [
        {k: v for k, v in r.asDict().items() if k not in ("total", "pages")} for r in rows
    ]
    return {
        "data": data,
        "total": total,
        "page": page,
        "limit": limit,
        "pages": -(-total // limit),
    }
