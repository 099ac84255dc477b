"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.fixed_values import REGION_ENDINGS, REGION_SUFFIX_CHARS

Day = dt.date | str


def as_date(day: Day) -> dt.date:
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates -----------------------------------------------------------------------------


def since(c: Column | str, as_of: Day, days: int) -> Column:
    """Rows from midnight ``days`` before ``as_of`` on, with no upper bound.

    The bound is a date literal, so it folds into the column's own type and reaches
    the file scan.
    """
    return col(c) >= F.lit(as_date(as_of) - dt.timedelta(days=days))


def month_key(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def days_between(as_of: Day, c: Column | str) -> Column:
    return F.datediff(F.lit(as_date(as_of)), F.to_date(col(c)))


def age(birthday: Column | str, as_of: Day) -> Column:
    """Difference of the years only; whether the birthday has passed plays no part."""
    return F.lit(as_date(as_of).year) - F.year(col(birthday).try_cast("date"))


# --- numbers ---------------------------------------------------------------------------


def ratio(total: Column | str, count: Column | str, digits: int = 2) -> Column:
    """A sum of money by a whole count, rounded half up; NULL when ``count`` is zero.

    The casts leave 15 decimals for the quotient, so rounding it is exact for counts below a
    hundred million and off by one unit of the last digit at most beyond.
    """
    money = col(total).cast("decimal(24,2)")
    return F.round(F.try_divide(money, col(count).cast("decimal(12,0)")), digits)


def clamp(c: Column | str, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(c)))


def page_count(total: Column | str, limit: int) -> Column:
    return ((col(total) + F.lit(limit - 1)) / F.lit(limit)).cast("long")


# --- text ------------------------------------------------------------------------------


def zero_padded(c: Column | str, width: int) -> Column:
    """Left-padded with zeros; longer numbers keep all digits."""
    text = col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def is_blank(c: Column | str) -> Column:
    return col(c).isNull() | (F.length(F.trim(col(c))) == 0)


def region_name(c: Column | str) -> Column:
    """Province name without its administrative suffix. NULL stays NULL."""
    name = col(c)
    ends = F.lit(False)
    for ending in REGION_ENDINGS:
        ends = ends | name.endswith(ending)
    return F.when(ends, F.regexp_replace(name, f"[{REGION_SUFFIX_CHARS}]+$", "")).otherwise(name)


def labelled(c: Column | str, labels: Mapping[str, str]) -> Column:
    """The label of a code; codes without one stay as they are."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[col(c)], col(c))


def matches(c: Column | str, needle: str | None, literal: bool = False) -> Column | None:
    """Case-insensitive substring test, or None for a blank needle.

    By default ``%`` and ``_`` in the needle act as wildcards; with ``literal`` they
    stand for themselves.
    """
    text = (needle or "").strip()
    if not text:
        return None
    if literal:
        return F.lower(col(c)).contains(text.lower())
    return col(c).ilike(f"%{text}%")


def session_key(user: Column | str, at: Column | str) -> Column:
    return F.concat(
        F.lit("SESSION_"), col(user).cast("string"), F.lit("_"), F.date_format(col(at), "yyyyMMdd")
    )


def product_code(category: Column | str, sequence: Column | str) -> Column:
    return F.concat(F.substring(col(category), 1, 2), zero_padded(sequence, 6))


def order_number(at: Column | str, sequence: Column | str) -> Column:
    return F.concat(F.date_format(col(at), "yyyyMMdd"), zero_padded(sequence, 6))


def hashed_unit(*keys: Column | str, seed: int = 0) -> Column:
    """A number in (0, 1) that depends on the key values and the seed only.

    The same row gets the same number however the data is partitioned, so a lost task
    can be run again without changing the outcome.
    """
    text = F.concat_ws("|", *[col(k).cast("string") for k in keys], F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
    return (head + F.lit(0.5)) / F.lit(float(16**12))
