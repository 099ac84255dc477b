"""Join shapes the dashboard needs beyond plain equi-joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
# What happens at a place of the order: ranges begin before points of the same value, end after.
_BEGIN, _POINT, _END = 0, 1, 2
# Pairs handed on at once.
_PAIRS = 50_000


def _type(df: DataFrame, column: str) -> tuple[int, int]:
    """Digits before and after the point of a whole-number or decimal column."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    if kind.simpleString() in _DIGITS:
        return _DIGITS[kind.simpleString()], 0
    raise TypeError(f"{column} is {kind.simpleString()}; range_lookup takes decimals and whole numbers")


def _bounds_upto(bounds: Column, value: Column, n: int, equal: bool) -> Column:
    """How many of the ``n`` sorted bounds lie below ``value`` (or at it), by halving."""

    def halve(found: Column, step: Column) -> Column:
        at = F.get(bounds, found + step - 1)
        fits = (at <= value) if equal else (at < value)
        return found + F.when(F.coalesce(fits, F.lit(False)), step).otherwise(0)

    steps = [1 << k for k in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), halve)


def range_lookup(
    points: DataFrame, value: str, ranges: DataFrame, low: str, high: str, parts: int | None = None
) -> DataFrame:
    """Every (point, range) pair with ``low <= value <= high``; NULL values match nothing.

    Quantiles of the points cut both sides into ``parts`` stretches (by default as many as Spark
    has shuffle partitions), so each holds its share of the points; a value that many points have
    gets several stretches, dealt out by hash. Points go to one stretch, ranges to those they
    reach into; a range that spans a stretch whole pairs with all points in it, so its copies
    are fewer than the pairs. One ordered pass over a stretch then meets beginnings, points and
    ends, and keeps the ranges open at the time. It is exact for whole numbers and decimals of any
    sign and scale and works alike for any number of ranges.
    """
    kinds = [_type(points, value), _type(ranges, low), _type(ranges, high)]
    scale = max(s for _, s in kinds)
    digits = max(d for d, _ in kinds)
    if digits + scale > 37:
        raise TypeError("the columns' digits before and after the point exceed 37 together")
    spark = points.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    common = T.DecimalType(digits + scale, scale)

    def column(name: str) -> Column:
        return F.col(f"`{name}`").cast(common)

    placed = points.select(column(value).alias("at"), F.struct("*").alias("p")).where("at IS NOT NULL")
    spans = (
        ranges.select(column(low).alias("low"), column(high).alias("high"), F.struct("*").alias("r"))
        .where("low <= high")
    )
    bounds = None
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        bounds = placed.agg(F.percentile_approx("at", shares, 100 * parts)).scalar()

    def upto(at: Column, equal: bool) -> Column:
        return F.lit(0) if bounds is None else _bounds_upto(F.col("bounds"), at, parts - 1, equal)

    if bounds is not None:
        placed, spans = placed.withColumn("bounds", bounds), spans.withColumn("bounds", bounds)
    first, last = upto(F.col("at"), False), upto(F.col("at"), True)
    dealt = F.xxhash64(*[f"p.`{f.name}`" for f in points.schema if "map<" not in f.dataType.simpleString()])
    placed = placed.withColumns({"first": first, "last": last}).select(
        # Points of a value with stretches of its own are dealt over them.
        (F.col("first") + F.pmod(dealt, F.col("last") - F.col("first") + 1).cast("int")).alias("part"),
        "at", F.lit(_POINT).alias("what"), "p",
    )
    spans = (
        spans.withColumns({"first": upto(F.col("low"), False), "last": upto(F.col("high"), True)})
        .withColumn("part", F.explode(F.sequence("first", "last")))
        # Tells the copies of ranges in a stretch apart; both events of one come from one row.
        .withColumn("id", F.monotonically_increasing_id())
    )
    # Carried-over ranges are open from the start; those that go on have no end here.
    begin = F.struct(
        F.when(F.col("part") == F.col("first"), F.col("low")).alias("at"),
        F.lit(_BEGIN).alias("what"), F.col("r"),
    )
    end = F.when(F.col("part") == F.col("last"), F.struct(
        F.col("high").alias("at"), F.lit(_END).alias("what"),
        F.lit(None).cast(spans.schema["r"].dataType).alias("r"),
    ))
    marks = spans.select("part", "id", F.inline(F.array_compact(F.array(begin, end))))
    events = (
        placed.unionByName(marks, allowMissingColumns=True)
        .repartition("part")
        .sortWithinPartitions("part", F.asc_nulls_first("at"), "what")
        .select("part", "what", "id", "p", "r")
    )
    kinds = [T.StructField(c, events.schema[c].dataType) for c in ("p", "r")]
    return events.mapInArrow(_meet, T.StructType(kinds)).select("p.*", "r.*")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over the events of stretch after stretch, in order."""
    now, live = None, {}  # what is open in stretch ``now``: a row of the range by its number
    for batch in batches:
        part, what, ids = (
            batch.column(c).fill_null(0).to_numpy() for c in ("part", "what", "id")
        )
        ranges = batch.column("r")
        cuts = (np.flatnonzero(np.diff(part)) + 1).tolist()
        for start, stop in zip([0, *cuts], [*cuts, len(part)]):
            if start == stop:
                continue
            if part[start] != now:
                now, live = part[start], {}
            # Every range with the places between which it is open here.
            spans = {n: [row, start, stop] for n, row in live.items()}
            for i in (np.flatnonzero(what[start:stop] != _POINT) + start).tolist():
                if what[i] == _BEGIN:
                    spans[int(ids[i])] = [ranges.slice(i, 1), i, stop]
                    live[int(ids[i])] = ranges.slice(i, 1)
                else:
                    spans[int(ids[i])][2] = i
                    del live[int(ids[i])]
            yield from _pairs(batch.column("p"), np.flatnonzero(what[start:stop] == _POINT) + start, spans)


def _pairs(rows: pa.Array, points: np.ndarray, spans: dict) -> Iterator[pa.RecordBatch]:
    """Every range beside the points between its places, so many pairs at once."""
    if not len(points) or not spans:
        return
    ranges = pa.concat_arrays([row for row, _, _ in spans.values()])
    first = np.searchsorted(points, [s[1] for s in spans.values()])
    upto = np.cumsum(np.searchsorted(points, [s[2] for s in spans.values()]) - first)
    for at in range(0, int(upto[-1]), _PAIRS):
        pair = np.arange(at, min(int(upto[-1]), at + _PAIRS))
        which = np.searchsorted(upto, pair, side="right")
        place = first[which] + pair - np.where(which > 0, upto[which - 1], 0)
        yield pa.RecordBatch.from_arrays(
            [rows.take(pa.array(points[place])), ranges.take(pa.array(which))], ["p", "r"]
        )
