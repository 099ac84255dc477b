"""Parquet copies of source tables, kept in step by full and incremental exports.

A full export writes a generation of its own, an incremental one a batch beside the others. Either
counts from the moment its commit record is written (see ``commits``), so a failed run leaves the
copy as it was. A batch is committed before its mark is saved, and its number only moves on with
the mark, so a repeated run takes the place of the batch it repeats. The mark comes from the rows
written, never from a second read of the source, which may have moved on meanwhile.

The table's schema is stored with each commit and widens as batches bring longer numbers, finer
decimals and new columns. Batches are read by their own schema and cast, so no footers are merged.

``compact`` folds the batches into a base of one row per key, laid out in buckets by the key's hash.
Readers by that key then merge the later batches into it, in the buckets these touch.
"""

from __future__ import annotations

import datetime as dt
import itertools
import threading
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.versions import latest_version
from tillmark.schemas import fitted, merged
from tillmark.sources.commits import Part, State, TableFiles
from tillmark.sources.tables import after_mark, time_column

Source = Callable[[str], DataFrame]
# Rows of a table whose column is later than a mark, where the source can tell by itself.
Newer = Callable[[str, str, str], DataFrame]

BUCKET = "sync_bucket"
BUCKETS = 64
MARKS = "sync_marks"
_MARKS_SCHEMA = "run long, table_name string, column_name string, mark string, next_batch int"


@dataclass(frozen=True)
class Mark:
    """How far a table has been exported. ``mark`` is None before the first export."""

    column: str | None = None
    mark: str | None = None
    next_batch: int = 0


@dataclass(frozen=True)
class Exported:
    table: str
    mode: str  # "full" or "incremental"
    rows: int
    mark: Mark


def _bucket(key: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(n_buckets)).cast("int")


def _kinds(schema: T.StructType, key: Sequence[str]) -> list[T.DataType | None]:
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    return [kinds.get(c.lower()) for c in key]


def _written(
    df: DataFrame, path: str, column: str | None, state: State
) -> tuple[int, str | None, tuple[int, ...] | None]:
    """Rows below ``path``, their newest time and their buckets, from one narrow scan of what is stored.

    Spark writes the time as text and reads it back, so both happen in the session's zone.
    """
    newest = F.max(column).cast("string") if column else F.lit(None).cast("string")
    buckets = F.lit(None).cast("array<int>")
    if state.key and _kinds(df.schema, state.key) == _kinds(state.schema, state.key):
        buckets = F.sort_array(F.collect_set(_bucket(state.key, state.n_buckets)))
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    rows, top, touched = stored.agg(F.count(F.lit(1)), newest, buckets).first()
    return rows, top, None if touched is None else tuple(touched)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def export_full(df: DataFrame, base: str, table: str, column: str | None = None) -> Exported:
    """Replace the copy of a table by a new generation of it, with the columns ``df`` has.

    Until the new one is whole and committed readers see the earlier one. It stays for those who
    have opened it and goes with a later full export.
    """
    files = TableFiles(df.sparkSession, base, table)
    state = files.load()
    number = state.generation + 1
    part = Part(f"gen={number}/batch=0.v{state.version + 1}", df.schema)
    _write(df, f"{files.root}/{part.path}")
    rows, top, _ = _written(df, f"{files.root}/{part.path}", column, State())
    files.commit(State(state.version, number, merged(T.StructType([]), df.schema), (part,)))
    return Exported(table, "full", rows, Mark(column, top, 1))


def add_batch(
    df: DataFrame, base: str, table: str, name: str, column: str | None = None
) -> tuple[int, str | None]:
    """Add rows as the batch of that name, in place of one that has it; their number and newest time.

    A type that the table's cannot be widened to raises ``SchemaChange`` before anything is written.
    """
    files = TableFiles(df.sparkSession, base, table)
    state = files.load()
    generation = max(state.generation, 0)
    schema = merged(state.schema or T.StructType([]), df.schema)
    place = f"gen={generation}/batch={name}.v"
    path = f"{place}{state.version + 1}"
    _write(df, f"{files.root}/{path}")
    state = replace(state, generation=generation, schema=schema)
    rows, top, touches = _written(df, f"{files.root}/{path}", column, state)
    others = tuple(p for p in state.parts if not p.path.startswith(place))
    files.commit(replace(state, parts=(*others, Part(path, df.schema, touches=touches))))
    return rows, top


def export_incremental(
    df: DataFrame,
    base: str,
    table: str,
    column: str,
    state: Mark = Mark(),
    overlap: dt.timedelta | None = None,
    newer: Newer | None = None,
) -> Exported:
    """Export the rows after the mark as the next batch; everything when there is none.

    ``newer`` fetches those rows from the source; without it ``df`` is filtered.

    With ``overlap`` the export reaches back that far behind the mark, which catches
    rows that arrived late with an older time. Rows then come twice and reading with a
    key keeps one. Without new rows the mark stays where it is.
    """
    if state.mark is None:
        done = export_full(df, base, table, column)
        return Exported(table, "incremental", done.rows, done.mark)
    start = state.mark
    if overlap is not None:
        start = str(dt.datetime.fromisoformat(state.mark) - overlap)
    delta = newer(table, column, start) if newer else after_mark(df, column, start)
    rows, top = add_batch(delta, base, table, str(state.next_batch), column)
    if top is None:
        return Exported(table, "incremental", rows, state)
    mark = Mark(column, max(top, state.mark), state.next_batch + 1)
    return Exported(table, "incremental", rows, mark)


def _rows(spark: SparkSession, root: str, state: State, parts: Iterable[Part]) -> DataFrame:
    """The rows of some parts as the table's schema has them, bases with their bucket."""
    scans = []
    batches = defaultdict(list)
    for p in parts:
        if p.buckets is None:
            batches[p.schema.json()].append(p)
        elif p.buckets:
            stored = T.StructType([*p.schema.fields, T.StructField(BUCKET, T.IntegerType())])
            scan = spark.read.schema(stored).parquet(f"{root}/{p.path}")
            live = scan.where(F.col(BUCKET).isin(*p.buckets))
            scans.append(fitted(live, T.StructType([*state.schema.fields, stored[BUCKET]])))
    for same in batches.values():
        scan = spark.read.schema(same[0].schema).parquet(*[f"{root}/{p.path}" for p in same])
        scans.append(fitted(scan, state.schema))
    if not scans:
        return spark.createDataFrame([], state.schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _touched(state: State, key: Sequence[str]) -> list[int]:
    """The buckets of the base that rows of the batches may fall into."""
    every = sorted(b for p in state.base for b in p.buckets)
    known = all(p.touches is not None for p in state.batches)
    # Another type of the key hashes otherwise.
    aligned = all(_kinds(p.schema, key) == _kinds(state.schema, key) for p in state.base)
    if not (known and aligned):
        return every
    return sorted({b for p in state.batches for b in p.touches})


def _merge(base: DataFrame, newest: DataFrame, key: Sequence[str], at: str, columns) -> DataFrame:
    """One row per key of two tables that have one per key each: the newer, as ``latest_version`` has it.

    The rows of the base stay where they are; the batches' are broadcast where they are few.
    """
    order = [at, *[c for c in columns if c not in (*key, at)]]
    row = F.struct(*[F.col(f"`{c}`") for c in order])
    late = newest.select(*[F.col(f"`{c}`").alias(f"_sync_k{i}") for i, c in enumerate(key)], row.alias("_sync_late"))
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"`{c}`").eqNullSafe(F.col(f"_sync_k{i}")) for i, c in enumerate(key)],
    )
    # NULL is the least in comparing structs, and a missing struct loses to any.
    both = base.join(late, same, "left").withColumn("_sync_row", F.greatest(row, F.col("_sync_late")))
    kept = both.select(
        *[F.col(f"`{c}`") if c in key else F.col(f"_sync_row.`{c}`").alias(c) for c in columns]
    )
    held = base.select(*[F.col(f"`{c}`").alias(f"_sync_k{i}") for i, c in enumerate(key)])
    return kept.unionByName(newest.join(held, same, "left_anti").select(*[F.col(f"`{c}`") for c in columns]))


def _newest(spark: SparkSession, root: str, state: State, key: Sequence[str], at: str) -> DataFrame:
    """The newest row per key: the base, with the batches merged into the buckets they touch."""
    if not state.base or (state.key, state.at) != (tuple(key), at):
        return latest_version(_rows(spark, root, state, state.parts).drop(BUCKET), list(key), at)
    columns = state.schema.fieldNames()
    base = _rows(spark, root, state, state.base)
    if not state.batches:
        return base.drop(BUCKET)
    touched = F.col(BUCKET).isin(*_touched(state, key))
    late = latest_version(_rows(spark, root, state, state.batches), list(key), at)
    met = _merge(base.where(touched).drop(BUCKET), late, key, at, columns)
    return met.unionByName(base.where(~touched).drop(BUCKET))


def _keys(key: str | Sequence[str]) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)


def _committed(files: TableFiles) -> State:
    state = files.load()
    if state.schema is None:
        raise LookupError(f"{files.root} holds no committed copy")
    return state


def read_synced(
    spark: SparkSession, base: str, table: str, key: str | None = None, at: str | None = None
) -> DataFrame:
    """The copy of a table; with a key and time column only the newest version per key.

    Columns that later batches added are there, NULL in the rows before them, and those that went
    are NULL since. After ``compact`` the versions that lost are gone.
    """
    files = TableFiles(spark, base, table)
    state = _committed(files)
    if key is None:
        return _rows(spark, files.root, state, state.parts).drop(BUCKET)
    return _newest(spark, files.root, state, _keys(key), at)


def compact(
    spark: SparkSession,
    base: str,
    table: str,
    key: str | Sequence[str],
    at: str,
    n_buckets: int | None = None,
) -> State:
    """Fold all batches into a base of the newest row per key, in ``n_buckets`` by the key's hash.

    Only buckets that the batches touch are written anew, unless key, time or number of buckets
    change. Rows are dealt out by bucket and key in ranges, so no task has a whole large bucket.
    Earlier folders stay for readers until ``vacuum`` or a later full export.
    """
    files = TableFiles(spark, base, table)
    state = _committed(files)
    key = _keys(key)
    n_buckets = n_buckets or state.n_buckets or BUCKETS
    fits = (state.key, state.at, state.n_buckets) == (key, at, n_buckets)
    if fits and not state.batches:
        return state
    touched = list(range(n_buckets))
    if fits and all(_kinds(p.schema, key) == _kinds(state.schema, key) for p in state.base):
        touched = _touched(state, key)

    def having(buckets: set[int]) -> list[Part]:
        return [replace(p, buckets=tuple(b for b in p.buckets if b in buckets)) for p in state.base]

    live, left = state, []
    if fits:
        live = replace(state, parts=(*having(set(touched)), *state.batches))
        left = [p for p in having(set(range(n_buckets)) - set(touched)) if p.buckets]
    rows = _newest(spark, files.root, live, key, at)
    part = Part(f"gen={state.generation}/base={state.version + 1}", state.schema, tuple(touched))
    (
        rows.withColumn(BUCKET, _bucket(key, n_buckets))
        .repartitionByRange(BUCKET, *key)
        .sortWithinPartitions(BUCKET, *key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(BUCKET)
        .parquet(f"{files.root}/{part.path}")
    )
    return files.commit(replace(
        state, parts=(*left, part), key=key, at=at, n_buckets=n_buckets
    ))


def vacuum(spark: SparkSession, base: str, table: str) -> list[str]:
    """Delete the folders of a table that its newest commit does not name; their names."""
    return TableFiles(spark, base, table).vacuum()


def load_marks(spark: SparkSession, base: str) -> dict[str, Mark]:
    """The newest mark of every table; empty before the first run."""
    return _load(spark, base)[0]


def _load(spark: SparkSession, base: str) -> tuple[dict[str, Mark], int]:
    try:
        stored = spark.read.schema(_MARKS_SCHEMA).parquet(f"{base}/{MARKS}")
        rows = latest_version(stored, "table_name", "run").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}, 0
    marks = {r.table_name: Mark(r.column_name, r.mark, r.next_batch) for r in rows}
    return marks, max((r.run for r in rows), default=0)


def save_marks(spark: SparkSession, base: str, marks: dict[str, Mark], run: int) -> None:
    """Add marks to the state table. Earlier ones stay, so a crash loses nothing.

    ``run`` grows with every save; the highest one counts.
    """
    rows = [
        F.struct(*map(F.lit, (run, t, m.column, m.mark, m.next_batch))) for t, m in marks.items()
    ]
    kind = T.StructType.fromDDL(_MARKS_SCHEMA).simpleString()
    stored = spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows).cast(f"array<{kind}>")))
    stored.write.mode("append").parquet(f"{base}/{MARKS}")


def sync_all(
    spark: SparkSession,
    source: Source,
    base: str,
    tables: Iterable[str],
    incremental: bool = True,
    overlap: dt.timedelta | None = None,
    at_once: int = 4,
    newer: Newer | None = None,
    whole: Source | None = None,
    keys: dict[str, str | Sequence[str]] | None = None,
    compact_after: int = 50,
) -> list[Exported]:
    """Export every table, some at a time, and save each mark once its rows are written.

    ``source`` opens a table; ``whole``, where given, opens one that is to be read in full.

    A table without a time column is exported in full each time. A full export first
    takes the mark back, so if it fails halfway the next run starts over. Afterwards it
    stores the newest time, and the next incremental run goes on from there. A table that
    cannot be opened or exported does not stop the others; its error is raised when they are
    done. A table among ``keys`` is compacted by its key once it has more than ``compact_after``
    batches.
    """
    marks, run = _load(spark, base)
    runs, saving = itertools.count(run + 1), threading.Lock()

    def save(table: str, mark: Mark) -> None:
        with saving:  # marks share a folder
            save_marks(spark, base, {table: mark}, next(runs))

    def export(table: str) -> Exported:
        df = source(table)
        column = time_column(df.columns)
        before = marks.get(table, Mark())
        if incremental and column is not None and before.mark is not None:
            done = export_incremental(df, base, table, column, before, overlap, newer)
        else:
            if before.mark is not None:
                save(table, Mark(column))
                before = Mark(column)
            done = export_full(whole(table) if whole else df, base, table, column)
            if incremental and column is not None:
                done = Exported(table, "incremental", done.rows, done.mark)
        if done.mark != before:
            save(table, done.mark)
        key = (keys or {}).get(table)
        if key is not None and column is not None:
            if len(TableFiles(spark, base, table).load().batches) > compact_after:
                compact(spark, base, table, key, column)
        return done

    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(export, table) for table in tables]
    return [job.result() for job in running]


def export_all(
    spark: SparkSession, source: Source, base: str, tables: Iterable[str]
) -> list[Exported]:
    return sync_all(spark, source, base, tables, incremental=False)
