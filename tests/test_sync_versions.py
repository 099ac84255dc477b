"""Generations, widening schemas and compaction of synced tables."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.versions import latest_version
from tillmark.schemas import SchemaChange, fitted, merged, widened
from tillmark.sources import sync
from tillmark.sources.commits import State, TableFiles

ROWS = "id long, v string, update_time timestamp_ntz"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def broken(df, rows_before):
    """Rows that end in an error halfway through a write of several files."""
    return df.withColumn(
        "v", F.when(F.col("id") > rows_before, F.expr("raise_error('lost')")).otherwise(F.col("v"))
    )


# -- generations -----------------------------------------------------------------------------


def test_a_failing_full_export_leaves_the_earlier_copy(spark, frame, base):
    first = frame(ROWS, [(i, "a", at(1)) for i in range(50)])
    sync.export_full(first, base, "t", "update_time")
    later = spark.range(0, 4000, 1, 4).select(
        "id", F.lit("b").alias("v"), F.lit(at(2)).cast("timestamp_ntz").alias("update_time")
    )
    with pytest.raises(Exception, match="lost"):
        sync.export_full(broken(later, 2000), base, "t", "update_time")
    assert sync.read_synced(spark, base, "t").count() == 50
    # The next one takes the place of what the failed one left.
    assert sync.export_full(later, base, "t", "update_time").rows == 4000
    assert sync.read_synced(spark, base, "t").where("v = 'b'").count() == 4000


def test_a_failing_batch_leaves_the_copy(spark, frame, base):
    mark = sync.export_incremental(frame(ROWS, [(1, "a", at(1))]), base, "t", "update_time").mark
    more = frame(ROWS, [(2, "b", at(2)), (3, "c", at(3))])
    done = sync.export_incremental(more, base, "t", "update_time", mark)
    for _ in range(2):  # batch 1 over again, as if its mark had been lost, with an error
        with pytest.raises(Exception, match="lost"):
            sync.export_incremental(broken(more, 2), base, "t", "update_time", mark)
        assert sync.read_synced(spark, base, "t").count() == 3
    assert done.rows == 2


def test_a_failing_sync_leaves_the_copy_and_starts_over(spark, frame, base):
    rows = frame(ROWS, [(1, "a", at(1))])
    sync.sync_all(spark, lambda _: rows, base, ["t"])
    with pytest.raises(Exception, match="lost"):
        sync.export_all(spark, lambda _: broken(rows, 0), base, ["t"])
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a", at(1))]
    sync.sync_all(spark, lambda _: rows, base, ["t"])
    assert sync.load_marks(spark, base)["t"].mark == "2024-01-01 00:00:00"


def test_readers_keep_the_generation_they_opened(spark, frame, base):
    sync.export_full(frame(ROWS, [(1, "a", at(1))]), base, "t")
    opened = sync.read_synced(spark, base, "t")
    sync.export_full(frame(ROWS, [(2, "b", at(2))]), base, "t")
    assert rows_of(opened) == [(1, "a", at(1))]
    sync.export_full(frame(ROWS, [(3, "c", at(3))]), base, "t")  # by now the first is gone
    assert [x for x in TableFiles(spark, base, "t")._names("")] == ["gen=1", "gen=2", "log"]
    assert sync.vacuum(spark, base, "t") == ["gen=1"]
    assert rows_of(sync.read_synced(spark, base, "t")) == [(3, "c", at(3))]


def test_commits_are_whole_or_absent(spark, frame, base):
    sync.export_full(frame(ROWS, [(1, "a", at(1))]), base, "t")
    files = TableFiles(spark, base, "t")
    state = files.load()
    assert State.parse(state.dump()) == state
    files.commit(state)
    with pytest.raises(RuntimeError, match="another writer"):
        files.commit(state)
    for _ in range(25):
        files.commit(files.load())
    assert len(files._names("log")) == 10 and files.load().version == 27
    assert sync.read_synced(spark, base, "t").count() == 1
    with pytest.raises(LookupError):
        sync.read_synced(spark, base, "never")


# -- schemas ---------------------------------------------------------------------------------


def kind(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize("old, new, want", [
    ("int", "bigint", "bigint"), ("bigint", "smallint", "bigint"), ("tinyint", "int", "int"),
    ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "decimal(9,4)", "decimal(12,4)"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(30,0)", "bigint", "decimal(30,0)"),
    ("float", "double", "double"), ("int", "double", "double"), ("smallint", "float", "float"),
    ("int", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("string", "string", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,float>", "map<string,double>", "map<string,double>"),
    ("struct<a:int,b:string>", "struct<a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"),
])
def test_widening(old, new, want):
    assert widened(kind(old), kind(new)).simpleString() == want


@pytest.mark.parametrize("old, new", [
    ("bigint", "double"), ("string", "int"), ("int", "boolean"), ("timestamp", "timestamp_ntz"),
    ("decimal(38,0)", "decimal(38,2)"), ("struct<a:int>", "array<int>"), ("date", "timestamp"),
])
def test_what_cannot_be_widened(old, new):
    for a, b in ((old, new), (new, old)):
        with pytest.raises(SchemaChange, match="x: "):
            widened(kind(a), kind(b), "x")


def test_columns_of_both(frame):
    old, new = T.StructType.fromDDL("a int, B string"), T.StructType.fromDDL("b string, c date, A bigint")
    assert merged(old, new).simpleString() == "struct<a:bigint,B:string,c:date>"
    with pytest.raises(SchemaChange):
        merged(old, T.StructType.fromDDL("b string").add("B", "string"))
    df = frame("s struct<p:int,q:array<struct<z:int>>>, m map<string,struct<z:int>>",
               [((1, [(2,)]), {"k": (3,)}), (None, None)])
    wide = T.StructType.fromDDL(
        "s struct<p:bigint,q:array<struct<y:string,z:bigint>>,r:date>, m map<string,struct<z:bigint,w:int>>, n int"
    )
    got = fitted(df, wide)
    assert got.schema.simpleString() == wide.simpleString()
    one, none = got.collect()
    assert (one.s.p, one.s.q[0].z, one.s.q[0].y, one.s.r, one.m["k"].z, one.n) == (1, 2, None, None, 3, None)
    assert none.s is None and none.m is None


def test_a_widened_column_is_read(spark, frame, base):
    """Types grow from batch to batch, columns come and go; values arrive unchanged."""
    mark = sync.export_incremental(
        frame("id int, price decimal(6,2), gone string, update_time date", [(1, D("1.25"), "x", at(1).date())]),
        base, "t", "update_time",
    ).mark
    for row in (
        ("id long, price decimal(12,4), extra string, update_time timestamp_ntz", [(2**40, D("12345678.1234"), "e", at(2))]),
        ("ID smallint, price int, update_time timestamp_ntz", [(3, 7, at(3))]),
    ):
        mark = sync.export_incremental(frame(*row), base, "t", "update_time", mark).mark
    got = sync.read_synced(spark, base, "t")
    assert got.schema.simpleString() == (
        "struct<id:bigint,price:decimal(14,4),gone:string,update_time:timestamp_ntz,extra:string>"
    )
    assert rows_of(got) == sorted([
        (1, D("1.2500"), "x", at(1), None), (2**40, D("12345678.1234"), None, at(2), "e"),
        (3, D("7.0000"), None, at(3), None),
    ], key=str)
    # The test on the wide column reaches the scan of the narrow one.
    plan = got.where("id > 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("greaterthan(id") == 3 and "mergeSchema" not in plan


def test_a_change_of_type_stops_before_writing(spark, frame, base):
    mark = sync.export_incremental(frame(ROWS, [(1, "a", at(1))]), base, "t", "update_time").mark
    other = frame("id long, v int, update_time timestamp_ntz", [(2, 5, at(2))])
    with pytest.raises(SchemaChange, match="v: string became int"):
        sync.export_incremental(other, base, "t", "update_time", mark)
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a", at(1))]
    # A full export begins a generation with columns of its own.
    sync.export_full(other, base, "t", "update_time")
    assert rows_of(sync.read_synced(spark, base, "t")) == [(2, 5, at(2))]


# -- compaction ------------------------------------------------------------------------------


def test_compaction_after_many_batches(spark, frame, base):
    r = random.Random(7)
    every = [(k, f"v{r.randrange(9)}", r.choice([at(1), at(2, r.randrange(24)), None])) for k in range(200)]
    every += [(None, "null key", at(1))]
    mark = sync.export_incremental(frame(ROWS, every), base, "t", "update_time").mark
    compacted_at = {6, 13}
    for i in range(1, 17):
        batch = [
            (r.choice([*range(220), None]), f"v{r.randrange(9)}", r.choice([at(1), at(2 + i), at(2 + i, 5), None]))
            for _ in range(6)
        ]
        if i == 9:
            batch = []
        every += batch
        sync.add_batch(frame(ROWS, batch), base, "t", str(i), "update_time")
        if i in compacted_at:
            state = sync.compact(spark, base, "t", "id", "update_time", n_buckets=8)
            assert state.batches == () and sorted(b for p in state.base for b in p.buckets) == list(range(8))
        want = latest_version(frame(ROWS, every), "id", "update_time")
        assert rows_of(sync.read_synced(spark, base, "t", "id", "update_time")) == rows_of(want)
    state = TableFiles(spark, base, "t").load()
    assert len(state.batches) == 3 and mark.next_batch == 1
    # Files of the base are read once each for their rows, and for the keys of buckets met.
    plan = sync.read_synced(spark, base, "t", "id", "update_time")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "sync_bucket" in text and "PartitionFilters" in text
    # By another key or without one nothing is cut.
    assert sync.read_synced(spark, base, "t").count() >= 201 + 12
    by_v = sync.read_synced(spark, base, "t", "v", "update_time")
    assert by_v.count() == by_v.select("v").distinct().count()
    before = rows_of(sync.read_synced(spark, base, "t", "id", "update_time"))
    assert sync.vacuum(spark, base, "t")
    assert rows_of(sync.read_synced(spark, base, "t", "id", "update_time")) == before


def test_untouched_buckets_stay_as_they_are(spark, frame, base):
    sync.export_full(frame(ROWS, [(k, "a", at(1)) for k in range(300)]), base, "t", "update_time")
    first = sync.compact(spark, base, "t", ["id"], "update_time", n_buckets=16)
    sync.add_batch(frame(ROWS, [(5, "b", at(2)), (1000, "n", at(2))]), base, "t", "1", "update_time")
    state = TableFiles(spark, base, "t").load()
    assert 1 <= len(state.batches[0].touches) <= 2
    second = sync.compact(spark, base, "t", ["id"], "update_time")
    old, new = second.base
    assert old.path == first.base[0].path and set(new.buckets) == set(state.batches[0].touches)
    assert set(old.buckets) | set(new.buckets) == set(range(16)) and not set(old.buckets) & set(new.buckets)
    got = {r.id: r.v for r in sync.read_synced(spark, base, "t", "id", "update_time").collect()}
    assert len(got) == 301 and got[5] == "b" and got[1000] == "n" and got[6] == "a"
    assert sync.compact(spark, base, "t", ["id"], "update_time") == second  # nothing to do


def test_a_key_that_widens_after_compaction(spark, frame, base):
    sync.export_full(frame("id int, v string, t int", [(k, "a", 1) for k in range(40)]), base, "t", "t")
    sync.compact(spark, base, "t", "id", "t", n_buckets=4)
    sync.add_batch(frame("id long, v string, t int, w date", [(3, "b", 2, None), (2**40, "n", 2, at(1).date())]), base, "t", "1", "t")
    want = {k: "a" for k in range(40)} | {3: "b", 2**40: "n"}
    for _ in range(2):
        got = {r.id: r.v for r in sync.read_synced(spark, base, "t", "id", "t").collect()}
        assert got == want
        state = sync.compact(spark, base, "t", "id", "t")
    assert len(state.base) == 1


def test_sync_compacts_by_itself(spark, frame, base):
    rows = []
    for i in range(1, 8):
        rows.append((i % 3, f"v{i}", at(i)))
        sync.sync_all(spark, lambda _: frame(ROWS, rows), base, ["t"], keys={"t": "id"}, compact_after=3)
    state = TableFiles(spark, base, "t").load()
    assert state.base and len(state.batches) <= 3
    assert rows_of(sync.read_synced(spark, base, "t", "id", "update_time")) == rows_of(
        latest_version(frame(ROWS, rows), "id", "update_time")
    )
