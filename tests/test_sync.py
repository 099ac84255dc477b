import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark import session
from tillmark.operators.versions import latest_version
from tillmark.plans.sync_job import arguments
from tillmark.schemas import REFERENCES, SCHEMAS, conform, required_columns, spark_type, struct_of
from tillmark.sources import sync, tables
from tillmark.streaming.landing import follow_landing

ROWS = "id long, v string, update_time timestamp_ntz"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def rows_of(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_incremental_runs(spark, frame, base):
    first = frame(ROWS, [(1, "a", at(1)), (2, "b", at(2))])
    done = sync.export_incremental(first, base, "t", "update_time")
    assert (done.rows, done.mark) == (2, sync.Mark("update_time", "2024-01-02 00:00:00", 1))

    same = sync.export_incremental(first, base, "t", "update_time", done.mark)
    assert (same.rows, same.mark) == (0, done.mark)

    changed = frame(ROWS, [(1, "a", at(1)), (2, "B", at(3)), (3, "c", at(4))])
    last = sync.export_incremental(changed, base, "t", "update_time", done.mark)
    assert (last.rows, last.mark.mark, last.mark.next_batch) == (2, "2024-01-04 00:00:00", 2)
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]
    assert rows_of(sync.read_synced(spark, base, "t", "id", "update_time")) == [
        (1, "a"), (2, "B"), (3, "c")
    ]


def test_a_repeated_batch_leaves_no_second_copy(spark, frame, base):
    done = sync.export_incremental(frame(ROWS, [(1, "a", at(1))]), base, "t", "update_time")
    more = frame(ROWS, [(1, "a", at(1)), (2, "b", at(2))])
    for _ in range(2):  # the second time as if the mark had not been saved
        sync.export_incremental(more, base, "t", "update_time", done.mark)
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a"), (2, "b")]


def test_overlap_catches_late_rows_of_the_same_time(spark, frame, base):
    first = frame(ROWS, [(1, "a", at(1, 12))])
    mark = sync.export_incremental(first, base, "t", "update_time").mark
    late = frame(ROWS, [(1, "a", at(1, 12)), (2, "late", at(1, 12))])
    assert sync.export_incremental(late, base, "t", "update_time", mark).rows == 0
    again = sync.export_incremental(late, base, "t", "update_time", mark, dt.timedelta(hours=1))
    assert again.mark.mark == mark.mark
    assert rows_of(sync.read_synced(spark, base, "t", "id", "update_time")) == [
        (1, "a"), (2, "late")
    ]


def test_a_source_may_select_newer_rows_itself(spark, frame, base):
    rows = frame(ROWS, [(1, "a", at(1)), (2, "b", at(2))])
    asked = []

    def newer(table, column, mark):
        asked.append((table, column, mark))
        return rows.where("id = 2")

    sync.sync_all(spark, lambda _: rows.where("id = 1"), base, ["t"], newer=newer)
    done = sync.sync_all(spark, lambda _: rows, base, ["t"], newer=newer)
    assert asked == [("t", "update_time", "2024-01-01 00:00:00")] and done[0].rows == 1


def test_sync_all_marks_and_tables_without_a_time(spark, frame, base):
    state = {"t": frame(ROWS, [(1, "a", at(1))]), "u": frame("id long, v string", [(1, "x")])}
    assert sync.load_marks(spark, base) == {}
    first = sync.sync_all(spark, state.__getitem__, base, state)
    assert [(d.table, d.mode, d.rows) for d in first] == [("t", "incremental", 1), ("u", "full", 1)]
    state["t"] = frame(ROWS, [(1, "a", at(1)), (2, "b", at(2))])
    second = sync.sync_all(spark, state.__getitem__, base, state)
    assert [d.rows for d in second] == [1, 1]
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a"), (2, "b")]
    assert rows_of(sync.read_synced(spark, base, "u")) == [(1, "x")]

    full = sync.export_all(spark, state.__getitem__, base, ["t"])
    assert (full[0].mode, full[0].rows) == ("full", 2)
    # A full run stores its mark, so the next incremental run has nothing to do.
    assert sync.load_marks(spark, base)["t"].mark == "2024-01-02 00:00:00"
    assert sync.sync_all(spark, state.__getitem__, base, ["t"])[0].rows == 0
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a"), (2, "b")]


def test_marks_of_zoned_times_hold_in_any_session_zone(spark, base):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        df = spark.sql("SELECT 1L AS id, timestamp'2024-01-01 10:00:00.5' AS update_time")
        done = sync.export_incremental(df, base, "t", "update_time")
        assert done.mark.mark == "2024-01-01 10:00:00.5"
        again = sync.export_incremental(df, base, "t", "update_time", done.mark)
        assert again.rows == 0
        back = sync.export_incremental(
            df, base, "t", "update_time", done.mark, dt.timedelta(minutes=1)
        )
        assert back.rows == 1 and back.mark.mark == done.mark.mark
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_failed_full_run_starts_over(spark, frame, base):
    state = {"t": frame(ROWS, [(1, "a", at(1))])}
    sync.sync_all(spark, state.__getitem__, base, state)
    broken = frame(ROWS, [(2, "b", at(2))]).selectExpr(
        "id", "raise_error('lost') AS v", "update_time"
    )
    with pytest.raises(Exception, match="lost"):
        sync.sync_all(spark, lambda _: broken, base, ["t"], incremental=False)
    assert sync.load_marks(spark, base)["t"].mark is None
    again = sync.sync_all(spark, state.__getitem__, base, state)
    assert again[0].rows == 1
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a")]


def test_latest_version_ties_and_missing_times(frame):
    df = frame(ROWS, [(1, "a", at(1)), (1, "b", at(1)), (2, "old", None), (2, "new", at(1)),
                      (3, "only", None)])
    want = [(1, "b"), (2, "new"), (3, "only")]
    assert rows_of(latest_version(df, "id", "update_time")) == want
    assert rows_of(latest_version(df.repartition(5), "id", "update_time")) == want
    plan = latest_version(df, "id", "update_time")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_landing_stream_takes_new_files_once(spark, frame, base):
    landing = f"{base}/landing"
    schema = T.StructType.fromDDL(ROWS)

    def take():
        follow_landing(spark, landing, schema, base, "t", f"{base}/offsets")
        return rows_of(sync.read_synced(spark, base, "t", "id", "update_time"))

    tables.append_rows(frame(ROWS, [(1, "a", at(1)), (2, "b", at(1))]), landing)
    assert take() == [(1, "a"), (2, "b")]
    tables.append_rows(frame(ROWS, [(2, "B", at(2))]), landing)
    assert take() == [(1, "a"), (2, "B")]
    assert take() == [(1, "a"), (2, "B")]
    assert sync.read_synced(spark, base, "t").count() == 3


def test_writers(spark, frame, base):
    df = frame("id long", [(1,), (2,)])
    tables.append_rows(df, f"{base}/x/t")
    tables.append_rows(df, f"{base}/x/t")
    assert tables.read_table(spark, f"{base}/x", "t").count() == 4
    tables.replace_rows(df, f"{base}/x/t")
    assert tables.read_table(spark, f"{base}/x", "t", T.StructType.fromDDL("id long")).count() == 2


def test_files_in_time_order_cover_short_spans(spark, base):
    df = spark.range(4000).repartition(4).select(
        "id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,id % 97)").alias("t")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables.write_by_time(df, base, "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = (
        spark.read.parquet(base).groupBy(F.input_file_name().alias("f"))
        .agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("t").alias("n")).orderBy("a")
        .collect()
    )
    assert len(spans) > 1 and sum(s.n for s in spans) == 4000
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))


def test_the_mark_reaches_the_scan(spark, frame, base):
    tables.append_rows(frame(ROWS, [(1, "a", at(1))]), base)
    newer = tables.after_mark(spark.read.parquet(base), "update_time", "2024-01-01 00:00:00")
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(update_time" in plan
    assert newer.count() == 0


def test_time_column():
    assert tables.time_column(["id", "create_time", "update_time"]) == "update_time"
    assert tables.time_column(["id", "create_time"]) == "create_time"
    assert tables.time_column(["id"]) is None


def test_types():
    found = {k: spark_type(k).simpleString() for k in (
        "int(11)", "tinyint(1)", "bigint(20)", "decimal(5,2)", "varchar(255)", "text", "datetime",
        "date", "double", "bool")}
    assert found == {
        "int(11)": "int", "tinyint(1)": "int", "bigint(20)": "bigint", "decimal(5,2)": "decimal(5,2)",
        "varchar(255)": "string", "text": "string", "datetime": "timestamp_ntz", "date": "date",
        "double": "double", "bool": "boolean",
    }
    assert struct_of([("a", "int(11)")]).simpleString() == "struct<a:int>"


def test_schemas_and_references():
    assert len(SCHEMAS) == 13
    assert SCHEMAS["member_level"]["discount"].dataType == T.DecimalType(3, 2)
    assert required_columns("user_behavior") == ["id", "user_id", "behavior_type"]
    assert len(REFERENCES) == 14
    for r in REFERENCES:
        assert r.column in SCHEMAS[r.child].fieldNames() and r.parent in SCHEMAS
        assert r.on_delete in ("cascade", "set null")


def test_conform_names_what_does_not_fit(frame):
    df = frame("id string, username string, age string", [("1", "a", "30"), (None, "b", "old")])
    good, bad = conform(df, SCHEMAS["py_user"]).orderBy("username").collect()
    assert (good.id, good.age, good.role, good.invalid_columns) == (1, 30, None, [])
    assert bad.invalid_columns == ["id", "age"] and bad.age is None


def test_jdbc_options():
    db = tables.Jdbc("jdbc:mysql://db/shop?useSSL=false", {"user": "u"})
    assert db.options() == {"url": "jdbc:mysql://db/shop?useSSL=false&tinyInt1isBit=false", "user": "u"}
    assert tables.Jdbc("jdbc:other:x").options() == {"url": "jdbc:other:x"}
    assert tables.split_options("id", 1, 9, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"
    }


def test_job_modes():
    base = ["--url", "jdbc:x", "--base", "/b"]
    assert not arguments(base).full and arguments([*base, "--full"]).full
    assert arguments([*base, "--hook"]).hook
    with pytest.raises(SystemExit):
        arguments([*base, "--full", "--hook"])


def test_views_are_no_tables(spark, frame):
    frame("id long", [(1,)]).createOrReplaceTempView("listed_here")
    assert "listed_here" not in tables.list_tables(spark)


def test_a_failing_table_stops_no_other(spark, frame, base):
    def source(table):
        if table == "lost":
            raise RuntimeError("no such table")
        return frame(ROWS, [(1, "a", at(1))])

    with pytest.raises(RuntimeError, match="no such table"):
        sync.sync_all(spark, source, base, ["lost", "t"])
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a")]
    assert set(sync.load_marks(spark, base)) == {"t"}


def test_full_export_under_dynamic_overwrite(spark, frame, base):
    rows = frame(ROWS, [(1, "a", at(1))])
    mark = sync.export_incremental(rows, base, "t", "update_time").mark
    more = frame(ROWS, [(1, "a", at(1)), (2, "b", at(2))])
    sync.export_incremental(more, base, "t", "update_time", mark)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert sync.export_full(more, base, "t", "update_time").rows == 2
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows_of(sync.read_synced(spark, base, "t")) == [(1, "a"), (2, "b")]


def test_an_added_column_is_read(spark, frame, base):
    mark = sync.export_incremental(frame(ROWS, [(1, "a", at(1))]), base, "t", "update_time").mark
    wider = frame(ROWS + ", extra int", [(2, "b", at(2), 7)])
    sync.export_incremental(wider, base, "t", "update_time", mark)
    got = {r.id: r.extra for r in sync.read_synced(spark, base, "t").collect()}
    assert got == {1: None, 2: 7}


def test_marks_that_cannot_be_read_are_no_missing_marks(spark, frame, base):
    frame("run string", [("x",)]).write.text(f"{base}/{sync.MARKS}")
    with pytest.raises(Exception):
        sync.load_marks(spark, base)


def test_landing_with_lost_offsets_and_two_folders(spark, frame, base):
    schema = T.StructType.fromDDL(ROWS)
    tables.append_rows(frame(ROWS, [(i, "a", at(1)) for i in range(5)]), f"{base}/one")
    tables.append_rows(frame(ROWS, [(i, "b", at(2)) for i in range(4, 7)]), f"{base}/two")
    follow_landing(spark, f"{base}/one", schema, base, "t", f"{base}/offsets1")
    follow_landing(spark, f"{base}/two", schema, base, "t", f"{base}/offsets2")
    assert sync.read_synced(spark, base, "t").count() == 8
    follow_landing(spark, f"{base}/one", schema, base, "t", f"{base}/offsets3")
    assert rows_of(sync.read_synced(spark, base, "t", "id", "update_time")) == [
        (0, "a"), (1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b"), (6, "b")
    ]


def test_shared_dir_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == folder.rstrip("/")
    a, b = session.new_dir(spark, "x"), session.new_dir(spark, "x")
    assert a != b and a.startswith(folder)
