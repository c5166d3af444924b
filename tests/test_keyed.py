import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowwarden.operators import keyed, metrics, reconcile, routing
from rowwarden.sources import tables


def test_partial_update_keeps_old_value(spark):
    log = spark.createDataFrame([(1, 1, "a", 5), (1, 2, None, 6), (1, 3, "c", None)], "k int, at int, a string, b int")
    row = keyed.merge_partial(log, ["k"], ["at"], ["a", "b"]).first()
    assert (row.a, row.b) == ("c", 6)


def test_latest_is_cut_before_the_shuffle(spark):
    log = spark.range(100).selectExpr("id % 3 AS k", "id AS at")
    latest = keyed.latest_by_key(log, ["k"], ["at"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # per map task, and after the shuffle
    assert sorted((r.k, r.at) for r in latest.collect()) == [(0, 99), (1, 97), (2, 98)]


def test_changes_after_snapshot(spark):
    cols = "k int, v string, op string, at int"
    image = spark.createDataFrame([(1, "a", "r", 0), (2, "b", "r", 0), (3, "c", "r", 0)], cols)
    log = spark.createDataFrame([(1, "x", "u", 1), (2, None, "d", 2), (4, "n", "c", 3), (4, None, "d", 4), (4, "m", "c", 5)], cols)
    got = keyed.apply_changes(image, log, ["k"], ["at"]).collect()
    assert sorted((r.k, r.v) for r in got) == [(1, "x"), (3, "c"), (4, "m")]


def test_insert_if_absent_takes_the_first(spark):
    table = spark.createDataFrame([(1, "old")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new", 1), (2, "first", 1), (2, "second", 2)], "k int, v string, at int")
    got = keyed.insert_if_absent(table, incoming, ["k"], ["at"]).collect()
    assert sorted((r.k, r.v) for r in got) == [(1, "old"), (2, "first")]


def test_snapshot_diff_sees_nulls(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "b"), (4, None)], "k int, v string")
    got = reconcile.snapshot_diff(before, after, "k", F.lit("now")).collect()
    assert sorted((r.operation, r.k, r.v) for r in got) == [("DELETED", 3, "c"), ("INSERTED", 4, None), ("UPDATED", 2, "b")]


def test_stalled_windows_across_midnight(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 50), True), (dt.datetime(2024, 1, 2, 0, 7), False), (dt.datetime(2024, 1, 2, 0, 12), True)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, ok boolean")
    got = sorted(r[0] for r in metrics.stalled_windows(df, "at", 5, F.col("ok")).collect())
    assert got == [dt.datetime(2024, 1, 1, 23, 55), dt.datetime(2024, 1, 2, 0, 0), dt.datetime(2024, 1, 2, 0, 5)]


def test_split_loses_no_row(spark):
    df = spark.createDataFrame([(1, "VALID"), (2, "INVALID"), (3, None)], "n int, dq_status string")
    good, bad = routing.split_by_status(df)
    assert [r.n for r in good.collect()] == [1] and sorted(r.n for r in bad.collect()) == [2, 3]


def test_duplicate_flag_with_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, s string")
    got = sorted((r.k, r.duplicate_check) for r in metrics.duplicate_flag(df, ["k", "s"]).collect())
    assert got == [(1, "FAIL"), (1, "FAIL"), (2, "PASS")]


def test_snapshot_diff_sees_new_columns_and_rows_without_a_key(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    after = spark.createDataFrame([(1, "a", None), (2, "b", 5), (None, "n", None)], "k int, v string, extra int")
    got = reconcile.snapshot_diff(before, after, "k", F.lit("now")).collect()
    assert sorted((r.operation, r.k or 0, r.extra or 0) for r in got) == [("DELETED", 0, 0), ("INSERTED", 0, 0), ("UPDATED", 2, 5)]


@pytest.mark.parametrize("minutes", [5, 7, 13, 1440, 1000])
def test_stalled_windows_of_any_size(spark, minutes):
    rows = [(f"2024-01-0{d} {h:02d}:17:00", h % 5 != 0) for d in range(1, 6) for h in range(24)]
    df = spark.createDataFrame(rows, "at string, ok boolean").select(F.col("at").cast("timestamp_ntz").alias("at"), "ok")
    got = {r[0] for r in metrics.stalled_windows(df, "at", minutes, F.col("ok")).collect()}
    slot = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp()) // (60 * minutes)
    times = [(dt.datetime.fromisoformat(a), ok) for a, ok in rows]
    good = {slot(t) for t, ok in times if ok}
    slots = [slot(t) for t, _ in times]
    assert {slot(t) for t in got} == {s for s in range(min(slots), max(slots) + 1) if s not in good}


def test_range_and_mark_reads(spark, tmp_path):
    rows = spark.range(300).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("id"), F.col("id").alias("at"))
    parts = [tables.key_range(rows, "id", 8, a, b).count() for a, b in ((0, 3), (3, 4), (4, 8))]
    assert sum(parts) == 300 and all(parts)
    store = str(tmp_path / "mark")
    seen = []
    for upto in (100, 100, 250, 300):
        fresh, commit = tables.read_since_mark(spark, rows.where(F.col("at") < upto), "at", store)
        seen.append(fresh.count())
        commit()
    assert seen == [100, 0, 150, 50]
