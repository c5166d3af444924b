"""Every streaming operator gives what its batch form gives, over several micro-batches."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowwarden.operators import anomaly, joins as batch_joins, metrics, ordered, routing, rules
from rowwarden.plans import anomalies, inputs
from rowwarden.plans.registry import CONFIG
from rowwarden.streaming import joins, quality, sinks, sources, stateful, windows

PARTS = 4
CLOSING = 10**15  # key of the row that closes a stream
CUTS = "ntile(4) over (order by ts, event_id)"


@pytest.fixture(scope="module")
def events(spark, folder, tmp_path_factory):
    """The events in time order, cut in files that become micro-batches one by one."""
    root = str(tmp_path_factory.mktemp("events"))
    rows = inputs.dirty_events(spark, folder).join(inputs.events(spark, folder).select("event_id", "ts", "value"), "event_id")
    rows = rows.withColumn("part", F.expr(CUTS))
    for part in range(1, PARTS + 1):
        rows.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(root)
    return root, spark.read.parquet(root)


def stream(spark, events):
    root, stored = events
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema)
    return sources.files(spark, root, schema, "parquet", per_trigger=1)


def finish(query):
    assert query.awaitTermination(180)
    if query.exception():
        raise query.exception()
    return query


def collected(spark, df, tmp_path, mode="append", shape=None):
    """All rows a stream has put out, with the batch that did."""
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    query = finish(sinks.start(shape(df) if shape else df, sinks.replay_safe(out), check, mode=mode))
    return sinks.read_output(spark, out), query


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_micro_batches_and_processing_time(spark, events, tmp_path):
    got, _ = collected(spark, sources.stamped(stream(spark, events)), tmp_path)
    assert got.select("batch_id").distinct().count() >= 3
    assert got.count() == events[1].count() and got.where("proc_ts is null").count() == 0


@pytest.mark.parametrize("delay", ["0 seconds", "5 seconds", "30 seconds"])
def test_tumbling_counters(spark, events, tmp_path, delay):
    live = windows.watermarked(stream(spark, events).where("event_ts is not null"), "event_ts", delay)
    good = F.col("val") >= 0
    got, _ = collected(spark, metrics.window_counter(live, "event_ts", "1 minute", good, "n"), tmp_path)
    stored = events[1].withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    expected = bag(metrics.window_counter(stored, "event_ts", "1 minute", good, "n"), "metric_ts", "n")
    # the last windows stay open until the watermark passes them
    found = bag(got, "metric_ts", "n")
    assert not found - expected and sum(expected.values()) - sum(found.values()) <= 2


def test_sliding_stats(spark, events, tmp_path):
    live = windows.watermarked(stream(spark, events), "event_ts", "5 seconds")
    args = (["event_type"], "event_ts", "val", "1 minute", "30 seconds")
    got, _ = collected(spark, metrics.window_stats(live, *args), tmp_path)
    stored = events[1].withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    columns = ["event_type", "window_start", "n", F.round("mean", 6), F.round("stddev", 6)]
    found, expected = bag(got, *columns), bag(metrics.window_stats(stored, *args), *columns)
    assert not found - expected and sum(expected.values()) - sum(found.values()) <= 4


def test_windowed_words(spark, events, tmp_path):
    live = windows.watermarked(stream(spark, events), "ts", "0 seconds")
    got, _ = collected(spark, metrics.word_counts(live, "email", "ts"), tmp_path, mode="update")
    latest = got.groupBy("word", "window_start").agg(F.max("count").alias("count"))
    expected = metrics.word_counts(events[1].withColumn("ts", F.col("ts").cast("timestamp")), "email", "ts")
    assert bag(latest, "word", "window_start", "count") == bag(expected, "word", "window_start", "count")


def test_update_mode_of_a_changing_count(spark, events, tmp_path):
    """Counts that change go out as updates; their latest version is the batch result."""
    counted = stream(spark, events).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    sinks_path = tmp_path / "out"
    finish(sinks.start(counted, sinks.replay_safe(str(sinks_path)), str(tmp_path / "check"), mode="update"))
    latest = sinks.latest_rows(spark, str(sinks_path), ["event_type"], ["n"])
    assert bag(latest, "event_type", "n") == bag(metrics.count_by(events[1], "event_type", "n"), "event_type", "n")
    with pytest.raises(Exception, match="(?i)append"):
        sinks.start(counted, sinks.replay_safe(str(sinks_path)), str(tmp_path / "other"), mode="append")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    root = str(tmp_path / "in")
    base = dt.datetime(2024, 1, 1)
    for minutes in ([0, 30], [60], [1]):  # minute 1 comes when the watermark is past it
        rows = [(base + dt.timedelta(minutes=m), 1) for m in minutes]
        spark.createDataFrame(rows, "at timestamp, n int").coalesce(1).write.mode("append").parquet(root)
    live = windows.watermarked(sources.files(spark, root, "at timestamp, n int", "parquet", 1), "at", "5 seconds")
    got, query = collected(spark, metrics.window_counter(live, "at", "1 minute", F.lit(True), "n"), tmp_path)
    assert windows.late_rows(query) == 1
    assert {r.metric_ts for r in got.collect()} >= {base + dt.timedelta(minutes=1), base + dt.timedelta(minutes=31)}


def test_deduplication(spark, events, tmp_path):
    live = windows.watermarked(stream(spark, events), "ts", "5 seconds")
    twice = live.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    got, _ = collected(spark, windows.deduplicated(twice, ["event_id", "ts"]), tmp_path)
    assert bag(got, "event_id") == bag(events[1], "event_id")


@pytest.mark.parametrize("fold", [ordered.RunningZScore(1.5), ordered.Ewma(0.05, 1.5)])
def test_stateful_folds(spark, events, tmp_path, fold):
    live = stateful.fold_stream(stream(spark, events).select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], "value", fold)
    got, _ = collected(spark, live, tmp_path)
    expected = ordered.ordered_scan(events[1].select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "value", fold)
    columns = ["event_id", F.round("z", 8), "is_anomaly"]
    assert bag(got, *columns) == bag(expected, *columns)
    assert got.where("is_anomaly").count() > 0


@pytest.fixture(scope="module")
def two_sides(spark, folder, tmp_path_factory):
    """Both hash streams in time order, a closing row on each to move the watermark on."""
    roots = []
    columns = {"onprem": ("pk", "hash_onprem", "event_ts"), "cloud": ("pk", "hash_cloud", "cloud_ts")}
    for name, (key, digest, at) in columns.items():
        root = str(tmp_path_factory.mktemp(name))
        rows = getattr(inputs, name)(spark, folder).where("pk is not null").select(key, digest, F.col(at).cast("timestamp").alias(at))
        rows = rows.withColumn("part", F.expr(f"year({at}) div 3"))
        for (part,) in sorted(rows.select("part").distinct().collect()):
            rows.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(root)
        end = spark.createDataFrame([(CLOSING, None, dt.datetime(2030, 1, 1))], f"{key} bigint, {digest} string, {at} timestamp")
        end.coalesce(1).write.mode("append").parquet(root)
        roots.append((root, f"{key} bigint, {digest} string, {at} timestamp"))
    return roots


@pytest.mark.parametrize("how, low, high", [("leftOuter", 0, 900), ("fullOuter", -600, 600)])
def test_interval_joins(spark, two_sides, tmp_path, how, low, high):
    (left_root, left_schema), (right_root, right_schema) = two_sides
    left = windows.watermarked(sources.files(spark, left_root, left_schema, "parquet", 1), "event_ts")
    right = windows.watermarked(sources.files(spark, right_root, right_schema, "parquet", 1), "cloud_ts")
    got, _ = collected(spark, joins.interval_join(left, right, ["pk"], "event_ts", "cloud_ts", low, high, how), tmp_path)
    expected = batch_joins.interval_join(
        spark.read.parquet(left_root), spark.read.parquet(right_root), ["pk"], "event_ts", "cloud_ts", low, high,
        "left" if how == "leftOuter" else "full",
    )
    real = F.coalesce("pk", "_r_pk") != CLOSING
    columns = ["pk", "event_ts", "_r_pk", "cloud_ts"]
    assert bag(got.where(real), *columns) == bag(expected.where(real), *columns)


def test_unbounded_join_of_streams_is_refused_and_stored_side_works(spark, events, tmp_path):
    live = stream(spark, events)
    with pytest.raises(Exception, match="(?i)watermark|not supported"):
        sinks.start(live.join(stream(spark, events).select("event_id", F.col("val").alias("v")), "event_id", "left"),
                    sinks.replay_safe(str(tmp_path / "no")), str(tmp_path / "no-check"))
    stored = events[1].groupBy("user_id").agg(F.max("value").alias("top"))
    got, _ = collected(spark, joins.with_stored(live, stored, ["user_id"]), tmp_path)
    assert bag(got, "event_id", "top") == bag(events[1].join(stored, "user_id", "left"), "event_id", "top")


def test_several_outputs_partition_the_stream(spark, events, tmp_path):
    root = str(tmp_path / "out")
    ok = F.coalesce(F.col("val") >= 0, F.lit(False))
    outputs = {"valid": (ok, None), "invalid": (~ok, lambda df: routing.keyed_message(df.select("event_id", "val"), "event_id"))}
    finish(sinks.start(stream(spark, events), sinks.fan_out(outputs, root), str(tmp_path / "check")))
    valid, invalid = (sinks.read_output(spark, f"{root}/{n}") for n in outputs)
    assert valid.count() + invalid.count() == events[1].count()
    assert valid.where("val < 0 or val is null").count() == 0 and set(invalid.columns) == {"key", "value", "batch_id"}


def test_dual_write(spark, events, tmp_path):
    paths = [str(tmp_path / "a"), str(tmp_path / "b")]
    finish(sinks.start(stream(spark, events), sinks.dual_write(paths), str(tmp_path / "check")))
    a, b = (bag(sinks.read_output(spark, p), "event_id", "batch_id") for p in paths)
    assert a == b and sum(a.values()) == events[1].count()


def test_replay_of_a_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    handler = sinks.replay_safe(path, partition_by=["dq_date"], sort_by=["n"])
    first, second = (spark.range(s, s + 20).selectExpr("id AS n", "date'2024-01-01' + cast(id % 3 AS int) AS dq_date") for s in (0, 20))
    handler(first, 0)
    handler(second, 1)
    before = bag(sinks.read_output(spark, path), "n", "dq_date", "batch_id")
    handler(second, 1)
    handler(first, 0)
    assert bag(sinks.read_output(spark, path), "n", "dq_date", "batch_id") == before and sum(before.values()) == 40


def test_restart_goes_on_from_the_checkpoint(spark, events, tmp_path):
    root, _ = events
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):
        finish(sinks.start(stream(spark, events), sinks.replay_safe(out), check))
    assert bag(sinks.read_output(spark, out), "event_id") == bag(events[1], "event_id")


def test_failure_policy(spark, events, tmp_path):
    def gone(df, batch_id):
        raise OSError("sink is gone")

    letters = str(tmp_path / "letters")
    for policy in (sinks.with_failure_policy(gone), sinks.with_failure_policy(gone, letters, "event_id")):
        with pytest.raises(OSError):  # not the rows' fault: the batch is to be run again
            policy(events[1], 0)

    bad = {"a": (F.lit(True), None), "b": (F.lit(True), lambda d: d.select(F.col("event_type").cast("int"))), "c": (F.lit(True), None)}
    root = str(tmp_path / "out")
    policy = sinks.with_failure_policy(sinks.fan_out(bad, root), letters, "event_id")
    finish(sinks.start(stream(spark, events), policy, str(tmp_path / "check")))
    got = sinks.read_output(spark, letters)
    assert got.count() == events[1].count()
    assert not any((tmp_path / "out" / name).exists() for name in bad)  # a batch is in all outputs or in none


def test_replay_under_dynamic_overwrite_and_few_files(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(4000).select("id", (F.col("id") % 5).alias("day"), (F.col("id") % 3).alias("kind")).repartition(16)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_batch(rows, out, 0, ["day"], ["kind"])
        sinks.write_batch(rows.where("day < 2"), out, 0, ["day"], ["kind"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    got = sinks.read_output(spark, out)
    assert {r.day for r in got.select("day").distinct().collect()} == {0, 1}
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert len(files) <= 2 * sinks.LANES


def test_results_store_follows_the_document(spark, tmp_path):
    outputs = rules.read_document(CONFIG / "site_rules_v1.yaml")["outputs"]
    rows = spark.range(40).select(F.col("id").alias("order_key"), F.lit("OK").alias("dq_status"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("d"))
    sinks.results_store(str(tmp_path), outputs, F.col("d"))(rows, 0)
    kept = sinks.kept_results(spark, str(tmp_path), outputs, F.lit("2024-02-09"))
    assert sorted(r.order_key for r in kept.collect()) == list(range(25, 40))


def test_compacted_state_equals_the_log(spark, tmp_path):
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    for batch in range(4):
        rows = spark.range(30).select((F.col("id") % 7).alias("k"), F.col("id").alias("at"), (F.col("id") * 10 + batch).alias("v"))
        sinks.write_batch(rows, log, batch)
        if batch == 1:
            assert sinks.compact(spark, log, state, ["k"], ["at"], 1) == 1
    want = bag(sinks.latest_rows(spark, log, ["k"], ["at"]), "k", "at", "v")
    assert bag(sinks.compacted_rows(spark, log, state, 1, ["k"], ["at"]), "k", "at", "v") == want


@pytest.mark.parametrize("fold", [ordered.Ewma(0.1, 2.0), ordered.RunningZScore(1.5), ordered.RunningSum()], ids=lambda f: type(f).__name__)
def test_batched_fold_of_a_hot_key(spark, tmp_path, fold):
    """Nine rows in ten have one key, whole files come at once, and a batch is run twice."""
    rows = [(i, "hot" if i % 10 else f"k{i % 70}", float((i * 37) % 101), None if i % 31 == 0 else float((i * 53) % 97)) for i in range(1500)]
    stored = spark.createDataFrame(rows, "i int, key string, pad double, v double")
    names = [n for n, _ in fold.outputs]
    want = {r.i: r for r in ordered.ordered_scan(stored, ["key"], ["i"], "v", fold, 5).collect()}
    out = str(tmp_path / "out")
    handler = stateful.fold_batches(str(tmp_path / "state"), ["key"], ["i"], "v", fold, sinks.replay_safe(out))
    for batch_id, (a, b) in enumerate([(0, 700), (700, 701), (701, 1200), (1200, 1500)]):
        part = stored.where((F.col("i") >= a) & (F.col("i") < b))
        for _ in range(2 if batch_id == 2 else 1):
            handler(part, batch_id)
    got = sinks.read_output(spark, out).collect()
    assert len(got) == len(rows)
    for r in got:
        for n in names:
            assert r[n] == (pytest.approx(want[r.i][n], rel=1e-9, abs=1e-9) if isinstance(want[r.i][n], float) else want[r.i][n]), (r.i, n)


def test_generated_events_are_in_range(spark, tmp_path):
    live = sources.generated(spark, 200)
    assert live.schema.simpleString() == "struct<id:string,value:double,ts:timestamp>"
    values = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(60000)) / 100 - 100).alias("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    assert -100 <= low and high < 500


def test_quality_flow(spark, folder, tmp_path):
    """The streamed flow puts each message where the batch flow does."""
    root = str(tmp_path / "in")
    raw = inputs.raw_messages(spark, folder).withColumn("part", F.expr(CUTS))
    for part in range(1, PARTS + 1):
        raw.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(root)
    schema = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, raw string"
    checked = anomalies.checked_messages(sources.files(spark, root, schema, "parquet", 1), keep=("raw",))
    out = str(tmp_path / "out")
    finish(quality.run(checked, out, str(tmp_path / "check"), ordered.Ewma(anomalies.ALPHA, anomalies.THRESHOLD)))
    expected = anomalies.advanced_flow(inputs.raw_messages(spark, folder))
    for name in ("dead_letter", "anomalies", "table"):
        wanted = bag(expected.where(F.col("output") == name), "event_id")
        assert bag(sinks.read_output(spark, f"{out}/{name}", "event_id bigint"), "event_id") == wanted
