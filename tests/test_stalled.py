"""Alerts on silent keys: the stream's timers against the batch form, and a state store that does not grow."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowwarden.operators import metrics
from rowwarden.streaming import sinks, sources, stalled, windows

START = dt.datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp, good boolean"
FAR = START + dt.timedelta(days=400)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def run(spark, tmp_path, batches, idle=3, delay="0 seconds"):
    root = str(tmp_path / "in")
    # the last row moves the clock on, and one more batch lets the timers see it
    for rows in [*batches, [("end", FAR, True)], [("end", FAR, True)]]:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(root)
    live = stalled.silent_keys(sources.files(spark, root, SCHEMA, "parquet", 1), ["k"], "at", 5, F.col("good"), idle, delay)
    query = sinks.start(live, sinks.replay_safe(str(tmp_path / "out")), str(tmp_path / "check"))
    assert query.awaitTermination(240)
    if query.exception():
        raise query.exception()
    return sinks.read_output(spark, str(tmp_path / "out")).where("k <> 'end'"), query


def bag(df):
    return Counter((r.k, r.window_start) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch(spark, tmp_path, seed):
    """Keys that stop, come back after a while, or have bad rows only; rows out of order within the delay."""
    rng = random.Random(seed)
    rows = []
    for key in range(8):
        t = rng.randrange(0, 4000)
        for _ in range(rng.randrange(1, 30)):
            rows.append((f"k{key}", at(t), rng.choice([True, True, False, None])))
            t += rng.choice([10, 100, 400, 1000, 6000])
    rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(0, 200)))  # up to 200 s behind the others
    cut = sorted(rng.sample(range(len(rows)), 4))
    batches = [rows[a:b] for a, b in zip([0, *cut], [*cut, len(rows)])]
    extra = [(None, at(5), True), ("k1", None, True)]
    found, query = run(spark, tmp_path, [batches[0] + extra, *batches[1:]], delay="200 seconds")
    assert windows.late_rows(query) == 0
    want = metrics.stalled_by_key(spark.createDataFrame(rows + extra, SCHEMA), ["k"], "at", 5, F.col("good"), 3, F.lit(FAR))
    assert bag(found) == bag(want) and sum(bag(want).values()) > 30


def test_an_alert_needs_no_row_of_its_key(spark, tmp_path):
    batches = [[("a", at(0), True), ("b", at(0), True)], [("b", at(400), True)], [("b", at(700), True)], [("b", at(1000), True)], [("b", at(1250), True)]]
    found, _ = run(spark, tmp_path, batches, idle=2)
    assert bag(found)[("a", at(300))] == bag(found)[("a", at(600))] == 1 and ("a", at(900)) not in bag(found)
    first = found.where("k = 'a'").agg(F.min("batch_id")).first()[0]
    assert first < 5  # given while the stream went on, long before the closing row


def test_state_does_not_grow_with_the_keys_ever_seen(spark, tmp_path):
    batches = [[(f"k{b}-{i}", at(3600 * b + i), True) for i in range(50)] for b in range(6)]
    found, query = run(spark, tmp_path, batches, idle=2)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] <= 10 and max(held) < 2.5 * max(held[:3])
    assert sum(bag(found).values()) == 6 * 50 * 2
