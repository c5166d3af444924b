"""Verdicts that are corrected by late rows: stream against batch, over several micro-batches."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowwarden.operators import reconcile
from rowwarden.plans import inputs
from rowwarden.streaming import corrections, sinks, sources, windows

START = dt.datetime(2024, 1, 1)
LEFT = "id bigint, k string, at timestamp, h string, clock timestamp"
RIGHT = "k string, rt timestamp, rh string, clock timestamp"
FAR = dt.datetime(2031, 1, 1)


def write(spark, root, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(root)


def run(spark, tmp_path, lefts, rights, horizon=None, clock=True, delay="0 seconds"):
    """(all verdicts, the query) of the given micro-batches of both sides, closed by rows far ahead."""
    roots = [str(tmp_path / n) for n in ("l", "r")]
    write(spark, roots[0], [*lefts, [(-1, "end", FAR, None, FAR)], [(-2, "end", FAR + dt.timedelta(days=400), None, FAR + dt.timedelta(days=400))]], LEFT)
    write(spark, roots[1], [*rights, [("end", FAR, None, FAR)], [("end", FAR + dt.timedelta(days=400), None, FAR + dt.timedelta(days=400))]], RIGHT)
    left, right = (sources.files(spark, root, schema, "parquet", 1) for root, schema in zip(roots, (LEFT, RIGHT)))
    own = {"left_clock": "clock", "right_clock": "clock"} if clock else {}
    live = corrections.late_verdicts(left, right, ["k"], "id", "at", "rt", "h", "rh", 600, 300, horizon, delay=delay, **own)
    out = str(tmp_path / "out")
    query = sinks.start(live, sinks.replay_safe(out), str(tmp_path / "check"), mode="update")
    assert query.awaitTermination(240)
    if query.exception():
        raise query.exception()
    return sinks.read_output(spark, out).where("id >= 0"), query


def state_rows(query) -> list[int]:
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def last(verdicts):
    return {r.id: (r.status, r.right_hash) for r in corrections.last_verdicts(verdicts, "id").collect()}


def test_missing_then_corrected_then_empty(spark, tmp_path):
    lefts = [
        [(1, "a", at(0), "x", at(0)), (2, "b", at(0), "x", at(0)), (3, "c", at(0), "x", at(0)), (4, None, at(0), "x", at(0)), (5, "d", None, "x", at(0))],
        [(6, "z", at(60), "x", at(60))],  # moves the clock on, which the next batch sees
        [(9, "y", at(70), "x", at(70))],
        [(7, "z", at(120), "x", at(120)), (1, "a", at(0), "x", at(120))],  # and a message that comes twice
        [(8, "z", at(5000), None, at(5000))],
    ]
    rights = [
        [("a", at(5), "x", at(5)), ("none", at(5), "x", at(5)), (None, at(0), "x", at(5))],
        [("z", at(61), "y", at(60))],
        [("y", at(71), "x", at(70))],
        [("b", at(3), "x", at(121)), ("c", at(16), "x", at(121)), ("a", at(6), "y", at(121)), ("a", at(4), "x", at(121))],  # on the way for two hours
        [("b", at(2), "y", at(5000))],
    ]
    found, query = run(spark, tmp_path, lefts, rights, horizon=4 * 3600)
    history = {}
    for r in found.orderBy("id", "revision").collect():
        history.setdefault(r.id, []).append((r.status, r.right_hash, r.is_correction))
    assert history == {
        1: [("MATCH", "x", False), ("MISMATCH", "y", True)],  # the later partner counts, an earlier one does not
        2: [("MISSING_CLOUD", None, False), ("MATCH", "x", True)],  # what comes behind the horizon is not seen
        3: [("MISSING_CLOUD", None, False)],  # its row is a minute beyond the grace
        4: [("MISSING_CLOUD", None, False)],
        5: [("MISSING_CLOUD", None, False)],
        6: [("MISMATCH", "y", False)],
        7: [("MISSING_CLOUD", None, False)],
        8: [("MISSING_CLOUD", None, False)],
        9: [("MATCH", "x", False)],
    }
    assert state_rows(query)[-1] <= 4 < max(state_rows(query))  # of the closing rows only


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_last_verdict_is_that_of_the_batch_whatever_the_split(spark, tmp_path, seed):
    """Rows of both sides in any order of arrival, over four micro-batches."""
    rng = random.Random(seed)
    lefts, rights = [], []
    for i in range(120):
        k, t = rng.choice(["hot", "hot", f"k{rng.randrange(30)}"]), rng.randrange(0, 600)
        lefts.append((i, k, at(t), f"h{i % 7}"))
        for _ in range(rng.choice([0, 1, 1, 2])):
            rights.append((k, at(t + rng.randrange(-3, 20)), rng.choice([f"h{i % 7}", "other", None])))
    deal = lambda rows: [[(*r, at(600 + 10 * b)) for r in rows if r[-1] is not FAR and hash((r, seed)) % 4 == b] or [(*rows[0], at(600 + 10 * b))] for b in range(4)]
    found, _ = run(spark, tmp_path, deal(lefts), deal(rights), horizon=30 * 24 * 3600)
    left = spark.createDataFrame(lefts, "id bigint, k string, at timestamp, h string")
    right = spark.createDataFrame(list(set(rights)), "k string, rt timestamp, rh string")
    batch = reconcile.verdict_history(left, right, ["k"], "id", "at", "rt", "h", "rh", 600, 300)
    assert last(found) == {r.id: (r.status, r.rh) for r in corrections.last_verdicts(batch, "id").collect()}
    revisions = Counter((r.id, r.revision) for r in found.collect())
    assert max(revisions.values()) == 1


def test_orders_of_both_sites(spark, folder, tmp_path):
    """In time order the stream ends with the verdicts of `interval_left_grace`, and corrections are counted."""
    onprem = inputs.onprem(spark, folder).selectExpr("order_key AS id", "CAST(pk AS STRING) AS k", "CAST(event_ts AS TIMESTAMP) AS at", "hash_onprem AS h")
    cloud = inputs.cloud(spark, folder).selectExpr("CAST(pk AS STRING) AS k", "CAST(cloud_ts AS TIMESTAMP) AS rt", "hash_cloud AS rh")
    cut = lambda df, t: [[tuple(r)[:-1] for r in df.where(F.expr(f"year({t}) % 4 = {b}")).withColumn("clock", F.lit(None).cast("timestamp")).withColumn("x", F.lit(0)).collect()] for b in range(4)]
    # the cloud's batches come a step behind, with their arrival as clock
    clocked = lambda batches, lag: [[(*r[:-1], START + dt.timedelta(days=b + lag)) for r in rows] for b, rows in enumerate(batches)]
    lefts, rights = clocked(cut(onprem, "at"), 0), clocked([[], *cut(cloud, "rt")], 0)
    lefts = [*lefts, [(10**9, "step", START, None, START + dt.timedelta(days=4))]]
    rights[0] = [("step", START, None, START)]
    found, query = run(spark, tmp_path, lefts, rights, horizon=40 * 365 * 24 * 3600)
    found = found.where("id < 1000000000")
    assert windows.late_rows(query) == 0
    batch = reconcile.verdict_history(onprem, cloud, ["k"], "id", "at", "rt", "h", "rh", 600, 300)
    assert last(found) == {r.id: (r.status, r.rh) for r in corrections.last_verdicts(batch, "id").collect()}
    assert found.where("is_correction").count() > 100


def test_a_hot_key_is_spread_over_its_time(spark, tmp_path):
    lefts = [[(i, "hot", at(7 * i), "x", at(0)) for i in range(300)]]
    rights = [[("hot", at(7 * i + 1), "x", at(0)) for i in range(300)]]
    found, _ = run(spark, tmp_path, lefts, rights)
    assert Counter(r.status for r in found.collect()) == {"MATCH": 300}
    slots = spark.createDataFrame(lefts[0], LEFT).select(F.floor(F.unix_micros("at") / 900_000_000)).distinct().count()
    assert slots >= 140  # groups the key's state lies in
