import datetime as dt
import random
from collections import Counter

import pytest

from rowwarden.operators import joins

START = dt.datetime(2024, 1, 1)


def sample(seed, n, hot):
    """Rows with a hot key, repeated keys and times, null keys and null times."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = None if r.random() < 0.1 else 1 if r.random() < hot else r.randint(2, 6)
        moment = None if r.random() < 0.1 else START + dt.timedelta(seconds=r.randint(-40, 40), microseconds=r.choice([0, 1, 999999]))
        rows.append((key, moment, i))
    return rows


def brute(left, right, low, high, how):
    out, used = Counter(), set()
    for k, t, i in left:
        partners = [
            j for j, (rk, rt, _) in enumerate(right)
            if None not in (k, rk, t, rt) and k == rk
            and t + dt.timedelta(seconds=low) <= rt <= t + dt.timedelta(seconds=high)
        ]
        used.update(partners)
        out.update((i, right[j][2]) for j in partners)
        if not partners and how != "inner":
            out[(i, None)] += 1
    if how == "full":
        out.update((None, right[j][2]) for j in range(len(right)) if j not in used)
    return out


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("low, high", [(0, 10), (-3, 3), (-5, -1), (2, 2)])
def test_interval_join_against_all_pairs(spark, how, low, high):
    left, right = sample(1, 60, 0.5), sample(2, 60, 0.5)
    a = spark.createDataFrame(left, "k int, lt timestamp_ntz, l int")
    b = spark.createDataFrame(right, "k int, rt timestamp_ntz, r int")
    got = joins.interval_join(a, b, ["k"], "lt", "rt", low, high, how).select("l", "r").collect()
    assert Counter((x.l, x.r) for x in got) == brute(left, right, low, high, how)


def test_key_join_keeps_null_keys(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, l string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, r string")
    got = joins.key_join(a, b, ["k"], "full").collect()
    assert Counter((x.k, x._r_k, x.l, x.r) for x in got) == Counter(
        [(1, 1, "a", "x"), (None, None, "b", None), (None, None, "c", None), (None, 2, None, "y"), (None, None, None, "z")]
    )


def test_many_to_many_equals_full_join(spark):
    r = random.Random(3)
    a = spark.createDataFrame([(r.choice([None, 1, 1, 1, 2, 3]), i) for i in range(30)], "k int, l int")
    b = spark.createDataFrame([(r.choice([None, 1, 2, 2, 4]), i) for i in range(30)], "k int, r int")
    got = joins.many_to_many_full_join(a, b, ["k"]).select("l", "r").collect()
    expected = a.alias("a").join(b.alias("b"), a.k == b.k, "full").select("l", "r").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, expected))


@pytest.mark.parametrize("grouped", [False, True])
def test_a_hot_left_key_is_split(spark, grouped):
    """Also where the right side was grouped by the key just before."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 2 = 0, 7, id) AS k", "id AS l")
        right = spark.range(1000).selectExpr("id AS k", "id AS r")
        right = right.groupBy("k").max("r").withColumnRenamed("max(r)", "r") if grouped else right
        joined = joins.key_join(left, right, ["k"], "left")
        assert joined.where("r is not null").groupBy().count().first()[0] == 100_000 + 500
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert len(rows) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_keys_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 4000, 1, 4).selectExpr("if(id % 2 = 0, null, id) AS k", "id AS l")
        right = spark.range(10).selectExpr("id AS k", "id AS r")
        for joined in (
            joins.key_join(left, right, ["k"], "left"),
            joins.aliased_left_join(left.alias("a"), right.alias("b"), "k", "a", "b"),
        ):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert len(keys) == 2 and all("_spread" in line for line in keys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_full_interval_join_equals_the_plain_one(spark, seed):
    """Partners on both sides of slot borders, rows alone in one or two slots, repeats, null keys and times."""
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    moment = lambda: None if rng.random() < 0.05 else base + dt.timedelta(seconds=rng.randrange(0, 3000))
    key = lambda: rng.choice([None, 1, 1, 1, 2, 3])
    left = [(key(), moment(), i) for i in range(150)] + [(1, base, 900)] * 2
    right = [(key(), moment(), 1000 + i) for i in range(150)] + [(9, base + dt.timedelta(seconds=79), 1900)] * 2
    l = spark.createDataFrame(left, "k int, lt timestamp, a int")
    r = spark.createDataFrame(right, "k int, rt timestamp, b int").repartition(3)
    for low, high in ((-10, 10), (0, 25), (-60, -20)):
        got = joins.interval_join(l, r, ["k"], "lt", "rt", low, high, "full")
        assert len(got.columns) == 6
        found = Counter((x["a"], x["b"]) for x in got.collect())
        want, met = Counter(), set()
        for i, (k, t, a) in enumerate(left):
            own = [j for j, (q, u, _) in enumerate(right) if k is not None and k == q and t and u and low <= (u - t).total_seconds() <= high]
            want.update((a, right[j][2]) for j in own)
            met.update(own)
            if not own:
                want[(a, None)] += 1
        want.update((None, b) for j, (_, _, b) in enumerate(right) if j not in met)
        assert found == want
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan ExistingRDD") == 2 and "ReusedExchange" in plan  # each side is read and shuffled once
