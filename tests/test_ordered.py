import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowwarden.operators import anomaly, ordered


def sample(n=400):
    """A key with more than half of all rows, single-row keys, nulls in key and value."""
    r = random.Random(5)
    rows = []
    for i in range(n):
        key = "hot" if r.random() < 0.6 else r.choice(["a", "b", None, f"one-{i}"])
        rows.append((key, r.randint(0, 50), i, None if r.random() < 0.05 else round(r.gauss(100, 20), 3)))
    return rows


def by_key(rows):
    groups = {}
    for key, at, i, v in sorted(rows, key=lambda x: (x[1], x[2])):
        if key is not None and v is not None:
            groups.setdefault(key, []).append((i, v))
    return groups


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(sample(), "key string, at int, i int, v double")


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ewma_is_the_plain_recursion(frame, parts):
    alpha, limit = 0.05, 1.5
    expected = {}
    for rows in by_key(sample()).values():
        ema = var = None
        for i, v in rows:
            if ema is None:
                ema, var, z = v, 0.0, 0.0
            else:
                dev = v - ema
                ema, var = alpha * v + (1 - alpha) * ema, (1 - alpha) * var + alpha * dev * dev
                z = abs(v - ema) / (math.sqrt(var + 1e-9) + 1e-9)
            expected[i] = (ema, var, z)
    got = anomaly.ewma(frame, "key", ["at", "i"], "v", alpha, limit, partitions=parts).collect()
    assert len(got) == len(sample())
    for row in got:
        if row.i in expected:
            assert (row.ema, row.ewvar, row.z) == pytest.approx(expected[row.i], rel=1e-9, abs=1e-9)
            assert row.is_anomaly == (expected[row.i][2] > limit)
        else:
            assert row.ema is None and not row.is_anomaly
    assert any(r.is_anomaly for r in got)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_zscore_uses_earlier_rows(frame, parts):
    expected = {}
    for rows in by_key(sample()).values():
        seen = []
        for i, v in rows:
            sd = statistics.stdev(seen) if len(seen) > 1 else 0
            expected[i] = (v - statistics.mean(seen)) / sd if sd else 0.0
            seen.append(v)
    for row in anomaly.zscore(frame, "key", ["at", "i"], "v", partitions=parts).collect():
        if row.i in expected:
            assert row.z == pytest.approx(expected[row.i], rel=1e-8, abs=1e-8)


def test_a_hot_key_spans_partitions(spark):
    rows = spark.range(2000).select(F.lit("hot").alias("key"), F.col("id").alias("at"), F.lit(1.0).alias("v"))
    scanned = ordered.ordered_scan(rows, ["key"], ["at"], "v", ordered.RunningSum(), partitions=8)
    sizes = [r[1] for r in scanned.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1000
    assert scanned.where("running <> at + 1").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles(spark, seed):
    r = random.Random(seed)
    data = {"a": [r.randint(0, 20) / 2 for _ in range(301)], "b": [r.random() for _ in range(50)], "c": [3.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("a", None)], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(x.g, x.probability): x.quantile for x in ordered.exact_quantiles(df, ["g"], "v", probs).collect()}
    for g, vs in data.items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(vs, p))


@pytest.mark.parametrize("fold", [ordered.Ewma(0.2), ordered.Ewma(0.9), ordered.RunningZScore(), ordered.RunningSum()])
def test_digest_continues_any_state(fold):
    r = random.Random(9)
    for cut in (1, 2, 17, 99):
        values = [r.uniform(-50, 500) for _ in range(100)]
        state = None
        for v in values[:cut]:
            state, _ = fold.step(state, v)
        whole, digest = state, None
        for v in values[cut:]:
            whole, _ = fold.step(whole, v)
            digest = fold.digest(digest, v)
        assert fold.resume(state, digest) == pytest.approx(whole, rel=1e-9)
