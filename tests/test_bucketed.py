"""Bucketed copies meet without a shuffle, and a bucket is one file."""

import uuid
from collections import Counter

from pyspark.sql import functions as F

from rowwarden.sources import bucketed


def test_join_without_exchange(spark, tmp_path):
    left = spark.range(5000).select((F.col("id") % 900).alias("k"), F.col("id").alias("a"))
    right = spark.range(1200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    for name, df in zip(names, (left, right)):
        bucketed.write_bucketed(df, name, str(tmp_path / name), ["k"], 8)
    assert [len(list((tmp_path / n).glob("*.parquet"))) for n in names] == [8, 8]
    for how in ("inner", "left", "full"):
        got = bucketed.joined(spark, *names, ["k"], how)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        want = left.join(right, "k", how)
        assert Counter(map(tuple, got.select("k", "a", "b").collect())) == Counter(map(tuple, want.select("k", "a", "b").collect()))
    for name in names:
        spark.sql(f"DROP TABLE {name}")
