import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowwarden.functions import hashing
from rowwarden.operators import reconcile


@pytest.mark.parametrize("algorithm, name", [("SHA-256", "sha256"), ("SHA-512", "sha512"), ("MD5", "md5")])
def test_fields_hash_matches_hashlib(spark, algorithm, name):
    df = spark.createDataFrame([("1", None, "x"), ("2", "é", None)], "b string, a string, c string")
    got = [r[0] for r in df.select(hashing.fields_hash(["c", "b", "a"], algorithm)).collect()]
    assert got == [hashlib.new(name, t.encode()).hexdigest() for t in ("|1|x", "é|2|")]


def test_unknown_algorithm_raises():
    with pytest.raises(ValueError):
        hashing.digest(None, "CRC")


def test_canonical_hash_null_conventions(spark):
    df = spark.createDataFrame([(None, None)], "id string, ts string")
    got = df.select(hashing.canonical_hash([(F.col("id"), "NULL"), F.col("ts")])).first()[0]
    assert got == hashlib.sha256(b"NULL").hexdigest()


def test_bucket_is_stable(spark):
    got = spark.range(50).select(hashing.key_bucket(F.col("id"), 7)).collect()
    assert [r[0] for r in got] == [int(hashlib.sha256(str(i).encode()).hexdigest()[:8], 16) % 7 for i in range(50)]


def test_segment_digest_is_equal_only_for_equal_rows(spark):
    rows = spark.range(500).select("id", (F.col("id") % 9).alias("segment"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    changed = rows.withColumn("h", F.when(F.col("id") == 77, F.sha2(F.lit("other"), 256)).otherwise(F.col("h")))

    def digest(df):
        return reconcile.segment_digest(df, F.col("segment"), F.col("id"), F.col("h"))

    assert reconcile.differing_segments(digest(rows), digest(rows.orderBy(F.rand(1)))).count() == 0
    assert [r.segment for r in reconcile.differing_segments(digest(rows), digest(changed)).collect()] == [77 % 9]
    lacking = rows.where("id <> 100")
    assert [r.segment for r in reconcile.differing_segments(digest(rows), digest(lacking)).collect()] == [100 % 9]


@pytest.mark.parametrize("segments", [1, 7, 300])
def test_drill_down_finds_every_difference(spark, segments):
    """Swapped and one-sided hashes, nulls, malformed digests, digests alike in front, keys that lack or repeat."""
    rng = random.Random(segments)
    head = "0" * 60
    left = {k: hashlib.sha256(str(k).encode()).hexdigest() for k in range(400)}
    right = dict(left)
    right[1], right[2] = left[2], left[1]
    left[3] = right[4] = None
    left[5], right[5] = None, None
    left[6], right[6] = head + "aaaa", head + "bbbb"
    left[7], right[7] = "zz", "yy"
    left[8], left[9], right[8], right[9] = "same", None, None, "same"
    for k in rng.sample(range(20, 400), 12):
        (left if k % 2 else right).pop(k)
    frame = lambda d: spark.createDataFrame([*d.items(), (None, "nokey"), (None, None)], "pk long, h string")
    every = reconcile.full_outer(frame(left), frame(right), "pk", "h", "h").where("reconciliation_status <> 'OK'")
    found = reconcile.drill_down(frame(left), frame(right), "pk", segments, "h", "h").where("reconciliation_status <> 'OK'")
    # a segment whose rows are equal on both sides holds no drift but rows whose digest lacks on both
    real = lambda df: Counter(tuple(r) for r in df.where("reconciliation_status <> 'MISSING_BOTH'").where("pk is not null").collect())
    assert real(found) == real(every) and sum(real(every).values()) >= 19


def test_repeated_keys_count_once(spark):
    rows = [(1, "old", 1), (1, "new", 2), (1, "new", 2), (2, "x", 1), (None, "n", 1), (None, "n", 1)]
    a = spark.createDataFrame(rows, "pk long, h string, at int")
    b = spark.createDataFrame([(1, "new", 5), (1, "old", 4), (3, "y", 1)], "pk long, h string, at int")
    got = reconcile.full_outer(a, b, "pk", "h", "h", ["at"], ["at"]).collect()
    assert sorted((r.pk or 0, r.reconciliation_status) for r in got) == [
        (0, "MISSING_IN_AZURE"), (0, "MISSING_IN_AZURE"), (1, "OK"), (2, "MISSING_IN_AZURE"), (3, "MISSING_IN_ONPREM"),
    ]
    checked = reconcile.left_check(a, b.withColumnRenamed("h", "c"), "pk", "h", "c", ["at"]).collect()
    assert len(checked) == len(rows)


def test_digests_of_the_tables_are_joined_as_bytes(spark):
    from rowwarden.plans import reconciliation

    for _, _, joined in reconciliation.each_table(spark, "/root/testdata/sf0.001"):
        kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
        assert kinds["row_sum"] == kinds["far_sum"] == "binary"
