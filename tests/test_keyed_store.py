"""The bucketed store: merges, replays, changelog, kept counts, digests and the comparison by them."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowwarden.functions import hashing
from rowwarden.operators import changelog, digest_tree, keyed, metrics, reconcile
from rowwarden.plans import inputs
from rowwarden.sources import keyed_store
from rowwarden.sources.keyed_store import AFTER, BEFORE, DELETE, INSERT, KeyedStore
from rowwarden.streaming import sinks, sources

SCHEMA = "id bigint, at bigint, op string, status string, amount double"


def store(spark, root, **options):
    given = {"buckets": 8, "leaves": 64, "deleted": lambda row: row("op") == "d"} | options
    return KeyedStore(spark, str(root), SCHEMA, ["id"], ["at"], **given)


def bag(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def batches(seed, n=4, keys=60, size=80):
    rng = random.Random(seed)
    out, at = [], 0
    for _ in range(n):
        rows = []
        for _ in range(size):
            at += rng.randrange(0, 3)  # equal times happen
            late = rng.random() < 0.2
            rows.append((rng.choice([1, 1, *range(keys)]), at - 40 if late else at, rng.choice("uuuud"), rng.choice(["NEW", "PAID", None]), rng.choice([1.5, 2.5, None])))
        out.append([*rows, (None, at, "u", "NEW", 1.0)])
    return out


def plain(done):
    """Last row per key over the batches; equal times: the later batch, then the greater row."""
    held = {}
    for rows in done:
        fresh = {}
        for r in rows:
            if r[0] is not None:
                rank = lambda x: (x[1], [(v is not None, v) for v in x])
                if r[0] not in fresh or rank(r) > rank(fresh[r[0]]):
                    fresh[r[0]] = r
        for k, r in fresh.items():
            if k not in held or r[1] >= held[k][1]:
                held[k] = r
    return Counter(r for r in held.values() if r[2] != "d")


def test_merges_equal_the_plain_table_and_replays_change_nothing(spark, tmp_path):
    s = store(spark, tmp_path)
    by = {"status": F.col("status")}
    counts = changelog.KeptCounts(s, str(tmp_path / "counts"), by)
    done, before = [], Counter()
    for v, rows in enumerate(batches(1)):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        done.append(rows)
        for _ in range(2 if v in (1, 3) else 1):  # a micro-batch that is run again
            s.merge(df, v)
            counts.follow(v)
        assert bag(s.read()) == plain(done)
        assert bag(s.read(v)) == plain(done)
        log = s.changes(v).collect()
        kinds = Counter(r.kind for r in log)
        assert kinds[BEFORE] == kinds[AFTER]
        gone = Counter(tuple(r)[1:] for r in log if r.kind in (BEFORE, DELETE))
        came = Counter(tuple(r)[1:] for r in log if r.kind in (INSERT, AFTER))
        assert not gone - before and before - gone + came == plain(done)
        assert bag(counts.at(v), "status", "n") == bag(changelog.plain_counts(s.read(), by), "status", "n")
        before = plain(done)
    assert bag(s.read(1)) == plain(done[:2])  # an older version is still there


def test_a_batch_of_one_bucket_writes_one_bucket(spark, tmp_path):
    s = store(spark, tmp_path)
    s.merge(spark.createDataFrame([(i, 0, "u", "NEW", 1.0) for i in range(200)], SCHEMA), 0)
    assert len(list((tmp_path / "data" / "version=0").glob("bucket=*"))) == 8
    assert len(s.merge(spark.createDataFrame([(7, 1, "u", "PAID", 1.0)], SCHEMA), 1)) == 1
    assert len(list((tmp_path / "data" / "version=1").glob("bucket=*"))) == 1
    assert s.merge(spark.createDataFrame([], SCHEMA), 2) == []
    assert s.read().count() == 200 and bag(s.changes(1), "kind", "status") == {(BEFORE, "NEW"): 1, (AFTER, "PAID"): 1}
    assert s.changes(2).count() == 0


def test_a_bucket_is_written_by_as_many_tasks_as_its_rows_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_store, "TASK_ROWS", 50)
    s = store(spark, tmp_path, buckets=2)
    rows = [(i, 0, "u", "NEW", 1.0) for i in range(400)]
    s.merge(spark.createDataFrame(rows, SCHEMA), 0)
    files = [len(list((tmp_path / "data" / "version=0" / f"bucket={b}").glob("*.parquet"))) for b in range(2)]
    assert files == [4, 4] and bag(s.read()) == Counter(rows)
    later = [(i, 1, "u", "PAID", 2.0) for i in range(0, 400, 2)]
    s.merge(spark.createDataFrame(later, SCHEMA), 1)
    assert bag(s.read()) == Counter(later) + Counter(rows[1::2])


@pytest.mark.parametrize("reduced", [True, False])
def test_repeated_keys_of_a_merge(spark, tmp_path, monkeypatch, reduced):
    calls, own = [], KeyedStore._reduced
    monkeypatch.setattr(KeyedStore, "_reduced", lambda self, fresh: calls.append(1) or own(self, fresh))
    s, done = store(spark, tmp_path), []
    for v, rows in enumerate(batches(9, size=60)):
        done.append(rows if reduced else rows + [(1000 + i, 5, "u", "NEW", None) for i in range(100)])  # seldom, or most keys once
        if reduced:
            done[-1] = done[-1] + [(7, at, "u", "NEW", 1.0) for at in range(100)]
        s.merge(spark.createDataFrame(done[-1], SCHEMA).repartition(3), v)
        assert bag(s.read()) == plain(done)
    assert len(calls) == (len(done) if reduced else 0)


def test_a_hot_key_among_many_is_reduced(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_store, "TASK_ROWS", 60)
    calls, own = [], KeyedStore._reduced
    monkeypatch.setattr(KeyedStore, "_reduced", lambda self, fresh: calls.append(1) or own(self, fresh))
    rows = [(i, 0, "u", "NEW", 1.0) for i in range(400)] + [(3, at, "u", "PAID", 1.0) for at in range(100)]
    s = store(spark, tmp_path)
    s.merge(spark.createDataFrame(rows, SCHEMA), 0)
    assert calls and bag(s.read()) == plain([rows])


def test_bucket_digests_are_the_sums_of_the_words_of_their_rows(spark, tmp_path):
    s = store(spark, tmp_path)
    for v, rows in enumerate(batches(5)):
        s.merge(spark.createDataFrame(rows, SCHEMA), v)
    bound = hashing.bound_digest(F.col("id"), hashing.canonical_hash([(F.col(c), "NULL") for c in s.digest_columns]))
    sums = [F.sum(w).cast("decimal(38,0)") for w in hashing.words(bound)]
    rows = s.read().withColumn("bucket", F.floor(s.leaf() / 8)).groupBy("bucket").agg(F.count(F.lit(1)), *sums).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {b: (e.rows, *e.digest) for b, e in s.manifest()[1].items() if e.rows}


def test_old_versions_go(spark, tmp_path):
    s = store(spark, tmp_path)
    for v in range(5):
        s.merge(spark.createDataFrame([(i, v, "u", "NEW", float(v)) for i in range(0, 40, v + 1)], SCHEMA), v)
    want = bag(s.read()), bag(s.read(3))
    s.vacuum(2)
    assert (bag(s.read()), bag(s.read(3))) == want
    assert sorted(p.name for p in (tmp_path / "manifest").glob("version=*")) == ["version=3", "version=4"]
    held = {(e.version, b) for v in (3, 4) for b, e in s.manifest(v + 1)[1].items()}
    files = {(int(p.parent.name[8:]), int(p.name[7:])) for p in (tmp_path / "data").glob("version=*/bucket=*")}
    assert files == held


def test_a_commit_that_was_not_finished_is_not_seen(spark, tmp_path):
    s = store(spark, tmp_path)
    s.merge(spark.createDataFrame([(1, 0, "u", "NEW", 1.0)], SCHEMA), 0)
    commit, s._commit = s._commit, lambda *a: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        s.merge(spark.createDataFrame([(1, 1, "u", "PAID", 1.0), (2, 1, "u", "PAID", 1.0)], SCHEMA), 1)
    assert bag(s.read(), "id", "status") == {(1, "NEW"): 1}
    s._commit = commit
    s.merge(spark.createDataFrame([(1, 1, "u", "PAID", 1.0), (2, 1, "u", "PAID", 1.0)], SCHEMA), 1)
    assert bag(s.read(), "id", "status") == {(1, "PAID"): 1, (2, "PAID"): 1}


def test_key_range_reads_its_own_files(spark, tmp_path):
    s = store(spark, tmp_path)
    s.merge(spark.createDataFrame([(i, 0, "u", "NEW", 1.0) for i in range(500)], SCHEMA), 0)
    parts = [s.key_range(a, b) for a, b in ((0, 8), (8, 20), (20, 64))]
    assert sum((bag(p, "id") for p in parts), Counter()) == bag(s.read(), "id")
    assert parts[0].where("leaf >= 8").count() == 0
    buckets = [{f.split("bucket=")[1].split("/")[0] for f in p.inputFiles()} for p in parts]
    assert [len(b) for b in buckets] == [1, 2, 6]


def test_digests_kept_by_changes_equal_those_of_the_table(spark, tmp_path):
    one, other = store(spark, tmp_path / "a"), store(spark, tmp_path / "b")
    done = batches(5)
    for v, rows in enumerate(done):
        one.merge(spark.createDataFrame(rows, SCHEMA), v)
    other.merge(one.read(), 0)  # the same rows in one go
    assert digest_tree.differing_buckets(one, other) == []
    left, right = digest_tree.open_rows(one, other)
    assert left.inputFiles() == [] and left.count() == right.count() == 0
    assert sum(e.rows for e in one.manifest()[1].values()) == one.read().count()


def test_one_changed_row_opens_one_leaf_per_side(spark, tmp_path):
    one, other = (store(spark, tmp_path / n) for n in "ab")
    rows = spark.createDataFrame([(i, 0, "u", "NEW", 1.0) for i in range(400)], SCHEMA)
    for s in (one, other):
        s.merge(rows, 0)
    other.merge(spark.createDataFrame([(33, 1, "u", "PAID", 2.0)], SCHEMA), 1)
    assert len(digest_tree.differing_buckets(one, other)) == 1
    left, right = digest_tree.open_rows(one, other)
    leaf = one.read().withColumn("leaf", one.leaf())
    own = leaf.where("id = 33").first().leaf
    assert left.count() == right.count() == leaf.where(F.col("leaf") == own).count() < 30
    assert len(left.inputFiles()) == len(right.inputFiles()) == 1
    other.merge(spark.createDataFrame([(33, 2, "u", "NEW", 1.0)], SCHEMA), 2)
    assert digest_tree.differing_buckets(one, other) != []  # its time differs still
    with pytest.raises(ValueError, match="same buckets"):
        digest_tree.differing_buckets(one, store(spark, tmp_path / "c", buckets=4))


@pytest.mark.parametrize("seed, few", [(1, 256), (2, 0)])
def test_every_drifted_row_is_found(spark, tmp_path, seed, few, monkeypatch):
    monkeypatch.setattr(digest_tree, "FEW", few)  # looked up by value, or joined
    rng = random.Random(seed)
    schema = "pk bigint, at bigint, row_hash string"
    base = [(i, 0, f"h{i % 50}") for i in range(600)]
    sides = []
    for name in "ab":
        s = KeyedStore(spark, str(tmp_path / name), schema, ["pk"], ["at"], 16, 256, digest_columns=["row_hash"])
        s.merge(spark.createDataFrame(base, schema), 0)
        edits = [(rng.randrange(700), 1, rng.choice([None, "x", "h3"])) for _ in range(rng.randrange(3, 9))]
        s.merge(spark.createDataFrame(edits, schema), 1)
        sides.append(s)
    found = digest_tree.drift(*sides, "pk", "row_hash", "row_hash")
    whole = reconcile.full_outer(sides[0].read(), sides[1].read(), "pk", "row_hash", "row_hash")
    # a key without a hash on either side is alike on both
    want = bag(whole.where("reconciliation_status not in ('OK', 'MISSING_BOTH')"))
    assert bag(found.where("reconciliation_status not in ('OK', 'MISSING_BOTH')")) == want and want
    assert found.count() < whole.count() / 4


def test_a_stream_of_upserts(spark, folder, tmp_path):
    """View and counts after each micro-batch are those of the batch forms over what has come so far."""
    root = str(tmp_path / "in")
    events = inputs.events(spark, folder).select(F.col("user_id").alias("id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
                                                 F.lit("u").alias("op"), F.col("event_type").alias("status"), F.col("value").alias("amount"), "event_id")
    parts = events.withColumn("part", F.expr("ntile(4) over (order by at, event_id)"))
    for part in range(1, 5):
        parts.where(F.col("part") == part).drop("part", "event_id").coalesce(1).write.mode("append").parquet(root)
    s = store(spark, tmp_path / "store")
    by = {"status": F.col("status")}
    counts = changelog.KeptCounts(s, str(tmp_path / "counts"), by)
    seen = []
    handler = changelog.merging(s, counts.follow, lambda v: seen.append((bag(counts.at(v), "status", "n"), bag(metrics.count_by(s.read(), "status", "n"), "status", "n"))))
    query = sinks.start(sources.files(spark, root, SCHEMA, "parquet", 1), handler, str(tmp_path / "check"))
    assert query.awaitTermination(240) and not query.exception()
    assert len(seen) == 4 and all(a == b for a, b in seen)
    stored = spark.read.schema(SCHEMA).parquet(root)
    latest = keyed.latest_by_key(stored.where("id is not null"), ["id"], ["at", "op", "status", "amount"])
    assert bag(s.read(), "id", "at") == bag(latest, "id", "at")
    assert len(list((tmp_path / "store" / "manifest").glob("version=*"))) == 2


def test_keys_of_several_columns(spark, tmp_path):
    schema = "a string, b int, at int, v string"
    s = KeyedStore(spark, str(tmp_path), schema, ["a", "b"], ["at"], 4, 16)
    s.merge(spark.createDataFrame([("x", 1, 0, "old"), ("x", 2, 0, "two"), ("x,1", 2, 0, "odd"), ("x", None, 0, "none"), (None, 1, 0, "none")], schema), 0)
    s.merge(spark.createDataFrame([("x", 1, 1, "new")], schema), 1)
    assert bag(s.read(), "a", "b", "v") == {("x", 1, "new"): 1, ("x", 2, "two"): 1, ("x,1", 2, "odd"): 1}
    near = s.beside(spark.createDataFrame([("x", 1), (None, None)], "a string, b int"))
    assert ("x", 1, "new") in bag(near, "a", "b", "v")
