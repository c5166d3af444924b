"""Prefix trie of conversations against a plain one built from the definition."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rowwarden.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, path string, part int, h string, node string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "clash", 1, "x", "y") for r in rows], SCHEMA).repartition(parts)


def plain_rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:]  # the remainder has the sign of c
    return out


def plain_trie(paths: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = []
    for k, cs in members.items():
        below = [u for u in members if u[: len(k)] == k]
        inner = {u[:-1] for u in members if u}
        saved = sum((len(members[u]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", u[-1][1])) for u in below if u)
        ends = ",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(k))
        kids = sum(1 for u in below if len(u) == len(k) + 1)
        parent = min(members[k[:-1]]) if k else None
        out.append((min(cs), len(k), parent, len(cs), kids, sum(u not in inner for u in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*prefix_trie.RESULT).collect()), key=repr)


def conversations(seed=3, n=90):
    rng = random.Random(seed)
    texts = ["", " ", "hello there", "what is this\tthing", "naïve café", "a  b\nc", "x" * 3000, None, " kept"]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    rows += [(c, None, "system", "first of all") for c in range(0, n, 7)]  # null turn comes first
    rows += [(5, 1, "user", "tie b"), (5, 1, "user", "tie a"), (5, 1, "user", "tie a"), (8, None, None, None)]
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    rows += [(10**12 + 7, 0, "user", "alone"), (-21, 0, "user", "negative"), (-20, 0, "user", "donor of it")]
    rows += [(1000 + k, t, "user", f"copy {t}") for k in range(300) for t in range(3)]  # a large group of copies
    rows += [(2000 + k, t, "user", f"copy {t}" if t < 2 else f"own {k}") for k in range(100) for t in range(3)]
    rows += [(3000, t, "user", f"long {t}") for t in range(400)] + [(3020, t, "user", f"long {t}" if t < 399 else "other") for t in range(400)]
    return rows


def test_graft_equals_the_definition(spark):
    rows = conversations()
    got = {r.conv_id: (bytes(r.path), bytes(r.words)) for r in queries.rebuilt(frame(spark, rows, 5)).collect()}
    want = plain_rebuilt(rows)
    assert got.keys() == want.keys()
    for c, path in want.items():
        assert got[c][0] == b"".join(prefix_trie.turn_hash(*t) for t in path)
        assert got[c][1] == b"".join(len(re.findall(r"[^\x20\x09-\x0D]+", t)).to_bytes(4, "little") for _, t in path)


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_trie_equals_the_plain_one(spark, partitions):
    rows = conversations(partitions, 60)
    got = found(prefix_trie.trie(queries.rebuilt(frame(spark, rows)), partitions))
    assert got == plain_trie(plain_rebuilt(rows))


def test_ends_of_a_skeleton_node_come_in_several_runs(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    rows = [(c, 0, "user", "same") for c in range(0, 2000, 20)]
    got = found(prefix_trie.trie(queries.rebuilt(frame(spark, rows)), 5))
    assert got == plain_trie(plain_rebuilt(rows))


def test_skeleton_bound_lowers_the_number_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SKELETON", 500)
    rows = conversations(4, 30)
    got = found(prefix_trie.trie(queries.rebuilt(frame(spark, rows)), 16))
    assert got == plain_trie(plain_rebuilt(rows))


def test_turnless_conversation_is_a_member_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in (1, 2, 3, 4, 5)]  # no donor; some lose their only turn
    paths = plain_rebuilt(rows)
    assert any(not p for p in paths.values())
    assert found(prefix_trie.trie(queries.rebuilt(frame(spark, rows)), 3)) == plain_trie(paths)


def test_long_conversation_spans_tasks(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(3000)] + [(2, t, "user", f"turn {t}") for t in range(10)]
    whole = prefix_trie.paths(frame(spark, rows, 6))
    got = {r.conv_id: bytes(r.path) for r in whole.collect()}
    assert got[1] == b"".join(prefix_trie.turn_hash("user", f"turn {t}") for t in range(3000))
    assert got[1][: len(got[2])] == got[2]


def test_empty_table(spark):
    assert prefix_trie.trie(queries.rebuilt(frame(spark, [], 1))).collect() == []
    assert prefix_trie.trie(queries.rebuilt(frame(spark, [(None, 1, "a", "b")], 1))).collect() == []


def test_hot_first_turn_costs_one_partial_a_task(spark):
    rows = [(c, t, "user", "hello" if t == 0 else f"{c} {t}") for c in range(0, 12000, 20) for t in range(3)]
    conv = queries.rebuilt(frame(spark, rows))
    shards = conv.repartitionByRange(6, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    skeleton = prefix_trie._skeleton(shards)
    assert len(skeleton) == 2  # the root and the first turn, though 600 conversations share it
    per_task = shards.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert max(r["count"] for r in per_task) < 2.5 * 600 / 6
