"""Vector codes against a plain Lloyd iteration that compares every part with every entry."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowwarden.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, part int, codes string, vector string, error double"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "clash", "clash", 0.5) for r in rows], SCHEMA).repartition(parts)


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, label, code, error) of each kept row and the codebooks, all in Python integers."""
    kept = [(i, [float(np.float32(x)) for x in v], la) for i, v, la in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept = [r for r in kept if len(r[1]) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts if kept else 0
    cut = [[tuple(math.floor(256 * x) for x in v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups: dict[int, list] = {}
            for x in cut:
                groups.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            for e, xs in groups.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out = []
    for (i, _, la), x in zip(kept, cut):
        found = [nearest(x[p], books[p]) for p in range(parts)]
        out.append((i, la, bytes(e for _, e in found).hex(), sum(d for d, _ in found)))
    return sorted(out, key=repr), books


def given(seed=1, n=400, dim=32):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.013, rng.gauss(0, 0.2)]) for _ in range(dim)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [(n + i, rows[3][1], 2) for i in range(n // 2)]  # one vector in a third of the rows
    rows += [(5, rows[9][1], 1), (5, rows[9][1], 1), (None, rows[4][1], None)]  # repeated and null ids
    bad = [None, [], [1.0] * 7, [0.1] * (dim * 2), [None] * dim, [float("nan")] + [0.0] * (dim - 1), [float("inf")] * dim, [float("-inf")] + [1.0] * (dim - 1)]
    rows += [(10_000 + k, v, 0) for k, v in enumerate(bad)]
    rng.shuffle(rows)
    return rows


def found(coded):
    return sorted(((r.vec_id, r.label, bytes(r.codes).hex(), r.error) for r in coded.collect()), key=repr)


@pytest.mark.parametrize("entries, rounds", [(64, 2), (3, 2), (64, 0), (10, 4)])
def test_equals_plain_lloyd(spark, entries, rounds):
    rows = given(entries + rounds, 200)
    coded, books = vector_codes.compress(frame(spark, rows), entries=entries, rounds=rounds)
    want, plain_books = plain(rows, 16, entries, rounds)
    assert found(coded) == want
    assert [[tuple(c) for c in book] for book in books.tolist()] == plain_books


def test_fewer_rows_than_entries(spark):
    rows = given(2, 200)[:5]
    coded, books = vector_codes.compress(frame(spark, rows))
    want, plain_books = plain(rows)
    assert found(coded) == want and books.shape[1] == len(plain_books[0])


def test_active_entries_equal_a_complete_scan():
    rng = np.random.default_rng(3)
    for _ in range(60):
        x = rng.integers(-3, 4, (200, 2))  # small numbers: many ties
        book = rng.integers(-3, 4, (9, 2))
        code, dist = vector_codes.assign(x, book, np.ones(9, bool), np.zeros(200, np.int64), np.zeros(200, np.int64))
        moved = rng.random(9) < 0.4
        new = np.where(moved[:, None], rng.integers(-3, 4, (9, 2)), book)
        got = vector_codes.assign(x, new, moved, code, dist)
        want = ((x[:, None] - new[None]) ** 2).sum(2)
        assert (got[0] == want.argmin(1)).all() and (got[1] == want.min(1)).all()


def test_fixed_parts_look_at_moved_entries_only(monkeypatch):
    seen = []
    real = vector_codes._closer
    monkeypatch.setattr(vector_codes, "_closer", lambda x, book, entries, *a: (seen.append((len(x), len(entries))), real(x, book, entries, *a)))
    x = np.array([[0], [10], [20], [21]])
    book = np.array([[0], [10], [20]])
    code, dist = vector_codes.assign(x, book, np.ones(3, bool), np.zeros(4, np.int64), np.zeros(4, np.int64))
    seen.clear()
    vector_codes.assign(x, np.array([[0], [10], [21]]), np.array([False, False, True]), code, dist)
    assert seen == [(2, 1), (2, 3)]


def test_label_error(spark):
    rows = given(6, 120)
    coded, _ = vector_codes.compress(frame(spark, rows))
    want, _ = plain(rows)
    sums: dict = {}
    for _, la, _, e in want:
        sums[la] = sums.get(la, 0) + e
    got = vector_codes.with_label_error(coded).collect()
    assert len(got) == len(want) and all(r.label_error == sums[r.label] for r in got)


def test_nothing_to_code(spark):
    for rows in ([], [(1, None, 1), (2, [], None), (3, [1.0], 2)]):
        coded, books = vector_codes.compress(frame(spark, rows, 1))
        assert coded.collect() == [] and books.size == 0
        assert vector_codes.with_label_error(coded).collect() == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large to code"):
        vector_codes.compress(frame(spark, [(1, [1e30] * 16, 1), (2, [0.0] * 16, 1)], 1))


def test_query_digest(spark):
    small = "/root/testdata/sf0.001"
    got = queries.op13_vector_codes(spark, small).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", F.col("label").cast("int")).collect()]
    want, books = plain(rows)
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted((i, c, e) for i, _, c, e in want)
