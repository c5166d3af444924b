"""Operators on repeats between documents, against the plain definition."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rowwarden.llm import jaccard_join, repeated_windows, suffix_dedup
from rowwarden.llm.components import components
from rowwarden.llm.suffix_sort import common, order_with_lcp

from .conftest import frame, sentence

LAST = 2**63 - 1


def plain_words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def odd_rows(rows):
    """The corpus, a null id, and equal ids with equal and with other texts."""
    texts = [t for _, t, *_ in rows if t and len(plain_words(t)) > 150]
    return rows + [(None, texts[0], None, None), (None, texts[1], None, None), (1, texts[2], None, None), (1, texts[2], None, None)]


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def test_repeated_windows(spark, rows):
    given = odd_rows(rows)
    place = lambda d: LAST if d is None else d
    first: dict[tuple, int] = {}
    for d, t, *_ in given:
        w = plain_words(t)
        for i in range(len(w) - 12):
            g = tuple(w[i : i + 13])
            first[g] = min(first.get(g, LAST), place(d))
    want = []
    for d, t, *_ in given:
        w, gone = plain_words(t), set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < place(d):
                gone.update(range(i, i + 13))
        want.append((d is None, d or 0, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode())))
    got = repeated_windows.repeats(frame(spark, given, 5)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)
    assert all(r.n_removed == sum(s.last - s.first + 1 for s in r.removed) for r in got)
    assert sum(r.n_removed for r in got) > 500


def plain_bytes(texts: list[bytes], length: int) -> list[np.ndarray]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("length,hot", [(400, suffix_dedup.HOT), (100, suffix_dedup.HOT), (100, 3)])
def test_suffix_dedup(spark, rows, length, hot):
    given = odd_rows(rows) + [(9000, "ab" * 700, None, None), (9001, "zé" * 300, None, None), (9002, "q" * (length + 1), None, None)]
    texts = [(t or "").encode() for _, t, *_ in given]
    want = []
    for (d, *_), t, gone in zip(given, texts, plain_bytes(texts, length)):
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want.append((d is None, d or 0, len(t), int(gone.sum()), spans, sha(np.frombuffer(t, np.uint8)[~gone].tobytes())))
    got = suffix_dedup.repeats(frame(spark, given, 5), length, hot).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert sum(r.n_removed for r in got) > 2000


def test_deep_shallow_order():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 90))) for _ in range(300)]
    strings += [b"a" * n for n in range(60)] + [strings[0]] * 3 + [b"x" * 70 + s for s in strings[:80]]
    for shallow in (0, 8, 32, 1000):
        order, lcp = order_with_lcp(strings, 0, shallow)
        assert [strings[i] for i in order] == sorted(strings)
        assert sorted(order) == list(range(len(strings)))
        assert lcp == [-1] + [common(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    assert common(b"abc", b"abd") == 2 and common(b"", b"x") == 0 and common(b"ab", b"abc") == 2


def shingles(text: str | None, gram: int) -> frozenset:
    w = plain_words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i : i + gram]) for i in range(max(len(w) - gram + 1, 1))) if w else frozenset()


def plain_components(given, gram: int, percent: int) -> list[tuple]:
    sets = [shingles(t, gram) for _, t, *_ in given]
    parent = {d: d for d, *_ in given if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, *_) in enumerate(given):
        for j in range(i):
            b = given[j][0]
            common_size = len(sets[i] & sets[j])
            if a is not None and b is not None and 0 < 100 * common_size >= percent * (len(sets[i] | sets[j])):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(d is None, d or 0, len(s), None if d is None else root(d)) for (d, *_), s in zip(given, sets)]


def near_rows() -> list[tuple]:
    """Groups of near copies on both sides of the limits, of many sizes, and hubs that don't link."""
    rng = random.Random(8)
    out, d = [], 100
    for size in (3, 4, 9, 11, 12, 20, 33, 60, 150, 400):
        base = sentence(rng, "en", size).split()
        for k in range(14):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, size // 18))):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1])] = [rng.choice("uvwxyz")] * rng.choice([0, 1])
            out.append((d, " ".join(words).upper() if k % 5 == 0 else " ".join(words), None, None))
            d += 1
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("gram,percent", [(3, 90), (5, 80), (2, 60)])
def test_jaccard_join(spark, rows, gram, percent):
    given = rows + near_rows() + [(None, rows[0][1], None, None), (1, rows[1][1], None, None)]
    got = jaccard_join.join(frame(spark, given, 5), gram, percent).collect()
    want = plain_components(given, gram, percent)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == sorted(w for w in want if not w[0])
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert len({w[3] for w in want}) < len(want) - 40


def test_every_allocation_finds_all_links(spark, monkeypatch):
    given = near_rows()
    want = sorted(plain_components(given, 3, 80))
    real = jaccard_join.priced

    def doubled(*args):
        scheme = real(*args)
        low, doubles = scheme.low, (scheme.most + 1) // 2
        return jaccard_join.allocation(low, 80, doubles)

    monkeypatch.setattr(jaccard_join, "priced", doubled)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    got = jaccard_join.join(frame(spark, given, 4), 3, 80).collect()
    assert sorted((False, r.doc_id, r.n_shingles, r.component_id) for r in got) == want


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_sketches_tell_large_sets_apart_and_hide_no_link(percent):
    rng = np.random.default_rng(percent)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    found, unlike = [], []
    for size in (3, 40, 300, 2000, 9000):
        base = draw(size)
        found += [base] + [np.union1d(base[rng.random(len(base)) > f], draw(int(f * size))) for f in (0.01, 0.04, 0.05, 0.1, 0.11, 0.13)]
        unlike.append((len(found) - 1, len(found)))
        found.append(draw(size))
    first = np.concatenate(([0], np.cumsum([len(x) for x in found])))
    sets = jaccard_join.Sets(np.concatenate(found), np.repeat(np.arange(len(found)), np.diff(first)), first)
    one, two = (x.ravel() for x in np.meshgrid(np.arange(len(found)), np.arange(len(found))))
    may = jaccard_join.able(sets.sizes(), jaccard_join.sketches(sets, percent), one, two, percent)
    partner = np.array([jaccard_join.is_partner(found[a], found[b], percent) for a, b in zip(one, two)])
    assert not (partner & ~may).any() and may.sum() < 1.5 * partner.sum()
    assert not any(may[(one == a) & (two == b)].any() for a, b in unlike)


def test_filter_of_pairs_takes_few_jobs(spark):
    ids = spark.range(0, 5000, 7, 8).withColumnRenamed("id", "doc_id")
    spark.sparkContext.setJobGroup("filter", "filter of pairs")
    try:
        words = jaccard_join._bitmap(ids)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < int(np.bitwise_count(words.view(np.uint64)).sum()) <= 2 * ids.count()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("filter")) <= 4


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(7, 7)]
    around = defaultdict(set)
    for a, b in pairs:
        if a != b:
            around[a].add(b)
            around[b].add(a)
    want = {}
    for n in sorted(around):
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = n
                todo += around[x]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables(no_docs):
    assert repeated_windows.repeats(no_docs).count() == 0
    assert suffix_dedup.repeats(no_docs).count() == 0
    assert jaccard_join.join(no_docs).count() == 0
