"""Removal of word windows that an earlier document has, by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of BLOCK words, and the blocks are
indexed. Every rolling window of BLOCK words of every document probes the index. As BLOCK is
(window + 1) // 2, any repeated window of `window` words holds a whole reference block of the earlier
document, so no repeat is missed. Around each hit the exact repeats are found by the windows of
full length that hold the hit block: each goes, with its document, to the place of its hash, the
smallest document there keeps it, and the others lose it. Windows lost next to each other join to
maximal exact repeats.

Index and probes meet in one packed shuffle; hits go back to their documents as hash and id, never
as pairs of occurrences, so a passage that thousands of documents share costs one record each.

doc_id decides which document is earlier; a null id comes after all others. Rows with equal ids keep
their common windows. Null or empty text has no words. Repeated rows: one result each. Empty table:
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowwarden.llm.exchange import (
    LAST, SCHEMA, batched, buckets, gather, ids_of, place, scatter, scatter_texts, settle, shuffled, split, texts_in,
)
from rowwarden.llm.textblocks import Words, blocks, covered, mix, runs, windows, word_hashes, words

WINDOW = 13
HIT, TEXT = 0, 1
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<first: long, last: long>>"


def rolling(hashes: np.ndarray, found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of the windows that lie in one document, and their hashes."""
    at = np.flatnonzero(found.left() >= size)
    return at, windows(hashes, size)[at]


def _spread(at: np.ndarray, found: Words, block: int, window: int) -> np.ndarray:
    """Starts of the full windows that hold a block at one of the given words and lie in its document."""
    starts = np.unique((at[:, None] - np.arange(window - block + 1)).ravel())
    starts = starts[starts >= 0]
    fits = found.left()[starts] >= window if len(starts) else np.zeros(0, bool)
    starts = starts[fits]
    return starts


def _member(values: np.ndarray, owners: np.ndarray, sorted_owner: np.ndarray, sorted_value: np.ndarray) -> np.ndarray:
    """Whether each (owner, value) is among the pairs given; both pair lists hash to one number."""
    if not len(sorted_owner):
        return np.zeros(len(values), bool)
    have = np.sort(mix(sorted_owner.view(np.uint64)) ^ sorted_value)
    want = mix(owners.view(np.uint64)) ^ values
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    return have[at] == want


def repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: words, removed words, digest of the words kept, and the removed word spans."""
    size = (window + 1) // 2
    spark = docs.sparkSession
    n = buckets(spark)
    docs = docs.select(docs[key].cast("long").alias(key), docs[text])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for block in blocks(batches, text):
                found = words(block)
                at, keys = rolling(word_hashes(block.data, found), found, size)
                owner = ids_of(block, key)[found.row[at]]
                anchor = (at - found.first[found.row[at]]) % size == 0
                # 31 bits beside the bucket's own: what meets by chance is sorted out with full hashes later
                short = (keys >> np.uint64(33)).astype(np.uint32) << np.uint32(1) | anchor
                yield (keys % np.uint64(n)).astype(np.int32), {"short": short, "doc": owner}

        yield from batched(scatter(parts()))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches, {0: {"short": np.uint32, "doc": np.int64}})[0]
        keys = got["bucket"].astype(np.uint64) << np.uint64(32) | (got["short"] >> np.uint32(1))
        anchor, doc = (got["short"] & np.uint32(1)).astype(bool), got["doc"]
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, anchor, doc = keys[order], anchor[order], doc[order]
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        group = np.cumsum(np.concatenate(([False], keys[1:] != keys[:-1])))
        first = np.minimum.reduceat(np.where(anchor, doc, LAST), edge)[group]
        last = np.maximum.reduceat(doc, edge)[group]
        hit = (first < doc) | (anchor & (doc < last))
        keys, doc = keys[hit], doc[hit]
        if len(doc):
            yield from batched(scatter(iter([(place(doc, n), {"doc": doc, "key": keys})]), HIT))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = blocks(batches, text)
        yield from batched(scatter_texts(own, lambda b: ids_of(b, key), lambda ids: place(ids, n), TEXT))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, loads = split(batches, HIT, TEXT, {"doc": np.int64, "key": np.uint64})

        def parts():
            for ids, block in texts_in(iter(loads)):
                found = words(block)
                hashes = word_hashes(block.data, found)
                at, keys = rolling(hashes, found, size)
                partial = (keys % np.uint64(n)) << np.uint64(32) | (keys >> np.uint64(33))
                near = at[_member(partial, ids[found.row[at]], hits["doc"], hits["key"])]
                start = _spread(near, found, size, window)
                full = windows(hashes, window)[start] if len(start) else np.zeros(0, np.uint64)
                yield (full % np.uint64(n)).astype(np.int32), {"key": full, "doc": ids[found.row[start]]}

        yield from batched(scatter(parts()))

    def keep_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches, {0: {"key": np.uint64, "doc": np.int64}})[0]
        if not len(got["key"]):
            return
        order = np.argsort(got["key"], kind="stable")
        keys, doc = got["key"][order], got["doc"][order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        first = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
        lost = doc > first
        if lost.any():
            yield from batched(scatter(iter([(place(doc[lost], n), {"doc": doc[lost], "key": keys[lost]})]), HIT))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost, loads = split(batches, HIT, TEXT, {"doc": np.int64, "key": np.uint64})
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for ids, block in texts_in(iter(loads)):
            found = words(block)
            total = len(found.start)
            at, keys = rolling(word_hashes(block.data, found), found, window)
            gone = covered(total, at[_member(keys, ids[found.row[at]], lost["doc"], lost["key"])], window)
            digests, spans, removed = [], [], []
            raw = block.data.tobytes()
            for i in range(len(block)):
                a, b = found.first[i], found.first[i + 1]
                mine = gone[a:b]
                kept = np.flatnonzero(~mine) + a
                digests.append(hashlib.sha256(b" ".join(raw[s:e] for s, e in zip(found.start[kept], found.end[kept]))).hexdigest())
                removed.append(int(mine.sum()))
                spans.append([{"first": int(s), "last": int(e) - 1} for s, e in zip(*runs(mine))] if removed[-1] else [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=ids == LAST),
                    pa.array(found.counts().astype(np.int64)),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(spans, span),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"],
            )

    hits = settle(shuffled(docs.mapInArrow(probe, SCHEMA), meet, SCHEMA))
    candidates = shuffled(hits.unionByName(docs.mapInArrow(texts, SCHEMA)), extend, SCHEMA)
    lost = settle(shuffled(candidates, keep_first, SCHEMA))
    return shuffled(lost.unionByName(docs.mapInArrow(texts, SCHEMA)), remove, RESULT)
