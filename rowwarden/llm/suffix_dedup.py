"""Removal of long byte strings that occur more than once, by sorted suffixes.

Any `length` bytes hold an anchor: the smallest hash of the KMER-byte strings in them, so equal
stretches have equal anchors at equal places. The context of an anchor is as many bytes to the left
and right as a stretch around it can have. Names go first: a hash of the anchor, a hash of the context
and the document. Where an anchor meets itself, a context that occurs more than once is repeated in full,
which needs no bytes. Only if contexts differ is each of them sent to the anchor's place, once, by one
document that holds it. There the suffixes that start at the anchor, and the reversed prefixes that end at it, are put in
order by deep-shallow sorting (`suffix_sort`); the common prefixes of neighbours give, for every
split of the length into a part before and a part after the anchor, which contexts agree, and so
how far the repeats of each reach. All occurrences of a repeat are removed, as asked.

Sorting full suffixes of everything would send hundreds of bytes per byte of input; anchors do it
for about two occurrences in `length` bytes, and only where texts differ around something that repeats. What
meets in one place grows with the different contexts of an anchor, not with its occurrences. If an anchor has more
than HOT different contexts, they are not sorted in one place: their stretches are counted by full hash instead.

Null or empty text: no bytes. Matches never cross rows. Repeated rows (equal ids or null ids too)
are documents of their own. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.exchange import (
    LAST, SCHEMA, batched, buckets, gather, ids_of, pack, place, scatter, scatter_texts, settle, shuffled, split, texts_in, unpack,
)
from rowwarden.llm.suffix_sort import common, order_with_lcp
from rowwarden.llm.textblocks import Block, blocks, covered, mix, prefix, runs, span_hash

LENGTH = 400
KMER = 32
SHALLOW = 32  # bytes beyond those known to be equal
HOT = 200_000  # different contexts of an anchor; stretches of those with more are counted, not sorted
WHOLE = np.iinfo(np.uint16).max  # a reach as far as the context goes
REACH, TEXT, CONTEXT, REQUEST, STRETCH = range(5)
NAME_LIKE = {"anchor": np.uint64, "doc": np.int64, "context": np.uint64}
REQUEST_LIKE = {"doc": np.int64, "context": np.uint64, "many": np.uint8, "hot": np.uint8}
CONTEXT_LIKE = {"context": np.uint64, "anchor": np.uint64, "doc": np.int64, "many": np.uint8, "left": np.uint16, "right": np.uint16}
STRETCH_LIKE = {"stretch": np.uint64, "context": np.uint64, "doc": np.int64, "before": np.uint16, "many": np.uint8}
REACH_LIKE = {"doc": np.int64, "context": np.uint64, "before": np.uint16, "after": np.uint16}
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start_at: long, end_at: long>>"


def _sliding(values: np.ndarray, size: int, fold: np.ufunc, fill: int) -> np.ndarray:
    """fold over every `size` consecutive values."""
    n = len(values)
    table = np.full(-(-n // size) * size, fill, values.dtype)
    table[:n] = values
    table = table.reshape(-1, size)
    ahead = fold.accumulate(table, axis=1).ravel()
    back = fold.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return fold(back[: n - size + 1], ahead[size - 1 : n])


def anchors(block: Block, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a block, and the prefix sums of its bytes."""
    data, n = block.data, len(block.data)
    sums = prefix(data)
    inside = n - KMER + 1
    if inside < length - KMER + 1 or not (np.diff(block.offsets) >= length).any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), sums
    at = np.arange(inside)
    end = np.repeat(block.offsets[1:], np.diff(block.offsets))
    hashes = span_hash(sums, at, at + KMER)
    none = np.iinfo(np.uint64).max
    hashes[at + KMER > end[:inside]] = none
    width = length - KMER + 1
    least = _sliding(hashes, width, np.minimum, none)
    starts = np.arange(len(least))
    least[starts + length > end[: len(least)]] = 0  # a stretch that would leave its row
    pad = np.zeros(width - 1, np.uint64)
    best = _sliding(np.concatenate((pad, least, pad)), width, np.maximum, 0)
    found = np.flatnonzero((best == hashes) & (hashes != none))
    return found, hashes[found], sums


def contexts(block: Block, at: np.ndarray, sums: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, bytes before and after, and hash of the context of every anchor position."""
    row = np.searchsorted(block.offsets, at, "right") - 1
    left = np.minimum(length - KMER, at - block.offsets[row])
    right = np.minimum(length, block.offsets[row + 1] - at)
    return row, left, right, mix(span_hash(sums, at - left, at + right) ^ mix(left.astype(np.uint64)))


def _keyed(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(owner.view(np.uint64)) ^ value


def _find(have: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value in a sorted array, and whether it is there."""
    if not len(have):
        return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    return at, have[at] == want


def reaches(anchor: np.ndarray, left: list[bytes], right: list[bytes], many: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """How far before and after its anchor the repeats of each distinct context reach (0, 0: none).

    anchor: sorted anchor hashes; left: the bytes before the anchor, reversed; right: those from the
    anchor on; many: whether the context itself occurs more than once.
    """
    n = len(anchor)
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def reach(i, low, high):
        ok = low <= high
        before[i] = np.where(ok, np.maximum(before[i], high), before[i])
        after[i] = np.where(ok, np.maximum(after[i], length - low), after[i])

    size_left, size_right = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    again = np.flatnonzero(many)
    reach(again, np.maximum(0, length - size_right[again]), size_left[again])

    edge = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1], [True])))
    items: list[int] = []
    place_l: list[int] = []
    place_r: list[int] = []
    lcp_l: list[int] = []
    lcp_r: list[int] = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a == 2:
            high, low = common(left[a], left[a + 1]), length - common(right[a], right[a + 1])
            if max(low, 0) <= high:
                reach(np.array([a, a + 1]), max(low, 0), high)
        elif b - a > 2:
            base = len(items)
            order, lcp = order_with_lcp(left[a:b], 0, SHALLOW)
            rank = [0] * (b - a)
            for k, i in enumerate(order):
                rank[i] = base + k
            place_l += rank
            lcp_l += lcp
            order, lcp = order_with_lcp(right[a:b], KMER, KMER + SHALLOW)
            for k, i in enumerate(order):
                rank[i] = base + k
            place_r += rank
            lcp_r += lcp
            items += range(a, b)
    if not items:
        return before, after
    item, pl, pr = np.array(items), np.array(place_l), np.array(place_r)
    ll, lr = np.array(lcp_l), np.array(lcp_r)
    near = lambda lcp, p: np.maximum(lcp, np.concatenate((lcp[1:], [-1])))[p]
    most_l, most_r = near(ll, pl), near(lr, pr)
    for d in range(length - KMER + 1):  # bytes before the anchor
        able = np.flatnonzero((most_l >= d) & (most_r >= length - d))
        if not len(able):
            continue
        # neighbours in order that agree this far form one class; both classes shared: same stretch
        class_l, class_r = np.cumsum(ll < d)[pl[able]], np.cumsum(lr < length - d)[pr[able]]
        both = class_l * (len(item) + 1) + class_r
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        hit = np.zeros(len(able), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        i = item[able[hit]]
        before[i] = np.maximum(before[i], d)
        after[i] = np.maximum(after[i], length - d)
    return before, after


def repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: bytes, removed bytes, removed runs, digest of the bytes kept, and the runs."""
    if length < 2 * KMER:
        raise ValueError(f"length must be {2 * KMER} or more")
    n = buckets(docs.sparkSession)
    docs = docs.select(docs[key].cast("long").alias(key), docs[text])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for block in blocks(batches, text):
                at, keys, sums = anchors(block, length)
                row, left, right, name = contexts(block, at, sums, length)
                full = left + right >= length
                yield (keys[full] % np.uint64(n)).astype(np.int32), {"anchor": keys[full], "doc": ids_of(block, key)[row[full]], "context": name[full]}

        yield from batched(scatter(parts()))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches, {0: NAME_LIKE})[0]
        if not len(got["anchor"]):
            return
        order = np.lexsort((got["doc"], got["context"], got["anchor"]))
        keys, name, doc = (got[c][order] for c in ("anchor", "context", "doc"))
        del got, order
        new_key = np.concatenate(([True], keys[1:] != keys[:-1]))
        new = new_key | np.concatenate(([True], name[1:] != name[:-1]))
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(keys)))
        anchor_of = np.cumsum(new_key)[first] - 1
        different = np.bincount(anchor_of)[anchor_of]
        # what occurs more than once is repeated as far as it goes, in each document that has it
        again = np.repeat(times > 1, times) & (new | np.concatenate(([True], doc[1:] != doc[:-1])))
        yield from _reach_rows(doc[again], name[again], np.full(again.sum(), WHOLE), np.full(again.sum(), WHOLE), n)
        asked = different > 1
        pick = first[asked]
        columns = {"doc": doc[pick], "context": name[pick], "many": (times[asked] > 1).astype(np.uint8), "hot": (different[asked] > hot).astype(np.uint8)}
        yield from batched(scatter(iter([(place(doc[pick], n), columns)]), REQUEST))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(scatter_texts(blocks(batches, text), lambda b: ids_of(b, key), lambda ids: place(ids, n), TEXT))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, loads = split(batches, REQUEST, TEXT, REQUEST_LIKE)
        wanted = _keyed(asked["doc"], asked["context"])
        order = np.argsort(wanted)
        wanted, many, is_hot = wanted[order], asked["many"][order], asked["hot"][order] > 0
        given = np.zeros(len(wanted), bool)
        if not len(wanted):
            return

        def context_rows():
            for ids, block in texts_in(iter(loads)):
                at, keys, sums = anchors(block, length)
                row, left, right, name = contexts(block, at, sums, length)
                where, there = _find(wanted, _keyed(ids[row], name))
                where = np.where(there, where, -1)
                _, pick = np.unique(where, return_index=True)  # one place of each context
                pick = pick[there[pick] & ~given[where[pick]]]
                given[where[pick]] = True
                counted = is_hot[where[pick]]
                sorted_, few = pick[~counted], pick[counted]
                if len(sorted_):
                    yield from _context_rows(block, sorted_, at, keys, left, right, name, ids[row], many[where], n)
                if len(few):
                    yield from scatter(_stretches(at[few], left[few], right[few], name[few], ids[row[few]], many[where[few]], sums, length, n), STRETCH)

        yield from batched(context_rows())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[dict[str, np.ndarray]] = []
        before_, after_ = [], []

        def records():
            for batch in batches:
                kind = batch.column(1).to_numpy()
                for i in np.flatnonzero(kind == CONTEXT).tolist():
                    heads.append(_read_contexts(batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), before_, after_))
                yield batch.filter(pa.array(kind != CONTEXT))

        counted = gather(records(), {STRETCH: STRETCH_LIKE})[STRETCH]
        if heads:
            anchor, name, doc, many = (np.concatenate([h[c] for h in heads]) for c in ("anchor", "context", "doc", "many"))
            order = np.lexsort((name, anchor))
            left, right = [before_[i] for i in order], [after_[i] for i in order]
            before, after = reaches(anchor[order], left, right, many[order] > 0, length)
            some = (after > 0) & (many[order] == 0)  # the others are repeated in full already
            yield from _reach_rows(doc[order][some], name[order][some], before[some], after[some], n)
        if len(counted["stretch"]):
            order = np.argsort(counted["stretch"], kind="stable")
            s = counted["stretch"][order]
            new = np.concatenate(([True], s[1:] != s[:-1]))
            group = np.cumsum(new) - 1
            some = (np.bincount(group, 1 + counted["many"][order])[group] > 1) & (counted["many"][order] == 0)
            pick = order[some]
            before = counted["before"][pick].astype(np.int64)
            yield from _reach_rows(counted["doc"][pick], counted["context"][pick], before, length - before, n)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach, loads = split(batches, REACH, TEXT, REACH_LIKE)
        names = _keyed(reach["doc"], reach["context"])
        order = np.argsort(names, kind="stable")
        names = names[order]
        edge = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.zeros(0, np.int64)
        fold = lambda c: np.maximum.reduceat(reach[c][order].astype(np.int64), edge) if len(edge) else np.zeros(0, np.int64)
        before, after, names = fold("before"), fold("after"), names[edge]
        touched = np.unique(reach["doc"])
        span = pa.list_(pa.struct([("start_at", pa.int64()), ("end_at", pa.int64())]))
        for ids, block in texts_in(iter(loads)):
            gone = np.zeros(len(block.data), bool)
            if _find(touched, ids)[1].any():
                at, _, sums = anchors(block, length)
                row, left, right, name = contexts(block, at, sums, length)
                where, there = _find(names, _keyed(ids[row], name))
                at, where = at[there], where[there]
                back, ahead = np.minimum(before[where], left[there]), np.minimum(after[where], right[there])
                gone = covered(len(block.data), at - back, back + ahead)
            removed, digests, spans = [], [], []
            for i in range(len(block)):
                a, b = block.offsets[i], block.offsets[i + 1]
                mine = gone[a:b]
                digests.append(hashlib.sha256(block.data[a:b][~mine].tobytes()).hexdigest())
                removed.append(int(mine.sum()))
                spans.append([{"start_at": int(s), "end_at": int(e)} for s, e in zip(*runs(mine))] if removed[-1] else [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=ids == LAST),
                    pa.array(np.diff(block.offsets)),
                    pa.array(removed, pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(spans, span),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    named = settle(shuffled(docs.mapInArrow(probe, SCHEMA), meet, SCHEMA))
    sent = shuffled(named.where(F.col("kind") == REQUEST).unionByName(docs.mapInArrow(texts, SCHEMA)), send, SCHEMA)
    reached = settle(shuffled(sent, compare, SCHEMA)).unionByName(named.where(F.col("kind") == REACH))
    return shuffled(reached.unionByName(docs.mapInArrow(texts, SCHEMA)), remove, RESULT)


def _context_rows(block: Block, pick, at, keys, left, right, name, doc, many, n: int) -> Iterator[tuple[int, int, int, bytes]]:
    bucket = (keys[pick] % np.uint64(n)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    pick, bucket = pick[order], bucket[order]
    edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(pick) else [0]
    for a, b in zip(edge[:-1], edge[1:]):
        own = pick[a:b]
        sizes = {"left": left[own].astype(np.uint16), "right": right[own].astype(np.uint16)}
        head = pack({"context": name[own], "anchor": keys[own], "doc": doc[own], "many": many[own], **sizes})
        body = b"".join(block.data[at[k] - left[k] : at[k] + right[k]].tobytes() for k in own)
        yield int(bucket[a]), CONTEXT, int(b - a), len(head).to_bytes(8, "big") + head + zstandard.ZstdCompressor(level=3).compress(body)


def _read_contexts(n: int, load: bytes, before: list[bytes], after: list[bytes]) -> dict[str, np.ndarray]:
    """The columns of packed contexts; their bytes before (reversed) and after the anchor are added to the lists."""
    size = int.from_bytes(load[:8], "big")
    head = unpack(load[8 : 8 + size], n, CONTEXT_LIKE)
    body, at = zstandard.ZstdDecompressor().decompress(load[8 + size :]), 0
    for left, right in zip(head["left"].tolist(), head["right"].tolist()):
        before.append(body[at : at + left][::-1])
        after.append(body[at + left : at + left + right])
        at += left + right
    return head


def _stretches(at, left, right, name, doc, many, sums, length: int, n: int) -> Iterator[tuple[np.ndarray, dict]]:
    """Full hashes of all stretches around anchors with too many different contexts to be sorted in one place."""
    for d in range(length - KMER + 1):
        ok = np.flatnonzero((left >= d) & (right >= length - d))
        # with the anchor's place: a stretch that holds two anchors must not meet itself
        stretch = mix(span_hash(sums, at[ok] - d, at[ok] + length - d) ^ np.uint64(d))
        before = np.full(len(ok), d, np.uint16)
        yield (stretch % np.uint64(n)).astype(np.int32), {"stretch": stretch, "context": name[ok], "doc": doc[ok], "before": before, "many": many[ok]}


def _reach_rows(doc, context, before, after, n: int) -> Iterator[pa.RecordBatch]:
    columns = {"doc": doc, "context": context, "before": before.astype(np.uint16), "after": after.astype(np.uint16)}
    yield from batched(scatter(iter([(place(doc, n), columns)]), REACH))
