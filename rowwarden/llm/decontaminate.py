"""Benchmark decontamination over a distributed positional inverted index.

`build_index` turns documents into index blocks. A block holds some documents and, for every term
of a vocabulary (all terms if none is given), the sorted positions at which the term stands in the
block. Blocks are rows of a DataFrame: they can be searched as they are made or stored and searched
later, and nothing is shuffled to make them.

`search` gives every block the test phrases. In a block a phrase starts from its rarest term there;
the positions of that term, moved by the term's place in the phrase, are intersected with the lists
of the other terms, rarest first. All phrases of a block go through this together, array-wise.
Exact matches need all terms in place; proximity matches (`near`) need every term of the phrase
within `slack` words of its place around an occurrence of the rarest term.

Test phrases are sent to every task. Their size is checked: `phrase_sets` splits the test items
into sets of at most `PHRASE_BYTES`, and a larger test set is searched set by set, each set against
all documents.

Terms are 64-bit hashes of lower-cased words. Null or empty text has no words and no match; null or
wordless items match nothing. Repeated documents: one result row each. Repeated items (equal
item_id): their windows are pooled, the id counts once. Empty tables: empty result, or no match.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.textblocks import LOWER, NOT_ALNUM, Block, blocks, covered, runs, word_hashes, words
from rowwarden.session import cut_lineage

WINDOW = 13
HIT_SHARE = 20  # a document is contaminated if 1 word in 20, or more, is hit
PHRASE_BYTES = 32 << 20  # of test text in one set

INDEX = "block long, doc_ids array<long>, first binary, terms binary, bounds binary, positions binary"
MATCHES = "row_key long, doc_id long, n_words long, spans array<struct<start: long, length: long>>, items array<string>"


def terms_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of a block in order, and the first term of each row (one more at the end)."""
    data = LOWER[block.data]
    found = words(block, NOT_ALNUM, data)
    return word_hashes(data, found), found.first


def indexer(vocabulary, key: str, text: str):
    """What a task does to make index blocks. vocabulary: a broadcast of sorted term hashes to keep, or None for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_id = TaskContext.get().partitionId() << 36
        for block in blocks(batches, text):
            terms, first = terms_of(block)
            at = np.arange(len(terms), dtype=np.int32)
            if vocabulary is not None:
                known = vocabulary.value
                place = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
                at = at[known[place] == terms] if len(known) else at[:0]
            order = at[np.argsort(terms[at], kind="stable")]
            listed = terms[order]
            edge = np.flatnonzero(np.concatenate(([True], listed[1:] != listed[:-1]))) if len(listed) else np.zeros(0, int)
            bounds = np.concatenate((edge, [len(listed)])).astype(np.int32)
            row = {
                "block": [block_id],
                "doc_ids": [block.column(key).to_pylist()],
                "first": [first.astype(np.int32).tobytes()],
                "terms": [listed[edge].tobytes()],
                "bounds": [bounds.tobytes()],
                "positions": [order.astype(np.int32).tobytes()],
            }
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))
            block_id += len(block)

    return run


def _picked(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[key].cast("long").alias(key), docs[text])


def build_index(docs: DataFrame, vocabulary=None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Index blocks of docs, with the positions of every term or of those in the vocabulary."""
    return _picked(docs, key, text).mapInArrow(indexer(vocabulary, key, text), INDEX)


class Phrases:
    """Test phrases of equal length classes: per length a matrix of term hashes and the items that hold them."""

    def __init__(self, items: list[str], texts: list[str], size: int):
        rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        seen, at = [], 0
        for block in blocks(iter([rows]), "text"):
            terms, first = terms_of(block)
            seen.append(terms)
            n = np.diff(first)
            left = np.repeat(first[1:], n) - np.arange(len(terms))
            item = np.repeat(np.arange(at, at + len(n)), n)
            start = np.flatnonzero(left >= size)
            by_length.setdefault(size, []).append((terms[start[:, None] + np.arange(size)], item[start]))
            for i in np.flatnonzero((n > 0) & (n < size)):
                by_length.setdefault(int(n[i]), []).append((terms[None, first[i] : first[i + 1]], np.array([at + i])))
            at += len(n)
        self.items = items
        self.vocabulary = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
        self.sets = []
        for length, parts in by_length.items():
            # by vocabulary number, so that a block needs one look-up per term
            matrix = np.searchsorted(self.vocabulary, np.concatenate([m for m, _ in parts]))
            self.sets.append((length, matrix.astype(np.int32), np.concatenate([i for _, i in parts])))


def phrase_sets(items: DataFrame, size: int = WINDOW, key: str = "item_id", text: str = "text") -> Iterator[Phrases]:
    """The test items in sets of bounded size; one set unless the test text passes PHRASE_BYTES."""
    picked = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("body")).where("item is not null and body is not null")
    total = picked.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    sets = -(-2 * total // PHRASE_BYTES) if total > PHRASE_BYTES else 1
    for k in range(sets):
        part = picked if sets == 1 else picked.where(F.pmod(F.xxhash64("item", "body"), F.lit(sets)) == k)
        rows = part.toArrow()
        yield Phrases(rows.column("item").to_pylist(), rows.column("body").to_pylist(), size)


class Postings:
    """The lists of one index block, as one sorted array of (vocabulary number, position)."""

    def __init__(self, vocabulary: np.ndarray, row: dict):
        self.first = np.frombuffer(row["first"], np.int32).astype(np.int64)
        terms, bounds = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["bounds"], np.int32)
        positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        counts = np.diff(bounds)
        number = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
        known = vocabulary[number] == terms if len(vocabulary) else np.zeros(len(terms), bool)
        self.n = int(self.first[-1])
        self.size = np.zeros(len(vocabulary), np.int64)
        self.size[number[known]] = counts[known]
        keep = np.repeat(known, counts)
        self.keys = np.repeat(number, counts)[keep] * (self.n + 1) + positions[keep]
        self.start = np.concatenate(([0], np.cumsum(self.size)))

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each term stands at the given position."""
        wanted = term.astype(np.int64) * (self.n + 1) + position
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return self.keys[at] == wanted if len(self.keys) else np.zeros(len(wanted), bool)

    def within(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each term stands anywhere in [low, high]."""
        base = term.astype(np.int64) * (self.n + 1)
        a = np.searchsorted(self.keys, base + np.maximum(low, 0))
        return a < np.searchsorted(self.keys, base + np.minimum(high, self.n), "right")

    def find(self, matrix: np.ndarray, slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Phrase (row of the matrix) and start position of every match that lies in one document."""
        phrases, length = matrix.shape
        sizes = self.size[matrix]
        alive = np.flatnonzero((sizes > 0).all(1))
        order = np.argsort(sizes[alive], axis=1, kind="stable")
        rare = order[:, 0] if length else np.zeros(0, np.int64)
        head = matrix[alive, rare]
        n = self.size[head]
        which = np.repeat(np.arange(len(alive)), n)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        position = self.keys[np.repeat(self.start[head], n) + inner] % (self.n + 1)
        start = position - rare[which]
        row = np.searchsorted(self.first, position, "right") - 1
        low, high = self.first[row], self.first[row + 1]
        fits = (start >= low) & (start + length <= high) if not slack else np.ones(len(start), bool)
        which, start, low, high = which[fits], start[fits], low[fits], high[fits]
        for k in range(1, length):
            place = order[which, k]
            term = matrix[alive[which], place]
            if slack:
                middle = start + place
                ok = self.within(term, np.maximum(middle - slack, low), np.minimum(middle + slack, high - 1))
            else:
                ok = self.holds(term, start + place)
            which, start, low, high = which[ok], start[ok], low[ok], high[ok]
        return alive[which], start


def search(index: DataFrame, phrases, slack: int = 0) -> DataFrame:
    """A row per indexed document: its words, the merged spans of matched words, and the items matched.

    phrases: a broadcast of Phrases. slack 0: exact phrases; more: proximity, a span then being the
    place the phrase would take, cut to the document.
    """
    return index.mapInArrow(searcher(phrases, slack), MATCHES)


def searcher(phrases, slack: int):
    """What a task does to search index blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: Phrases = phrases.value
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            for row in batch.to_pylist():
                postings = Postings(wanted.vocabulary, row)
                first, docs = postings.first, len(row["doc_ids"])
                hit = np.zeros(postings.n, bool)
                pairs: set[tuple[int, int]] = set()
                for length, matrix, item in wanted.sets:
                    phrase, start = postings.find(matrix, slack)
                    doc = np.searchsorted(first, start + (np.minimum(length, slack) if slack else 0), "right") - 1
                    doc = np.clip(doc, 0, docs - 1)
                    low, high = np.maximum(start, first[doc]), np.minimum(start + length, first[doc + 1])
                    hit |= covered(postings.n, low, np.maximum(high - low, 0))
                    pairs.update(zip(doc.tolist(), item[phrase].tolist()))
                # a one-position gap between documents keeps their spans apart
                apart = np.arange(postings.n) + np.repeat(np.arange(docs), np.diff(first))
                wide = np.zeros(postings.n + docs, bool)
                wide[apart] = hit
                start, end = runs(wide)
                doc = np.searchsorted(first + np.arange(docs + 1), start, "right") - 1
                spans: list[list[dict]] = [[] for _ in range(docs)]
                for d, s, e in zip(doc, start, end):
                    spans[d].append({"start": int(s - first[d] - d), "length": int(e - s)})
                items: list[list[str]] = [[] for _ in range(docs)]
                for d, i in pairs:
                    items[d].append(wanted.items[i])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row["block"], row["block"] + docs)),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(np.diff(first)),
                        pa.array(spans, span),
                        pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
                    ],
                    names=["row_key", "doc_id", "n_words", "spans", "items"],
                )

    return run


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, slack: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Exact (or, with slack, proximity) matches of all windows of the items in every document."""
    context = docs.sparkSession.sparkContext
    sets = phrase_sets(items, size)
    first, second = next(sets), next(sets, None)
    if second is None:  # bounded by PHRASE_BYTES of text, as each set below
        make, look = indexer(context.broadcast(first.vocabulary), key, text), searcher(context.broadcast(first), slack)
        # blocks are searched where they are made: one Python worker a task, and no block leaves it
        return _picked(docs, key, text).mapInArrow(lambda batches: look(make(batches)), MATCHES)
    index = cut_lineage(build_index(docs, None, key, text))  # made once, searched set by set
    found = _merged(search(index, context.broadcast(first), slack), search(index, context.broadcast(second), slack))
    for part in sets:
        found = _merged(found, search(index, context.broadcast(part), slack))
    return found


def _merged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Results of two phrase sets over the same documents, put together per document."""
    both = left.unionByName(right).groupBy("row_key", "doc_id", "n_words")
    spans, items = F.flatten(F.collect_list("spans")), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    end = lambda s: s["start"] + s["length"]

    def join(done, s):
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), (F.greatest(end(last), end(s)) - last["start"]).alias("length"))
        touches = (F.size(done) > 0) & (end(last) >= s["start"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(s)))

    empty = F.array().cast("array<struct<start: long, length: long>>")
    merged = F.aggregate(F.array_sort("spans"), empty, join)
    return both.agg(spans.alias("spans"), items.alias("items")).select("row_key", "doc_id", "n_words", merged.alias("spans"), "items")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: words, words inside exact window matches, items matched, and the verdict."""
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"]), F.lit(0))
    return matches(docs, items, size, 0, key, text).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items",
        ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the contaminated ones, all columns kept; rows are told apart by id and text."""
    row, name = F.xxhash64(F.col(key), F.col(text)), "_bad"
    while name in docs.columns:
        name += "_"
    bad = contamination(docs.select(row.alias(name), F.col(text)), items, size, name, text).where("contaminated")
    bad = bad.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, row == F.col(name), "left_anti")
