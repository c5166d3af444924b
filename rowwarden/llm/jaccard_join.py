"""N-gram Jaccard join by partition of the universe and the pigeonhole principle.

A document's set holds its distinct word n-grams. Sets fall into size bands so wide that partners
lie in the same band or in neighbouring ones. For a band, `most` different elements are possible
between partners whose larger set lies in it; the universe is split by hash into segments, each
with a budget of 1 (partners must agree in the segment) or 2 (they may differ in one element), and
the budgets add up to `most` + 1 + `slack`. So partners agree in segments worth `slack` + 1 at least:
budget 1 indexes the segment's subset, budget 2 the subset and its one-deletion neighbourhood. Empty
subsets, which tell nothing, are left out by sets that have at most `slack` of them. How many segments get
budget 2 is chosen per band by the cost that each allocation has on a bounded sample (keys sent and
documents met); the choice changes the work, never the result.

Equal keys bring documents together. Per key only a star (its smallest document with each other one)
goes on, so a key shared by thousands costs a row for each. Stars are verified exactly on the texts.
Where a star has edges that fail, its documents may still link among each other: those of different
components are compared pairwise in blocks, first by sketches that never hide a link, then exactly. A sketch grows
with what partners of its size may differ in, so that it tells large sets apart as well as small ones.
Pairs inside a component need no look, as the result is components.

Equal sets are one class and link without a look. Null or empty text, or no words: an empty set,
linked with nothing. Fewer words than n: the whole sequence is the one element. A null id takes part
in no link and gets a null component. Rows with equal ids are one document and are linked. Empty
table: empty result. Other columns are ignored. Elements are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.components import components
from rowwarden.llm.exchange import SCHEMA, batched, buckets, gather, place, scatter, settle, shuffled
from rowwarden.llm.textblocks import CHUNK_BYTES, LOWER, Block, blocks, mix, windows, word_hashes, words

GRAM = 3
PERCENT = 90  # partners: 100 * intersection >= PERCENT * union
SAMPLE = 3000  # documents (expected) on which allocations are priced
PAIR_PRICE = 30.0  # keys sent that one meeting is worth
SMALL = 64  # bands that begin below get budget 2 throughout: their subsets are too small to tell texts apart
SKETCH = 512  # bits of the smallest sketch
PER_DIFFERENCE = 4  # bits of a sketch, at least, for each element that partners may differ in
WORDS = 1 << 20  # 64-bit words of the filter of documents on pairs: 8 MB
BLOCK = 2048  # documents of one side in a block of comparisons
PAIRS = 1 << 18  # pairs of a block looked at at once
PORTION = 4096  # pairs whose sketches are held against each other at once
LARGEST = 1 << 26  # elements; bands end there
KEYS, META = 0, 1
META_LIKE = {"doc": np.int64, "n": np.int64, "a": np.uint64, "b": np.uint64}
KEY_LIKE = {"short": np.uint32, "doc": np.int64}


@dataclass
class Scheme:
    """Per size band: its lowest size, most elements partners differ in, slack, and segments by budget."""

    low: np.ndarray
    most: np.ndarray
    slack: np.ndarray
    single: np.ndarray
    double: np.ndarray


def band_lows(percent: int) -> np.ndarray:
    low = [1]
    while low[-1] < LARGEST:
        low.append(max(low[-1] + 1, -(-100 * low[-1] // percent)))
    return np.array(low)


def most_different(low: np.ndarray, percent: int) -> np.ndarray:
    """Most elements two partners can differ in, if the larger set is in the band."""
    top = np.concatenate((low[1:] - 1, [LARGEST]))
    return 2 * top * (100 - percent) // (100 + percent)


def empty_slack(low: np.ndarray, most: np.ndarray) -> np.ndarray:
    """More empty segments than this are rare in a set of the band's lowest size."""
    slack = np.zeros_like(most)
    for _ in range(3):
        parts = most + 1 + slack
        mean = parts * np.exp(-low / parts)
        slack = np.ceil(mean + 3 * np.sqrt(mean)).astype(most.dtype)
    return np.where(most > 0, np.minimum(slack, most + 1), 0)


def allocation(low: np.ndarray, percent: int, doubles: np.ndarray) -> Scheme:
    most = most_different(low, percent)
    slack = np.where(doubles > 0, 0, empty_slack(low, most))
    return Scheme(low, most, slack, most + 1 + slack - 2 * doubles, doubles)


@dataclass
class Sets:
    """The sets of a block: elements sorted by row, and `first[i]:first[i + 1]` as those of row i."""

    element: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def sets_of(block: Block, gram: int) -> Sets:
    data = LOWER[block.data]
    found = words(block, data=data)
    hashes = word_hashes(data, found)
    at = np.flatnonzero(found.left() >= gram)
    row, value = found.row[at], windows(hashes, gram)[at]
    for few in range(1, gram):
        short = np.flatnonzero(found.counts() == few)
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for k in range(few):
                whole = mix(whole ^ hashes[found.first[short] + k])
            row, value = np.concatenate((row, short)), np.concatenate((value, mix(whole + np.uint64(few))))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return Sets(value, row, np.searchsorted(row, np.arange(len(block) + 1)))


def fingerprints(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.zeros(len(sets.first) - 1, np.uint64)
        np.add.at(total, sets.row, mix(sets.element + np.uint64(salt)))
        out.append(mix(total))
    return out[0], out[1]


def sketch_bits(size: np.ndarray, percent: int) -> np.ndarray:
    """Bits in the sketch of a set: a power of two that grows with what its partners may differ in."""
    need = PER_DIFFERENCE * 2 * np.asarray(size, np.int64) * (100 - percent) // (100 + percent)
    return np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(need, 1))).astype(np.int64))


def sketches(sets: Sets, percent: int) -> list[bytes]:
    """Per set: the parity of its elements in each part of the universe, a bit a part.

    Two sets differ in as many elements as their sketches in bits, at least. A sketch of half as many parts is the
    exclusive or of the two halves (`folded`).
    """
    bits = sketch_bits(sets.sizes(), percent)
    first = np.concatenate(([0], np.cumsum(bits)))
    part = (mix(sets.element ^ np.uint64(0x2545F4914F6CDD1D)) & (bits[sets.row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(first[sets.row] + part, minlength=first[-1]).astype(np.uint8) & 1
    packed = np.packbits(odd).tobytes()
    return [packed[a:b] for a, b in zip((first[:-1] // 8).tolist(), (first[1:] // 8).tolist())]


def folded(sketch: list[bytes], bits: int) -> np.ndarray:
    """Sketches of at least `bits` bits, all brought to that many; a row of 64-bit words each."""
    out = np.zeros((len(sketch), bits // 64), np.uint64)
    for i, one in enumerate(sketch):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(one, np.uint64).reshape(-1, bits // 64), axis=0)
    return out


def able(size: np.ndarray, sketch: list[bytes], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether size and sketch let the sets i and j be partners, pair by pair; partners always may."""
    fits = 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
    bits = np.array([8 * len(s) for s in sketch], np.int64)
    level = np.minimum(bits[i], bits[j])
    most = (size[i] + size[j]) * (100 - percent) // (100 + percent)
    for b in np.unique(level[fits]).tolist():
        at = np.flatnonzero(fits & (level == b))
        used, where = np.unique(np.concatenate((i[at], j[at])), return_inverse=True)
        words = folded([sketch[u] for u in used], b)
        for k in range(0, len(at), PORTION):
            one, two = where[k : k + PORTION][: len(at) - k], where[len(at) + k : len(at) + k + PORTION]
            apart = np.bitwise_count(words[one] ^ words[two]).sum(1, dtype=np.int64)
            fits[at[k : k + PORTION]] = apart <= most[at[k : k + PORTION]]
    return fits


def keys_of(sets: Sets, scheme: Scheme, ahead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, keys and whether each is a whole subset, under the scheme of the row's band (+ ahead)."""
    size = sets.sizes()
    band = np.searchsorted(scheme.low, size, "right") - 1 + ahead
    parts = scheme.single[band] + scheme.double[band]
    parts[(size == 0) | (scheme.most[band] == 0)] = 0  # only equal sets are partners: classes already
    base = np.concatenate(([0], np.cumsum(parts)))
    row = np.repeat(np.arange(len(size)), parts)
    segment = np.arange(base[-1]) - base[row]
    name = mix(band[row].astype(np.uint64) << np.uint64(32) | segment.astype(np.uint64))
    live = parts[sets.row] > 0
    owner, element = sets.row[live], sets.element[live]
    at = base[owner] + (mix(element ^ np.uint64(0x9FB21C651E98DF25)) % parts[owner].astype(np.uint64)).astype(np.int64)
    value = mix(element)
    total = np.zeros(base[-1], np.uint64)
    np.add.at(total, at, value)
    whole = mix(mix(total) ^ name)
    empty = (np.bincount(at, minlength=base[-1]) == 0) & (segment >= scheme.double[band[row]])
    few = np.bincount(row[empty], minlength=len(size)) <= scheme.slack[band]
    sent = ~(empty & few[row])
    near = segment[at] < scheme.double[band[owner]]
    less = mix(mix(total[at[near]] - value[near]) ^ name[at[near]])
    return (
        np.concatenate((row[sent], owner[near])),
        np.concatenate((whole[sent], less)),
        np.concatenate((np.ones(sent.sum(), bool), np.zeros(len(less), bool))),
    )


def priced(docs: DataFrame, gram: int, percent: int, key: str, text: str) -> Scheme:
    """The allocation of every band that costs least on a sample of about SAMPLE documents."""
    low = band_lows(percent)
    most = most_different(low, percent)
    all_double = (most + 1) // 2
    choices = [np.where(low < SMALL, all_double, 0), all_double]
    total = docs.agg(F.count("*")).first()[0]
    draw = F.pmod(F.xxhash64(key, F.lit("price")), F.lit(1 << 30)) / float(1 << 30)
    sample = docs.where(F.col(key).isNotNull() & (draw < SAMPLE / max(total, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            sets = sets_of(block, gram)
            band = np.searchsorted(low, sets.sizes(), "right") - 1
            for c, doubles in enumerate(choices):
                row, keys, _ = keys_of(sets, allocation(low, percent, doubles), 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), c)), pa.array(band[row]), pa.array(keys.view(np.int64))], names=["choice", "band", "k"]
                )

    met = sample.mapInArrow(run, "choice long, band long, k long").groupBy("choice", "band", "k").agg(F.count("*").alias("n"))
    # in the whole table keys grow with the documents, meetings with their square
    cost = F.sum(F.col("n") + PAIR_PRICE * max(total / SAMPLE, 1.0) * F.col("n") * (F.col("n") - 1) / 2)
    doubles = choices[0].copy()
    best: dict[int, float] = {}
    # a row per choice and band
    for r in met.groupBy("choice", "band").agg(cost.alias("cost")).orderBy("choice").collect():
        if r.cost < best.get(r.band, np.inf):
            best[r.band] = r.cost
            doubles[r.band] = choices[r.choice][r.band]
    return allocation(low, percent, doubles)


def is_partner(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common) > 0


def join(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles (size of its set) and component_id (smallest id linked to it)."""
    docs = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    n = buckets(docs.sparkSession)
    scheme = priced(docs, gram, percent, "doc_id", "text")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meta: list[tuple] = []

        def parts():
            for block in blocks(batches, "text"):
                sets = sets_of(block, gram)
                null = np.asarray(pc.is_null(block.column("doc_id")))
                ids = pc.fill_null(block.column("doc_id"), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                a, b = fingerprints(sets)
                meta.append((ids, null, sets.sizes(), a, b))
                for ahead in (0, 1):
                    row, keys, whole = keys_of(sets, scheme, ahead)
                    has_id = ~null[row]
                    row, keys, whole = row[has_id], keys[has_id], whole[has_id]
                    short = (keys >> np.uint64(33)).astype(np.uint32) << np.uint32(1) | whole
                    yield (keys % np.uint64(n)).astype(np.int32), {"short": short, "doc": ids[row]}

        yield from batched(scatter(parts(), KEYS))
        if meta:
            ids, null, size, a, b = (np.concatenate(x) for x in zip(*meta))
            columns = {"doc": ids, "n": size.astype(np.int64), "a": a, "b": b}
            yield from batched(scatter(iter([(null.astype(np.int32), columns)]), META))

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches, {KEYS: KEY_LIKE})[KEYS]
        if not len(got["doc"]):
            return
        # a task has one bucket, so 31 bits of the hash are the whole key
        order = np.argsort(got["short"] >> np.uint32(1), kind="stable")
        short, doc = got["short"][order], got["doc"][order]
        del got, order
        keys, whole = short >> np.uint32(1), (short & np.uint32(1)).astype(bool)
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        hub = np.minimum.reduceat(np.where(whole, doc, np.iinfo(np.int64).max), np.flatnonzero(new))[np.cumsum(new) - 1]
        edge = (hub != doc) & (hub != np.iinfo(np.int64).max)
        if edge.any():
            pairs = np.unique(np.stack((hub[edge], doc[edge]), 1), axis=0)
            yield from batched(scatter(iter([(place(pairs[:, 1].copy(), n), {"hub": pairs[:, 0], "doc": pairs[:, 1]})])))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches, {0: {"hub": np.int64, "doc": np.int64}})[0]
        pairs = np.unique(np.stack((got["hub"], got["doc"]), 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["hub", "doc"])

    def about(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches, {META: META_LIKE})[META]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(got["doc"], pa.int64(), mask=got["bucket"] == 1),
                pa.array(got["n"]),
                pa.array(got["a"].view(np.int64)),
                pa.array(got["b"].view(np.int64)),
            ],
            names=["doc_id", "n_shingles", "fp_a", "fp_b"],
        )

    indexed = settle(docs.mapInArrow(index, SCHEMA))
    rows = settle(indexed.where(F.col("kind") == META).mapInArrow(about, "doc_id long, n_shingles long, fp_a long, fp_b long"))
    with_set = rows.where("doc_id is not null and n_shingles > 0")
    fp = ["n_shingles", "fp_a", "fp_b"]
    least = with_set.groupBy(*fp).agg(F.min("doc_id").alias("rep"))
    # an id and the class it is in; rows with equal ids and different sets are in several
    classes = settle(with_set.join(least, fp).select("doc_id", "rep").distinct())

    met = shuffled(shuffled(indexed.where(F.col("kind") == KEYS), stars, SCHEMA), once, "hub long, doc long")
    side = lambda name, to: classes.select(F.col("doc_id").alias(name), F.col("rep").alias(to))
    pairs = met.join(side("hub", "x"), "hub").join(side("doc", "y"), "doc")
    ends = pairs.where("x <> y").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    # which of the two was the hub of a star; with deletions it need not be the smaller one
    pairs = settle(ends.agg(F.max(F.col("x") < F.col("y")).alias("from_a"), F.max(F.col("x") > F.col("y")).alias("from_b")))

    texts = settle(_texts(docs, pairs, gram, percent))
    tested = settle(_verified(pairs, texts, gram, percent))
    same_id = classes.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = components(tested.where("linked").select("a", "b").unionByName(same_id))
    more = _residual(pairs, tested, found, texts, percent)
    if more is not None:
        links = settle(_verified(more, texts, gram, percent).where("linked").select("a", "b"))
        if not links.isEmpty():
            found = components(links.unionByName(found.select(F.col("component").alias("a"), F.col("node").alias("b"))))
    found = found.withColumnRenamed("node", "doc_id")
    return rows.join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids: WORDS words of 64 bits, two bits per id, whatever their number.

    It only saves work: what it lets through is joined with the ids afterwards.
    """
    bits = F.transform(F.array(F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit(1))), lambda h: F.pmod(h, F.lit(64 * WORDS)))
    place = ids.select(F.explode(bits).alias("bit")).select(F.floor(F.col("bit") / 64).cast("long").alias("word"), F.pmod("bit", F.lit(64)).cast("int").alias("shift"))
    masks = place.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, shift)")).alias("mask"))
    found = masks.toArrow()  # at most WORDS rows, in one job
    words = np.zeros(WORDS, np.int64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy()
    return words


def _texts(docs: DataFrame, pairs: DataFrame, gram: int, percent: int) -> DataFrame:
    """Compressed text, size and sketch of every document on a pair.

    One pass over the texts in Python, which leaves out what the filter knows is on no pair, so that only about those that
    are on one are compressed and shuffled.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = settle(wanted)
    words = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted).tobytes())
    probe = [F.pmod(F.xxhash64("doc_id", *salt), F.lit(64 * WORDS)).alias(f"bit_{i}") for i, salt in enumerate(([], [F.lit(1)]))]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(words.value, np.int64)
        squeeze = zstandard.ZstdCompressor(level=3)

        def on_pairs() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bits = [batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3)]
                on = np.ones(batch.num_rows, bool)
                for b in bits:
                    on &= (held[b >> 6] >> (b & 63)) & 1 == 1
                if on.any():
                    yield batch.filter(pa.array(on))

        for block in blocks(on_pairs(), "text"):
            sets = sets_of(block, gram)
            packed = [squeeze.compress(block.text(i).encode()) for i in range(len(block))]
            sketch = pa.array(sketches(sets, percent), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(packed, pa.binary()), pa.array(sets.sizes()), sketch],
                names=["doc_id", "packed", "size", "sketch"],
            )

    with_id = docs.where("doc_id is not null").select("doc_id", "text", *probe)
    found = with_id.mapInArrow(measured, "doc_id long, packed binary, size long, sketch binary")
    return found.join(wanted, "doc_id", "left_semi")


def _portions(batch: pa.RecordBatch, packed: list[int]) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about CHUNK_BYTES of text in the given columns."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for c in packed:
        sizes += [zstandard.frame_content_size(p) if p else 0 for p in batch.column(c).to_pylist()]
    portion = np.cumsum(sizes) // CHUNK_BYTES
    edge = np.flatnonzero(np.concatenate(([True], portion[1:] != portion[:-1], [True]))) if len(portion) else []
    for a, b in zip(edge[:-1], edge[1:]):
        yield batch.slice(a, b - a)


def _sets_of_packed(packed: list[bytes], gram: int) -> Sets:
    raw = [zstandard.ZstdDecompressor().decompress(p) if p else b"" for p in packed]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    return sets_of(Block(None, np.frombuffer(b"".join(raw), np.uint8), offsets), gram)


def _verified(pairs: DataFrame, texts: DataFrame, gram: int, percent: int) -> DataFrame:
    """The pairs with `linked`, by the exact sets of both texts."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, [2, 3]):
                a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                sets = _sets_of_packed(part.column(2).to_pylist() + part.column(3).to_pylist(), gram)
                one = lambda i: sets.element[sets.first[i] : sets.first[i + 1]]  # noqa: E731, B023
                linked = [is_partner(one(i), one(len(a) + i), percent) for i in range(len(a))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
                )

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = np.concatenate([batch.column(c).to_numpy() for c in (2, 4)])
            sketch = batch.column(3).to_pylist() + batch.column(5).to_pylist()
            one = np.arange(batch.num_rows)
            may = able(size, sketch, one, one + batch.num_rows, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(may)], names=["a", "b", "able"])

    # sizes and sketches settle most pairs, for a part of what their texts would shuffle
    about = [texts.select(F.col("doc_id").alias(c), F.col("size").alias(f"s{c}"), F.col("sketch").alias(f"k{c}")) for c in ("a", "b")]
    seen = pairs.select("a", "b").join(about[0], "a").join(about[1], "b").select("a", "b", "sa", "ka", "sb", "kb")
    seen = settle(seen.mapInArrow(alike, "a long, b long, able boolean"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("pa"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("pb"))
    both = seen.where("able").select("a", "b").join(left, "a").join(right, "b").select("a", "b", "pa", "pb")
    exact = both.mapInArrow(check, "a long, b long, linked boolean")
    return exact.groupBy("a", "b").agg(F.max("linked").alias("linked")).unionByName(
        seen.where("not able").select("a", "b", F.lit(False).alias("linked"))
    )


def _residual(pairs: DataFrame, tested: DataFrame, found: DataFrame, texts: DataFrame, percent: int) -> DataFrame | None:
    """Pairs not tested yet that may link two components: both met the same hub, one in vain.

    Only stars whose members are in several components are looked at, and only by sizes and sketches.
    """
    star = lambda hub, doc: pairs.where(f"from_{hub}").select(F.col(hub).alias("hub"), F.col(doc).alias("doc_id"))
    label = found.select(F.col("node").alias("doc_id"), "component")
    near = star("a", "b").unionByName(star("b", "a")).join(label, "doc_id", "left")
    near = settle(near.select("hub", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    spread = near.groupBy("hub").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("members"))
    near = near.join(spread.where("c0 < c1").select("hub", "members"), "hub")
    # members of a hub in blocks of about BLOCK; every two blocks of a hub meet in one place
    count = F.ceil(F.col("members") / BLOCK)
    own = F.pmod(F.xxhash64("doc_id"), count)
    about = texts.select("doc_id", "size", "sketch")
    placed = near.join(about, "doc_id").select("hub", "doc_id", "component", "size", "sketch", own.alias("own"), count.alias("count"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    placed = placed.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def compare(table: pa.Table) -> pa.Table:
        doc, size, part = (table.column(c).to_numpy() for c in ("doc_id", "size", "component"))
        own, low, high = (table.column(c).to_numpy() for c in ("own", "low", "high"))
        sketch = table.column("sketch").to_pylist()
        one, two = np.flatnonzero(own == low[0]), np.flatnonzero(own == high[0])
        left, right = [doc[:0]], [doc[:0]]
        step = max(1, PAIRS // max(len(two), 1))
        for k in range(0, len(one), step):
            some = one[k : k + step, None]
            x, y = np.nonzero((part[some] != part[two]) & (100 * np.minimum(size[some], size[two]) >= percent * np.maximum(size[some], size[two])))
            x, y = some[x, 0], two[y]
            if low[0] == high[0]:  # every pair is there both ways round
                x, y = x[doc[x] < doc[y]], y[doc[x] < doc[y]]
            may = able(size, sketch, x, y, percent)
            left.append(doc[x[may]])
            right.append(doc[y[may]])
        i, j = np.concatenate(left), np.concatenate(right)
        ends = np.unique(np.stack((np.minimum(i, j), np.maximum(i, j)), 1), axis=0)
        return pa.table({"a": pa.array(ends[:, 0], pa.int64()), "b": pa.array(ends[:, 1], pa.int64())})

    more = placed.groupBy("hub", "low", "high").applyInArrow(compare, "a long, b long").distinct()
    more = settle(more.join(tested.select("a", "b"), ["a", "b"], "left_anti"))
    return None if more.isEmpty() else more
