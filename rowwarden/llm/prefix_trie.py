"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path: per turn 16 bytes of a hash over role and text, and its number of words. Paths are
range-partitioned and sorted by (path, id), so every subtree is a stretch of consecutive rows. A node whose
stretch lies inside one partition is finished there, with a stack, from the rows alone. The others are
prefixes of the paths at which partitions meet, the splitters. The trie of those prefixes, the skeleton, is
broadcast: a task that closes one of its nodes emits a partial aggregate instead, and Spark reduces the partials by
node. What the finished subtrees below add is in the partials; a last step adds the skeleton's own
nodes from the leaves up. However many conversations share a first turn, that turn costs one partial a task.

The skeleton is bounded: the partitions are as many as keep (partitions x longest path) under SKELETON turns,
and a splitter adds at most one path. The ids that end at a skeleton node come as packed runs in order, a few a task, and are
hashed as a stream. Texts meet nowhere: turns are sorted over a range partitioning by (id, turn,
role, text), which a long conversation shares out over tasks, and leave it as 20 bytes each.

Turns with equal number are ordered by role and text, a null number comes first, null role or text is empty.
Repeated rows are turns of their own. Rows without a conversation id belong to none and are left out. Empty
table: no nodes. Extra columns are not looked at. Equality is that of the 128-bit hashes.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.exchange import settle
from rowwarden.llm.textblocks import WHITE, release

SKELETON = 1 << 18  # turns of all splitter paths together
TURN = 16  # bytes of a turn's hash
RUN = 1 << 13  # ids in one packed run

PATHS = "conv_id long, part int, path binary, words binary"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, node binary, parent binary, words long, shard int, seq int, ids binary"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_KINDS = {
    "string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(),
}
_FIELDS = [(n, _KINDS[t]) for n, t in (f.split() for f in NODES.split(", "))]
ROOT = b""


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], names=[n for n, _ in _FIELDS])


def turn_hash(role: str, text: str) -> bytes:
    raw = role.encode()
    return hashlib.sha256(struct.pack("<Q", len(raw)) + raw + text.encode()).digest()[:TURN]


def count_words(text: str) -> int:
    raw = np.frombuffer(text.encode(), np.uint8)
    inside = ~WHITE[raw]
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())


def paths(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path, words) of every conversation."""
    text_of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = turns.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), text_of(role).alias("role"), text_of(text).alias("text")
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, path, words = None, bytearray(), bytearray()
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            c, p, w = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()), pa.array([part] * len(out), pa.int32()), pa.array(p, pa.binary()), pa.array(w, pa.binary())],
                names=["conv_id", "part", "path", "words"],
            )

        for batch in batches:
            for conv, its_role, its_text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if conv != now:
                    if now is not None:
                        out.append((now, bytes(path), bytes(words)))
                    now, path, words = conv, bytearray(), bytearray()
                path += turn_hash(its_role, its_text)
                words += struct.pack("<I", count_words(its_text))
            if out:
                yield made()
                out.clear()
        if now is not None:
            out.append((now, bytes(path), bytes(words)))
            yield made()
        release()

    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PATHS)
    # a conversation over several tasks has a row from each, in the order of the tasks
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "path", "words"))).alias("pieces"))
    joined = lambda c: F.aggregate("pieces", F.lit(bytearray()), lambda a, p: F.concat(a, p[c]))
    return settle(whole.select("conv_id", joined("path").alias("path"), joined("words").alias("words")))


def graft(whole: DataFrame, donor: Column, turns: Column, most: int) -> DataFrame:
    """Paths rebuilt: the first `turns` turns of conversation `donor`, then the own ones after the first `turns`.

    `turns` is at most `most`, so a donor gives a few bytes. Both are expressions over conv_id.
    """
    first = whole.select(
        F.col("conv_id").alias("donor"), F.substring("path", 1, TURN * most).alias("donor_path"), F.substring("words", 1, 4 * most).alias("donor_words")
    )
    taken = whole.withColumn("donor", donor).withColumn("h", turns.cast("int"))
    both = taken.join(first, "donor", "left")
    none = F.lit(bytearray())

    def rebuilt(own: str, given: str, width: int) -> Column:
        head = F.coalesce(F.substring(F.col(given), F.lit(1), F.col("h") * width), none)
        return F.concat(head, F.substring(F.col(own), F.col("h") * width + 1, F.octet_length(F.col(own)))).alias(own)

    return settle(both.select("conv_id", rebuilt("path", "donor_path", TURN), rebuilt("words", "donor_words", 4)))


def _common(a: bytes, b: bytes) -> int:
    """Turns that both paths begin with."""
    return len(os.path.commonprefix([a, b])) // TURN


def _node_ids(path: bytes, depth: int) -> list[bytes]:
    """Identifiers of the nodes on a path, from the root to `depth`."""
    out = [ROOT]
    for d in range(depth):
        out.append(hashlib.sha256(out[-1] + path[d * TURN : d * TURN + TURN]).digest()[:TURN])
    return out


class _Node:
    __slots__ = ("depth", "words", "conv", "n", "children", "leaves", "saved", "ends", "ids", "seq", "name")

    def __init__(self, depth: int, words: int, name: bytes | None):
        self.depth, self.words, self.name = depth, words, name
        self.conv, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.ids, self.seq = None, [], 0


def _run(node: _Node, parent: bytes | None, shard: int) -> tuple:
    """A packed run of ids that end at a skeleton node."""
    load = zstandard.ZstdCompressor(level=1).compress(np.diff(np.array(node.ids, np.int64), prepend=0).tobytes())
    node.seq += 1
    return (None,) * 8 + (node.name, parent, None, shard, node.seq, load)


def walk(rows: Iterator[tuple[int, bytes, bytes]], skeleton: frozenset[bytes], shard: int) -> Iterator[tuple]:
    """Nodes of sorted (conv_id, path, words): finished ones, partials of the skeleton's, runs of ids of those."""
    stack: list[_Node] = []
    last: bytes | None = None

    def push(depth: int, words: int, path: bytes) -> None:
        above = stack[-1] if stack else None
        name = None
        if above is None:
            name = ROOT if ROOT in skeleton else None
        elif above.name is not None:  # below a finished node nothing is in the skeleton
            own = hashlib.sha256(above.name + path[(depth - 1) * TURN : depth * TURN]).digest()[:TURN]
            name = own if own in skeleton else None
        stack.append(_Node(depth, words, name))

    def pop() -> Iterator[tuple]:
        node = stack.pop()
        above = stack[-1] if stack else None
        if above is not None:
            above.n += node.n
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
        if node.name is not None:
            up = above.name if above is not None else None
            if node.ids:
                yield _run(node, up, shard)
            yield (node.conv, node.depth, None, node.n, node.children, node.leaves, node.saved, None, node.name, up, node.words, shard, 0, None)
            return
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.words
        ends = (node.ends or hashlib.sha256()).hexdigest()
        held.append((node, ends))
        if above is not None:
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
        if above is None or above.name is not None:
            # a finished subtree is complete: each node's parent lies behind it
            up = above.name if above is not None else None
            parents: dict[int, int] = {}
            for n, e in reversed(held):
                parents[n.depth] = n.conv
                top = n is node
                yield (n.conv, n.depth, None if top else parents[n.depth - 1], n.n, n.children, n.leaves, n.saved, e, None, up if top else None, None, None, None, None)
            held.clear()

    held: list[tuple[_Node, str]] = []
    for conv, path, words in rows:
        keep = 0 if last is None else (len(path) // TURN if path == last else _common(last, path))
        while len(stack) > keep + 1:
            yield from pop()
        if not stack:
            push(0, 0, path)
        for d in range(len(stack), len(path) // TURN + 1):
            push(d, struct.unpack_from("<I", words, 4 * d - 4)[0], path)
        end = stack[-1]
        end.n += 1
        end.conv = conv if end.conv is None else min(end.conv, conv)
        if end.name is not None:
            end.ids.append(conv)
            if len(end.ids) == RUN:
                yield _run(end, stack[-2].name if len(stack) > 1 else None, shard)
                end.ids = []
        elif end.ends is None:
            end.ends = hashlib.sha256(str(conv).encode())
        else:
            end.ends.update(f",{conv}".encode())
        last = path
    while stack:
        yield from pop()


def _skeleton(shards: DataFrame) -> frozenset[bytes]:
    """Nodes that lie in more than one partition: what neighbouring partitions' outer paths share."""

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, last = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if batch.num_rows:
                first = batch.column(0)[0].as_py() if first is None else first
                last = batch.column(0)[batch.num_rows - 1].as_py()
        n = 0 if first is None else 1
        columns = [pa.array([shard] * n, pa.int32()), pa.array([first] * n, pa.binary()), pa.array([last] * n, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["shard", "first", "last"])

    # two paths a partition, SKELETON turns each way together
    found = sorted(shards.select("path").mapInArrow(outer, "shard int, first binary, last binary").collect())
    names: set[bytes] = set()
    for left, right in zip(found[:-1], found[1:]):
        path = bytes(right["first"])
        names.update(_node_ids(path, _common(bytes(left["last"]), path)))
    return frozenset(names)


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each skeleton node's ids, from its runs in order."""
    out, now, digest = [], None, None
    for batch in batches:
        for node, load in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            ids = np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(load), np.int64)).tolist()
            text = ",".join(map(str, ids)).encode()
            if node == now:
                digest.update(b"," + text)
                continue
            if now is not None:
                out.append((now, digest.hexdigest()))
            now, digest = node, hashlib.sha256(text)
    if now is not None:
        out.append((now, digest.hexdigest()))
    names, digests = zip(*out) if out else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])


def _roll_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The skeleton's reduced nodes (at most SKELETON), each with what the skeleton's nodes below it add."""
    nodes = {r["node"]: r for b in batches for r in b.to_pylist()}
    out = []
    for r in sorted(nodes.values(), key=lambda r: -r["depth"]):
        r["n_leaves"] = r["n_leaves"] or 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        up = nodes[r["parent"]] if r["parent"] is not None else None
        if up is not None:
            up["n_children"] += 1
            up["n_leaves"] += r["n_leaves"]
            up["saved_tokens"] += r["saved_tokens"]
        row = (r["conv_id"], r["depth"], up and up["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
        out.append((*row, r["node"], None, None, None, None, None))
    yield _batch(out)


def trie(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per node of the trie of (conv_id, path, words): smallest member, depth, parent's smallest member, counts."""
    spark = conversations.sparkSession
    longest = conversations.agg(F.max(F.octet_length("path"))).first()[0] or 0
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(wanted, SKELETON // (longest // TURN + 1)))
    shards = settle(conversations.select("path", "conv_id", "words").repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id"))
    skeleton = spark.sparkContext.broadcast(_skeleton(shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in (1, 0, 2))))
        out = []
        for node in walk(rows, skeleton.value, TaskContext.get().partitionId()):
            out.append(node)
            if len(out) == 8192:
                yield _batch(out)
                out = []
        yield _batch(out)
        release()

    nodes = settle(shards.mapInArrow(run, NODES))
    runs = nodes.where("ids is not null").select("node", "shard", "seq", "ids")
    ends = runs.repartition("node").sortWithinPartitions("node", "shard", "seq").mapInArrow(_hash_runs, "node binary, ends_sha256 string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partial = nodes.where("node is not null and ids is null").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("words").alias("words"), *sums
    )
    none = F.lit(hashlib.sha256().hexdigest())
    reduced = partial.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    top = settle(reduced.repartition(1).mapInArrow(_roll_up, NODES))
    above = top.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    # at most SKELETON rows of an id and a name, whatever the input
    local = nodes.where("node is null").join(F.broadcast(above), "parent", "left").withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id"))
    return local.select(*RESULT).unionByName(top.select(*RESULT))
