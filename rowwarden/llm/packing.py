"""Harmonic packing of token sequences.

A piece of length r is in class k if it fits k times, but not k + 1 times, into a sequence. A bin
of class k takes exactly k pieces. A piece that would waste more than `waste` of its slot is cut to
the slot width of class k + 1 and the rest is classed again, so padding stays small. Pieces of at
most capacity / `classes` tokens form the last class, filled one after the other and cut where a
sequence is full.

Every worker tokenizes its part and fills its own bins; a piece is only held back until its bin is
full. What is in open bins when a part ends (fewer than k pieces of class k) is brought together for
`PARTS` parts at a time: class bins are filled again, and the open ones left then are put together
first-fit by size. The numbers brought together depend on `PARTS` and the classes, not on the data.

Null text is empty: the document is its end id alone. Repeated documents and null ids: packed one
by one as they come. Empty table: empty result. Ids are those of the byte-level vocabulary, a special
string in a text being its special id, and every text gets `end_id` at its end.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.textblocks import blocks
from rowwarden.session import cut_lineage

CAPACITY = 2048
CLASSES = 64
WASTE = 0.01
END_ID = 1
PARTS = 256
# the byte-level vocabulary's own word pattern, with possessive repeats
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

PIECE = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
]
HELD = [("class", pa.int64()), ("part", pa.int64())]


def _ddl(fields) -> str:
    return ", ".join(f"`{name}` long" for name, _ in fields)


def encoder(path: str):
    """The vocabulary file as an encoder whose ids equal those of the file's own library, and its special strings.

    Made once per task and not kept: it is large, and workers go on to other work.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # printable stand-ins of the 256 bytes in byte-level vocabularies
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stand_in = {chr(b): b for b in plain}
    stand_in |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(stand_in[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), tuple(special)


def token_ids(made: tuple, text: str) -> list[int]:
    encoding, special = made
    if any(s in text for s in special):
        return encoding.encode(text, allowed_special="all", disallowed_special=())
    return encoding.encode_ordinary(text)


def cut(length: int, capacity: int, classes: int, waste: float) -> Iterator[tuple[int, int]]:
    """(class, length) of the pieces a document of `length` tokens is cut into; class 0 is the last one."""
    while length >= capacity:
        yield 1, capacity
        length -= capacity
    while length:
        k = capacity // length
        if k >= classes:
            yield 0, length
            return
        if length >= (1 - waste) * (capacity // k):
            yield k, length
            return
        if k + 1 >= classes:
            yield 0, length
            return
        yield k + 1, capacity // (k + 1)
        length -= capacity // (k + 1)


class Filler:
    """Bins of one worker: a bin of class k is emitted when it has k pieces."""

    def __init__(self, first_id: int, capacity: int):
        self.next_id, self.capacity = first_id, capacity
        self.open: dict[int, list[tuple]] = {}
        self.small: list[tuple] = []
        self.small_used = 0

    def bin(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for p in pieces:
            out.append((*p[:5], self.next_id, offset))
            offset += p[2]
        self.next_id += 1
        return out

    def add(self, k: int, piece: tuple) -> list[tuple]:
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) < k:
            return []
        del self.open[k]
        return self.bin(held)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    waste: float = WASTE,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: document, start and length in its ids, checksum, and the place in a sequence."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bins, made = Filler(part << 36, capacity), None
        for block in blocks(batches, text):
            made = made or encoder(path)
            out: list[tuple] = []
            for i, doc in enumerate(block.column(key).to_pylist()):
                ids = np.array([*token_ids(made, block.text(i)), end_id], "<u4")
                total, start = len(ids), 0
                for k, size in cut(total, capacity, classes, waste):
                    while size:  # the last class is cut where its sequence is full
                        take = min(size, capacity - bins.small_used) if k == 0 else size
                        piece = (doc, start, take, zlib.crc32(ids[start : start + take].tobytes()), total)
                        if k:
                            out += bins.add(k, piece)
                        else:
                            bins.small.append(piece)
                            bins.small_used += take
                            if bins.small_used == capacity:
                                out += bins.bin(bins.small)
                                bins.small, bins.small_used = [], 0
                        start, size = start + take, size - take
            yield _batch([(*p, None, part) for p in out])
        held = [(*p, None, None, k, part) for k, ps in bins.open.items() for p in ps]
        yield _batch(held + [(*p, None, None, 0, part) for p in bins.small])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r[7], r[8], r[0] is None, r[0] or 0, r[1]))
        bins = Filler((1 << 62) + (rows[0][8] // PARTS << 36), capacity)
        out: list[tuple] = []
        for r in rows:
            if r[7]:
                out += bins.add(r[7], r[:5])
        left = [p for ps in bins.open.values() for p in ps] + [r[:5] for r in rows if not r[7]]
        left.sort(key=lambda p: -p[2])
        rooms: list[list] = []  # open sequences, those with the least room first
        for p in left:
            room = next((x for x in rooms if x[0] >= p[2]), None)
            if room is None:
                rooms.append(room := [capacity, []])
            room[0] -= p[2]
            room[1].append(p)
            rooms.sort(key=lambda x: x[0])
            while rooms and rooms[0][0] == 0:
                out += bins.bin(rooms.pop(0)[1])
        for room in rooms:
            out += bins.bin(room[1])
        yield _batch([(*p, None, None) for p in out])

    picked = docs.select(docs[key].cast("long").alias(key), docs[text])
    pieces = cut_lineage(picked.mapInArrow(fill, _ddl(PIECE + HELD)))
    names = [name for name, _ in PIECE]
    done = pieces.where("sequence_id is not null").select(*names)
    open_ = pieces.where("sequence_id is null").withColumn("lane", F.floor(F.col("part") / PARTS))
    closed = open_.groupBy("lane").applyInArrow(lambda t: _closed(t, close), _ddl(PIECE + HELD))
    return done.unionByName(closed.select(*names))


def _closed(table: pa.Table, close) -> pa.Table:
    return pa.Table.from_batches(list(close(iter(table.drop_columns(["lane"]).to_batches()))))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = PIECE + HELD
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])
