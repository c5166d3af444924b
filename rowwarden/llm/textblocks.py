"""Arrow text columns as flat UTF-8 bytes, words and 64-bit hashes, computed array-wise inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

CHUNK_BYTES = 1 << 20  # text bytes handled at once in a task; a longer single text is a chunk of its own

WHITE = np.zeros(256, bool)  # [\x20\x09-\x0D]
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)  # [\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)  # A-Z to a-z, all other bytes as they are
LOWER[0x41:0x5B] += 32

_SEEDS = np.random.default_rng(20).integers(1, 2**63, size=(4, 256), dtype=np.uint64)
_BASES = np.random.default_rng(21).integers(1, 2**63, size=4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(lane: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers (mod 2**64) of the lane's odd base, or of its inverse; kept per worker."""
    have = _POWERS.get((lane, inverse))
    if have is None or len(have) < n:
        base = int(_BASES[lane])
        step = np.full(max(n, CHUNK_BYTES), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        step[0] = 1
        have = _POWERS[lane, inverse] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix(data: np.ndarray, lane: int = 0) -> np.ndarray:
    """p with p[j] - p[i] = sum of seed(byte t) * base**t for i <= t < j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SEEDS[lane][data] * powers(lane, len(data)), out=out[1:], dtype=np.uint64)
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of the data whose `prefix` is p."""
    raw = (p[end] - p[start]) * powers(lane, len(p), inverse=True)[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass
class Block:
    """Some rows: their bytes end to end, `offsets[i]:offsets[i + 1]` being row i."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def column(self, name: str) -> pa.Array:
        return self.rows.column(self.rows.schema.get_field_index(name))

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode()

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are flagged."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offsets])


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column, "")
    at, data = _offsets(column), column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give freed memory back: Python workers live on from task to task, beside the JVM's heap."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES, lower: bool = False) -> Iterator[Block]:
    """Rows in order, in blocks of at most `limit` text bytes (or one longer row); null text is empty.

    lower: the bytes are those of the text in lower case; the rows keep the text as it is.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        offsets, first = _offsets(texts), 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            part = texts.slice(first, last - first)
            data, own = _flat(pc.utf8_lower(part) if lower else part)
            yield Block(batch.slice(first, last - first), data, own)
            first = last
    release()


@dataclass
class Words:
    """Words of a block: byte spans, the row of each, and `first[i]:first[i + 1]` as the words of row i."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its row, itself included."""
        return self.first[self.row + 1] - np.arange(len(self.row))


def words(block: Block, gap: np.ndarray = WHITE, data: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes that are not in `gap`, never across rows."""
    data = block.data if data is None else data
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~gap[data]
    starts = inside[1:-1] & (inside[:-2] == 0)
    ends = inside[1:-1] & (inside[2:] == 0)
    cut = block.offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    starts[cut] = inside[1:-1][cut]
    ends[cut - 1] = inside[1:-1][cut - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, block.offsets)
    return Words(start, end, np.repeat(np.arange(len(block)), np.diff(first)), first)


def word_hashes(data: np.ndarray, found: Words, lane: int = 0) -> np.ndarray:
    return span_hash(prefix(data, lane), found.start, found.end, lane)


def windows(hashes: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """Hash of every `size` consecutive word hashes (those across rows too; callers mask them)."""
    n = max(len(hashes) - size + 1, 0)
    out, base = np.zeros(n, np.uint64), _BASES[lane]
    for k in range(size):
        out *= base
        out += hashes[k : k + n]
    return mix(out)


def covered(n: int, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Which of n positions lie in some span [start, start + size)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + size, -1)
    return np.cumsum(step[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def beside(docs: DataFrame, text: str, judge: Callable[[Block], dict[str, pa.Array]], added: str, lower: bool = False) -> DataFrame:
    """docs with all its columns, and new ones made of each block's texts; `added` is their schema.

    Columns of docs that clash with a new name are replaced by it.
    """
    new = StructType.fromDDL(added)
    kept = [c for c in docs.columns if c not in new.names]
    schema = StructType([*docs.select(*[f"`{c}`" for c in kept]).schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, lower=lower):
            made = judge(block)
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), *(made[c] for c in new.names)], names=[*kept, *new.names])

    return docs.mapInArrow(run, schema)
