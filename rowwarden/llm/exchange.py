"""Shuffles of many small fixed-width records as packed arrays, so that a record costs bytes, not a row.

Map tasks sort their records into buckets and emit one row per bucket and flush, holding the columns
of the records difference-coded and compressed. Spark shuffles those rows by bucket. A reduce task
gets all records of its buckets as arrays. Bucket counts follow `spark.sql.shuffle.partitions`, so a
task's share is bounded by the deployment's sizing and not by any key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowwarden.llm.textblocks import CHUNK_BYTES, Block, mix, release
from rowwarden.session import cut_lineage

SCHEMA = "bucket int, kind int, n int, load binary"
FLUSH_BYTES = 16 << 20  # of records or texts a map task holds before it emits
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LAST = np.iinfo(np.int64).max  # stands for a null id

Columns = dict[str, np.ndarray]


PER_PARTITION = 2  # reduce tasks per shuffle partition: Python holds a task's records beside the JVM


def buckets(spark: SparkSession) -> int:
    return PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def settle(df: DataFrame) -> DataFrame:
    """`cut_lineage`, and the shuffle files behind it go once it is written; nothing reads them again."""
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return cut_lineage(df.select("*"))  # a new plan, which takes the setting
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


_LABELS: dict[int, list[int]] = {}


def labels(spark: SparkSession, n: int) -> list[int]:
    """A number for each of n buckets that Spark's hash partitioner sends to a partition of its own."""
    if n in _LABELS:  # the hash is the same in every session
        return _LABELS[n]
    ids = spark.range(n * (int(np.log(n + 1)) + 8)).select(F.col("id").cast("int").alias("label"))
    firsts = ids.groupBy(F.pmod(F.hash("label"), F.lit(n)).alias("at")).agg(F.min("label").alias("label"))
    found = {r.at: r.label for r in firsts.collect()}  # one row per partition
    spare = iter(range(10**9, 10**9 + n))
    _LABELS[n] = [found[k] if k in found else next(spare) for k in range(n)]
    return _LABELS[n]


def pack(columns: Columns) -> bytes:
    """Columns of equal length as one compressed value; 64-bit integers are difference-coded."""
    parts = []
    for values in columns.values():
        if values.dtype == np.int64:  # ids come in order: small steps
            values = np.diff(values, prepend=0)
        raw = np.ascontiguousarray(values)
        parts.append(raw.view(np.uint8).reshape(len(raw), -1).T.tobytes())  # equal high bytes side by side
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(load: bytes, n: int, like: dict[str, np.dtype]) -> Columns:
    raw, out, at = zstandard.ZstdDecompressor().decompress(load), {}, 0
    for name, kind in like.items():
        kind = np.dtype(kind)
        size = n * kind.itemsize
        values = np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T
        values = np.ascontiguousarray(values).view(kind).reshape(n)
        out[name] = np.cumsum(values) if kind == np.int64 else values
        at += size
    return out


def rows(records: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    bucket, kind, n, load = zip(*records) if records else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(n, pa.int32()), pa.array(load, pa.binary())],
        names=["bucket", "kind", "n", "load"],
    )


def batched(records: Iterator[tuple[int, int, int, bytes]], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r[3])
        if size >= limit:
            yield rows(held)
            held, size = [], 0
    if held:
        yield rows(held)
    del held
    release()


def scatter(parts: Iterator[tuple[np.ndarray, Columns]], kind: int = 0) -> Iterator[tuple[int, int, int, bytes]]:
    """Packed rows of the given (bucket of each record, columns) parts, flushed at FLUSH_BYTES."""
    held: list[tuple[np.ndarray, Columns]] = []
    size = 0

    def flush():
        where = np.concatenate([b for b, _ in held])
        order = np.argsort(where, kind="stable")
        columns = {c: np.concatenate([p[c] for _, p in held])[order] for c in held[0][1]}
        where = where[order]
        edge = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1], [True])))
        for a, b in zip(edge[:-1], edge[1:]):
            yield int(where[a]), kind, int(b - a), pack({c: v[a:b] for c, v in columns.items()})

    for where, columns in parts:
        if len(where):
            held.append((where, columns))
            size += where.nbytes + sum(v.nbytes for v in columns.values())
        if size >= FLUSH_BYTES:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def gather(batches: Iterator[pa.RecordBatch], like: dict[int, dict[str, np.dtype]]) -> dict[int, Columns]:
    """All records of a task by kind, with the bucket of each as the column `bucket`."""
    found: dict[int, list[Columns]] = {k: [] for k in like}
    for batch in batches:
        for bucket, kind, n, load in zip(*(batch.column(c).to_pylist() for c in range(4))):
            columns = unpack(load, n, like[kind])
            columns["bucket"] = np.full(n, bucket, np.int32)
            found[kind].append(columns)
    out = {}
    for kind, parts in found.items():
        kinds = {**like[kind], "bucket": np.int32}
        # column by column, each part going as soon as it is copied
        out[kind] = {c: np.concatenate([p.pop(c) for p in parts]) if parts else np.zeros(0, t) for c, t in kinds.items()}
    return out


def shuffled(df: DataFrame, reduce: Callable, schema: str) -> DataFrame:
    """`reduce` over everything that falls to a task: one bucket, complete."""
    spark = df.sparkSession
    n = buckets(spark)
    label = F.element_at(F.array(*map(F.lit, labels(spark, n))), F.col("bucket") + 1)
    return df.repartition(n, label).mapInArrow(reduce, schema)


def pack_texts(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> bytes:
    """Ids and texts (bytes end to end) as one compressed value."""
    head = np.diff(ids, prepend=0).tobytes() + np.diff(offsets).astype(np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + data.tobytes())


def unpack_texts(load: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(load)
    ids = np.cumsum(np.frombuffer(raw, np.int64, n))
    offsets = np.concatenate(([0], np.cumsum(np.frombuffer(raw, np.int64, n, 8 * n))))
    return ids, np.frombuffer(raw, np.uint8, len(raw) - 16 * n, 16 * n), offsets


def scatter_texts(blocks, ids_of: Callable, bucket_of: Callable, kind: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Packed texts of blocks by the bucket of their ids, flushed at FLUSH_BYTES of text."""
    held: dict[int, list[tuple[int, bytes]]] = {}
    size = 0

    def flush():
        for bucket, texts in sorted(held.items()):
            ids = np.array([i for i, _ in texts], np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(t) for _, t in texts])))
            yield bucket, kind, len(texts), pack_texts(ids, np.frombuffer(b"".join(t for _, t in texts), np.uint8), offsets)

    for block in blocks:
        ids = ids_of(block)
        for i, (doc, bucket) in enumerate(zip(ids.tolist(), bucket_of(ids).tolist())):
            text = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes()
            held.setdefault(bucket, []).append((doc, text))
            size += len(text)
        if size >= FLUSH_BYTES:
            yield from flush()
            held.clear()
            size = 0
    if held:
        yield from flush()


def texts_in(loads: Iterator[tuple[int, bytes]], limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, Block]]:
    """Ids and texts of packed loads, put together to blocks of about `limit` bytes."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def block():
        ids = np.concatenate([i for i, _, _ in held])
        offsets = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(o) for _, _, o in held]))))
        return ids, Block(None, np.concatenate([d for _, d, _ in held]), offsets)

    for n, load in loads:
        held.append(unpack_texts(load, n))
        size += len(held[-1][1])
        if size >= limit:
            yield block()
            held, size = [], 0
    if held:
        yield block()


def split(batches: Iterator[pa.RecordBatch], records: int, texts: int, like: dict[str, np.dtype]) -> tuple[Columns, list[tuple[int, bytes]]]:
    """The records of a reduce task, and its packed texts as they came."""
    loads: list[tuple[int, bytes]] = []

    def only_records():
        for batch in batches:
            kind = batch.column(1).to_numpy()
            for i in np.flatnonzero(kind == texts).tolist():
                loads.append((batch.column(2)[i].as_py(), batch.column(3)[i].as_py()))
            yield batch.filter(pa.array(kind == records))

    return gather(only_records(), {records: like})[records], loads


def ids_of(block: Block, key: str) -> np.ndarray:
    """Ids as integers, null as LAST."""
    return pc.fill_null(block.column(key), int(LAST)).to_numpy(zero_copy_only=False).astype(np.int64)


def place(ids: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a document."""
    return (mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int32)
