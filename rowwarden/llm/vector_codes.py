"""Vector codes: parts of each vector replaced by the index of their nearest codebook entry.

Vectors become integers, floor(scale * x), and are cut into `parts` equal parts, each with a codebook
of its own: at first that part of the smallest ids' vectors. A round assigns every part to its
nearest entry (squared Euclidean distance, ties to the lower index) and puts each entry at the
componentwise floor(sum / count) of its parts. An entry without parts stays.

Active entries: every row carries, from round to round, the entry of each part and the exact
distance to it. An update moves some entries. A part whose entry did not move has a distance that
still holds and already beats every other entry that did not move, so it is compared with the moved
entries only, an equal distance going to the lower index. A part whose entry moved is compared with
all entries.

Each round is one pass over the rows: it writes them with their new state, and beside them one record
per part and entry with the task's sums. Those records are added up by Spark; the driver sees the
codebooks alone, parts x entries x width integers whatever the number of rows. The state is a table
in the shared folder, so a lost executor costs its tasks.

Rows whose vector is null or empty, or holds a null, NaN or infinite component go. So do vectors of
another length than the one with the smallest id, or of a length that `parts` does not divide: they have no
common parts with the rest. A null id is coded, but comes last in the choice of the first entries;
repeated ids are coded row by row and ordered by their vectors there. Fewer rows than entries: a
codebook of that many entries. Null labels are one group. Empty table: empty result. Other columns are
not looked at. A component of magnitude 2**27 / scale or more ends the job with its value: its squares no
longer add up exactly in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rowwarden.llm.staging import Staging
from rowwarden.llm.textblocks import release

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 27
ROWS = 8192  # rows compared at once in a task
FAR = np.iinfo(np.int64).max
STATE = "vec_id long, parts array<int>, codes binary, distances array<long>"
SUMS = "part int, entry int, n long, total array<long>"


def _closer(x: np.ndarray, book: np.ndarray, entries: np.ndarray, code: np.ndarray, dist: np.ndarray) -> None:
    """Lower `dist` and set `code` wherever one of the entries is nearer, or as near with a lower index."""
    for e in entries.tolist():
        step = x - book[e]
        d = np.einsum("ij,ij->i", step, step)
        better = (d < dist) | ((d == dist) & (e < code))
        code[better], dist[better] = e, d[better]


def assign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New entry and distance of each part in x, given the old ones and which entries have moved since."""
    code, dist = code.astype(np.int64), dist.copy()
    stale = moved[code]
    everything, active = np.arange(len(book)), np.flatnonzero(moved)
    for rows, entries in ((np.flatnonzero(~stale), active), (np.flatnonzero(stale), everything)):
        if not len(rows) or not len(entries):
            continue
        if entries is everything:
            own_code, own_dist = np.full(len(rows), len(book)), np.full(len(rows), FAR)
        else:
            own_code, own_dist = code[rows], dist[rows]
        _closer(x[rows], book, entries, own_code, own_dist)
        code[rows], dist[rows] = own_code, own_dist
    return code, dist


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as an Arrow list column."""
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _scaled(column: pa.Array, width: int, scale: int) -> np.ndarray:
    values = np.floor(_matrix(column, width) * float(scale))
    if values.size and np.abs(values).max() >= LARGEST:
        raise ValueError(f"vector component {values.flat[np.abs(values).argmax()] / scale} is too large to code exactly")
    return values.astype(np.int64)


class _Sums:
    """Count and componentwise sum of the parts of each entry."""

    def __init__(self, parts: int, entries: int, width: int):
        self.n = np.zeros((parts, entries), np.int64)
        self.total = np.zeros((parts, entries, width), np.int64)

    def add(self, part: int, x: np.ndarray, code: np.ndarray) -> None:
        self.n[part] += np.bincount(code, minlength=self.n.shape[1])
        np.add.at(self.total[part], code, x)

    def records(self) -> list[dict]:
        return [{"part": p, "entry": e, "n": int(self.n[p, e]), "total": self.total[p, e].tolist()} for p, e in zip(*np.nonzero(self.n))]


def _round(rows: DataFrame, books: np.ndarray, moved: np.ndarray, scale: int | None) -> DataFrame:
    """Rows with their new state, and each task's sums as further rows; with `scale`, the first round."""
    parts, entries, width = books.shape
    kept = rows.schema["label"]
    schema = StructType([StructField("label", kept.dataType, True), *StructType.fromDDL(f"{STATE}, {SUMS}").fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, label_type = _Sums(parts, entries, width), None
        for batch in batches:
            label_type = batch.schema.field("label").type
            for start in range(0, batch.num_rows, ROWS):
                block = batch.slice(start, ROWS)
                n = block.num_rows
                x = _scaled(block.column("vector"), parts * width, scale) if scale else _matrix(block.column("parts"), parts * width).astype(np.int64)
                x = x.reshape(n, parts, width)
                if scale:
                    codes, dists = np.zeros((n, parts), np.int64), np.full((n, parts), FAR)
                else:
                    codes = np.frombuffer(b"".join(block.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                    dists = _matrix(block.column("distances"), parts)
                new_codes, new_dists = np.empty((n, parts), np.uint8), np.empty((n, parts), np.int64)
                for p in range(parts):
                    own = np.ascontiguousarray(x[:, p])
                    code, dist = assign(own, books[p], moved[p], codes[:, p], dists[:, p])
                    sums.add(p, own, code)
                    new_codes[:, p], new_dists[:, p] = code, dist
                nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
                state = [
                    block.column("label"),
                    block.column("vec_id"),
                    _lists(x.reshape(n, -1), pa.int32()),
                    pa.array([bytes(c) for c in new_codes], pa.binary()),
                    _lists(new_dists, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(state + nothing, names=names)
        found = sums.records()
        if found:
            n = len(found)
            empty = [pa.nulls(n, t) for t in (label_type, pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()))]
            kinds = (("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(empty + [pa.array([r[c] for r in found], t) for c, t in kinds], names=names)
        release()

    return rows.mapInArrow(run, schema)


def _update(sums: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks after an update, and which entries moved."""
    width = books.shape[2]
    added = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[k]).alias(f"t{k}") for k in range(width)])
    new = books.copy()
    for r in added.collect():  # one row per part and entry
        new[r.part, r.entry] = [r[f"t{k}"] // r.n for k in range(width)]
    return new, (new != books).any(axis=2)


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes as one byte per part, error of each kept row; the codebooks by part, entry and position)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is a byte: from 1 to 256 entries")
    spark = vectors.sparkSession
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    picked = vectors.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    )
    whole = picked.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0) & F.forall("vector", finite))
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    least = whole.orderBy(*order).select("vector").first()
    if least is None:
        return whole.select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    size = len(least.vector)
    kept = whole.where(F.size("vector") == size)
    first = kept.orderBy(*order).limit(entries).select("vector").collect()  # `entries` rows
    books = _scaled(pa.array([list(r.vector) for r in first]), size, scale).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()

    staging = Staging(spark, "codes")
    moved, rows, before = np.ones(books.shape[:2], bool), kept, None
    for r in range(rounds + 1):
        done = staging.keep(_round(rows, books, moved, None if r else scale), f"round-{r}")
        if before:
            staging.drop(before)
        rows, before = done.where("part is null").select("label", *StructType.fromDDL(STATE).names), f"round-{r}"
        if r < rounds:
            books, moved = _update(done.where("part is not null"), books)
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d)
    return rows.select("vec_id", "label", "codes", error.alias("error")), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Each row with the error summed over the rows of its label, nulls together."""
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    same = per_label.select(F.col("label").alias("its_label"), "label_error")
    return coded.join(same, F.col("label").eqNullSafe(F.col("its_label"))).drop("its_label")


def books_text(books: np.ndarray) -> str:
    """Every component in decimal, by part, entry and position."""
    return ",".join(map(str, books.reshape(-1).tolist()))
