"""Order-dependent recursions per key, without putting a whole key into one task.

A running mean or an EWMA needs the rows of a key in order, and a hot key may hold a
large share of all rows. So the rows are range-partitioned by (key, order): a hot key
simply spans many partitions. Each partition then says in one row how it would change
the state of the key it ends with; those rows - one per partition, however large the
data - are folded to the state every partition starts from, and a second pass over the
same partitions emits the results.

The range-partitioned rows go through the reliable checkpoint, so both passes see the
same cut, also after an executor is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from rowwarden.operators.joins import key_join
from rowwarden.session import cut_lineage

BLOCK, CARRY, INIT, STATE = "_block", "_carry", "_init", "_state"


def recurrence(factor: np.ndarray, added: np.ndarray, start: float) -> np.ndarray:
    """y with y[t] = factor[t] * y[t - 1] + added[t] and y[-1] = start, by doubling strides.

    A factor of 0 starts afresh, so many keys go through one call.
    """
    y, c = added.astype(float), factor.astype(float)
    if not len(y):
        return y
    y[0] += c[0] * start
    c[0] = 0.0
    stride = 1
    while stride < len(y) and c.any():
        y[stride:] += c[stride:] * y[:-stride]
        c[stride:] *= c[:-stride].copy()
        stride *= 2
    return y


def _before(y: np.ndarray, new: np.ndarray, start: float) -> np.ndarray:
    """The value before each row, 0 where a key starts."""
    return np.where(new, 0.0, np.concatenate(([start], y[:-1])))


@dataclass(frozen=True)
class Present:
    """The rows of a batch that have a value: where they are, their values, and which start a key.

    `init` has the state a key comes with at the row that starts it, and nan elsewhere.
    """

    at: np.ndarray
    v: np.ndarray
    new: np.ndarray
    init: np.ndarray
    open: bool  # the state goes on after the batch: no key began after the last value
    last: tuple | None  # the state that the last key to begin came with

    @classmethod
    def of(cls, values: pa.Array, fresh: np.ndarray, has_state: bool, inits: dict[int, tuple], width: int) -> Present:
        at = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
        v = values.drop_null().cast(pa.float64()).to_numpy()
        key = np.cumsum(fresh)
        new = np.diff(key[at], prepend=0 if has_state else -1) != 0
        starts = np.flatnonzero(fresh)
        table = np.full((len(starts) + 1, width), np.nan)
        for j, row in enumerate(starts.tolist()):
            if row in inits:
                table[j + 1] = inits[row]
        init = np.full((len(v), width), np.nan)
        init[new] = table[key[at[new]]]
        ends = key[at[-1]] if len(at) else 0
        return cls(at, v, new, init, not len(key) or key[-1] == ends, inits.get(int(starts[-1])) if len(starts) else None)

    def after(self, state: tuple | None) -> tuple | None:
        return state if self.open else self.last

    def spread(self, column: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, column.dtype)
        out[self.at] = column
        return out


@dataclass(frozen=True)
class RunningSum:
    """Inclusive running total."""

    outputs = (("running", "double"),)
    width = 1
    skipped = (None,)

    def step(self, state, v):
        total = v if state is None else state[0] + v
        return (total,), (total,)

    def scan(self, state, values, fresh, inits):
        rows = Present.of(values, fresh, state is not None, inits, self.width)
        total = recurrence(~rows.new, rows.v + np.nan_to_num(rows.init[:, 0]), state[0] if state else 0.0)
        after = (float(total[-1]),) if len(total) else state
        total = rows.spread(total, len(fresh))
        return rows.after(after), (total,), total[:, None]

    def digest_many(self, state, v):
        return ((state[0] if state else 0.0) + float(v.sum()),)

    def digest(self, state, v):
        return self.step(state, v)[0]

    def resume(self, state, digest):
        return (state[0] + digest[0],)

    def fresh(self, digest):
        return digest


@dataclass(frozen=True)
class RunningZScore:
    """z of a row against the rows before it (sample spread); 0 while there is no spread."""

    threshold: float = 3.0
    outputs = (("z", "double"), ("is_anomaly", "boolean"))
    width = 3
    skipped = (None, False)

    def step(self, state, v):
        n, mean, m2 = state or (0.0, 0.0, 0.0)
        spread = math.sqrt(m2 / (n - 1)) if n > 1 else 0.0
        z = (v - mean) / spread if spread > 0 else 0.0
        return self.digest(state, v), (z, abs(z) > self.threshold)

    def scan(self, state, values, fresh, inits):
        rows = Present.of(values, fresh, state is not None, inits, self.width)
        v, new = rows.v, rows.new
        n0, mean0, m0 = state or (0.0, 0.0, 0.0)
        if not len(v):
            return rows.after(state), (np.zeros(len(fresh)), np.zeros(len(fresh), bool)), np.zeros((len(fresh), 3))
        # moments about each key's first value (or the mean it comes with), so that little cancels
        key = np.cumsum(new)
        came = np.nan_to_num(rows.init)
        base = np.concatenate(([mean0], np.where(came[:, 0] > 0, came[:, 1], v)[new]))[key]
        d, goes_on = v - base, ~new
        count = recurrence(goes_on, 1 + came[:, 0], n0)
        total, squares = recurrence(goes_on, d, 0.0), recurrence(goes_on, d * d + came[:, 2], m0)
        n = np.where(new, came[:, 0], _before(count, new, n0))
        t, q = _before(total, new, 0.0), np.where(new, came[:, 2], _before(squares, new, m0))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = base + np.where(n > 0, t / n, 0.0)
            spread = np.sqrt(np.where(n > 1, np.maximum(q - t * t / n, 0.0) / (n - 1), 0.0))
            z = np.where(spread > 0, (v - mean) / spread, 0.0)
        states = np.stack((count, base + total / count, np.maximum(squares - total * total / count, 0.0)), 1)
        z = rows.spread(z, len(fresh))
        out = np.zeros((len(fresh), 3))
        out[rows.at] = states
        return rows.after(tuple(states[-1].tolist())), (z, np.abs(z) > self.threshold), out

    def digest_many(self, state, v):
        own = (float(len(v)), float(v.mean()), float(((v - v.mean()) ** 2).sum()))
        return own if state is None else self.resume(state, own)

    def digest(self, state, v):
        n, mean, m2 = state or (0.0, 0.0, 0.0)
        n += 1
        delta = v - mean
        mean += delta / n
        return n, mean, m2 + delta * (v - mean)

    def resume(self, state, digest):
        n1, mean1, m1 = state
        n2, mean2, m2 = digest
        n = n1 + n2
        delta = mean2 - mean1
        return n, mean1 + delta * n2 / n, m1 + m2 + delta * delta * n1 * n2 / n

    def fresh(self, digest):
        return digest


@dataclass(frozen=True)
class Ewma:
    """Exponentially weighted mean and variance; z uses the new mean and variance.

    The first value of a key seeds the mean and is never flagged. Note that z stays
    below (1 - alpha) / sqrt(alpha), so a threshold above that can never flag.

    A stretch of n values started from an unknown mean e and variance q is kept as the
    outcome of starting it at its own first value s. With d = e - s and g = (1-alpha)^n
    the true outcome is mean + g*d for the mean, and for the variance
    g*q + var - 2*alpha*(1-alpha)^(n-1)*d*sum(dev) + (1-alpha)^(n-1)*(1-g)*d^2,
    as every deviation shifts by (1-alpha)^(t-1)*d.
    """

    alpha: float = 0.2
    threshold: float = 4.0
    signed: bool = False
    outputs = (("ema", "double"), ("ewvar", "double"), ("z", "double"), ("is_anomaly", "boolean"))
    width = 2
    skipped = (None, None, None, False)

    def step(self, state, v):
        if state is None:
            return (v, 0.0), (v, 0.0, 0.0, False)
        ema, var = state
        a = self.alpha
        dev = v - ema
        ema = a * v + (1 - a) * ema
        var = (1 - a) * var + a * dev * dev
        z = (v - ema) / (math.sqrt(var + 1e-9) + 1e-9)
        return (ema, var), (ema, var, z if self.signed else abs(z), abs(z) > self.threshold)

    def _run(self, v, new, ema0, var0, init=None):
        """Means, variances and deviations of rows that may start keys, with the state each comes with."""
        a, b = self.alpha, 1 - self.alpha
        init = np.full((len(v), 2), np.nan) if init is None else init
        came, seeds = ~np.isnan(init[:, 0]), new & np.isnan(init[:, 0])
        ema1, var1 = np.nan_to_num(init).T
        ema = recurrence(np.where(new, 0.0, b), np.where(seeds, v, a * v + b * ema1), ema0)
        before = np.where(came, ema1, np.concatenate(([ema0], ema[:-1])))
        dev = np.where(seeds, 0.0, v - before)
        var = recurrence(np.where(new, 0.0, b), a * dev * dev + b * var1, var0)
        return ema, var, dev

    def scan(self, state, values, fresh, inits):
        rows = Present.of(values, fresh, state is not None, inits, self.width)
        mean, variance, _ = self._run(rows.v, rows.new, *(state or (0.0, 0.0)), rows.init)
        z = (rows.v - mean) / (np.sqrt(variance + 1e-9) + 1e-9)
        flags = np.abs(z) > self.threshold
        after = (float(mean[-1]), float(variance[-1])) if len(mean) else state
        columns = [rows.spread(c, len(fresh)) for c in (mean, variance, z if self.signed else np.abs(z), flags)]
        return rows.after(after), tuple(columns), np.stack(columns[:2], 1)

    def digest_many(self, state, v):
        if state is None:
            state, v = (1.0, float(v[0]), float(v[0]), 0.0, 0.0), v[1:]
        if not len(v):
            return state
        n, s, ema0, var0, devs = state
        ema, var, dev = self._run(v, np.zeros(len(v), bool), ema0, var0)
        return n + len(v), s, float(ema[-1]), float(var[-1]), devs + float(dev.sum())

    def digest(self, state, v):
        if state is None:
            return 1.0, v, v, 0.0, 0.0
        n, s, ema, var, devs = state
        a = self.alpha
        dev = v - ema
        return n + 1, s, a * v + (1 - a) * ema, (1 - a) * var + a * dev * dev, devs + dev

    def resume(self, state, digest):
        e, q = state
        n, s, ema, var, devs = digest
        a = self.alpha
        d, g, h = e - s, (1 - a) ** n, (1 - a) ** (n - 1)
        return ema + g * d, g * q + var - 2 * a * h * d * devs + h * (1 - g) * d * d

    def fresh(self, digest):
        return digest[2], digest[3]


def _values(batch: pa.RecordBatch, keys: Sequence[str], value: str) -> pa.Array:
    """The values, null also where a key is."""
    values = batch.column(value)
    for k in keys:
        if batch.column(k).null_count:
            values = pc.if_else(batch.column(k).is_null(), pa.scalar(None, values.type), values)
    return values


def _starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Rows whose key differs from that of the row before; the first row is left False."""
    starts = np.zeros(batch.num_rows, dtype=bool)
    for k in keys:
        column = batch.column(k)
        before, after = column.slice(0, len(column) - 1), column.slice(1)
        differs = pc.fill_null(pc.not_equal(before, after), False).to_numpy(zero_copy_only=False)
        if column.null_count:
            nulls = column.is_null().to_numpy(zero_copy_only=False)
            differs = differs | (nulls[:-1] != nulls[1:])
        starts[1:] |= differs
    return starts


def _key(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in keys)


def _init(batch: pa.RecordBatch, row: int) -> list | None:
    """The state the row's key comes with."""
    return (batch.column(INIT)[row].as_py() or None) if INIT in batch.schema.names else None


def _summaries(fold, keys: Sequence[str], value: str):
    """Per partition: block, first and last key, and the digest of the last key's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = first = last = state = first_init = last_init = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if block is None:
                block, first = batch.column(BLOCK)[0].as_py(), _key(batch, keys, 0)
                first_init = _init(batch, 0)
            changes = np.flatnonzero(_starts(batch, keys))
            begin = int(changes[-1]) if len(changes) else 0
            ending = _key(batch, keys, batch.num_rows - 1)
            if ending != last:
                last, state, last_init = ending, None, _init(batch, begin)
            numbers = _values(batch, keys, value).slice(begin).drop_null().cast(pa.float64()).to_numpy()
            if len(numbers):
                state = fold.digest_many(state, numbers)
        if block is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    BLOCK: pa.array([block], pa.int32()),
                    "first": [repr(first)],
                    "last": [repr(last)],
                    "digest": pa.array([None if state is None else list(state)], pa.list_(pa.float64())),
                    "first_init": pa.array([first_init], pa.list_(pa.float64())),
                    "last_init": pa.array([last_init], pa.list_(pa.float64())),
                }
            )

    return run


def _carries(fold):
    """Over the partition summaries in order: the state each partition starts from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, states = [], []
        key = state = None
        for batch in batches:
            for row in batch.to_pylist():
                continues = row["first"] == key
                blocks.append(row[BLOCK])
                held = state if continues else row["first_init"]
                states.append(list(held) if held is not None else None)
                if row["last"] == row["first"]:
                    key, state = row["last"], held
                else:
                    key, state = row["last"], row["last_init"]
                if row["digest"] is not None:
                    digest = tuple(row["digest"])
                    state = fold.fresh(digest) if state is None else fold.resume(state, digest)
        yield pa.RecordBatch.from_pydict(
            {BLOCK: pa.array(blocks, pa.int32()), CARRY: pa.array(states, pa.list_(pa.float64()))}
        )

    return run


def _emit(fold, keys: Sequence[str], value: str, kept: Sequence[str], with_state: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = state = None
        started = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts = _starts(batch, keys)
            if not started:
                started = True
                state = tuple(batch.column(CARRY)[0].as_py()) or None
            else:
                starts[0] = _key(batch, keys, 0) != current
            current = _key(batch, keys, batch.num_rows - 1)
            values = _values(batch, keys, value)
            begun = np.flatnonzero(starts).tolist() if INIT in batch.schema.names else []
            inits = {i: tuple(s) for i in begun if (s := _init(batch, i))}
            state, columns, states = fold.scan(state, values, starts, inits)
            absent = values.is_null().to_numpy(zero_copy_only=False)
            arrays, names = [batch.column(n) for n in kept], list(kept)
            for (name, kind), column, neutral in zip(fold.outputs, columns, fold.skipped):
                if neutral is None:
                    arrays.append(pa.array(column, pa.float64(), mask=absent))
                else:
                    arrays.append(pa.array(np.where(absent, neutral, column), pa.bool_()))
                names.append(name)
            if with_state:
                lists = pa.FixedSizeListArray.from_arrays(pa.array(states.ravel()), fold.width).cast(pa.list_(pa.float64()))
                arrays.append(pc.if_else(pa.array(absent), pa.scalar(None, lists.type), lists))
                names.append(STATE)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    fold,
    partitions: int | None = None,
    stage: bool = False,
    initial: DataFrame | None = None,
    with_state: bool = False,
) -> DataFrame:
    """`df` plus the outputs of `fold` over `value` per key in `order` (make it total).

    Rows whose key or value is null take no part and get the fold's neutral outputs.
    Finding the range bounds reads `df` once more; set `stage` where its rows are costly
    to make (parsed text), and they are written once first.

    `initial` has the state some keys come with (keys, `state`: array<double>, one row per key), and
    `with_state` adds the state after each row as `_state`, so that a scan can go on where an earlier
    one ended.
    """
    spark = df.sparkSession
    if stage:
        df = cut_lineage(df)
    columns, fields = df.columns, df.schema
    if initial is not None:
        df = key_join(df, initial.select(*keys, F.col("state").alias(INIT)), keys, "left").drop(*[f"_r_{k}" for k in keys])
        df = df.withColumn(INIT, F.coalesce(INIT, F.array().cast("array<double>")))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(BLOCK, F.spark_partition_id())
    )
    blocks = cut_lineage(placed)
    summary = blocks.select(BLOCK, *keys, value, *([INIT] if initial is not None else [])).mapInArrow(
        _summaries(fold, keys, value),
        f"{BLOCK} int, first string, last string, digest array<double>, first_init array<double>, last_init array<double>",
    )
    carries = (
        summary.repartition(1)  # one row per partition
        .sortWithinPartitions(BLOCK)
        .mapInArrow(_carries(fold), f"{BLOCK} int, {CARRY} array<double>")
    )
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
        + [f"{n} {t}" for n, t in fold.outputs]
        + ([f"{STATE} array<double>"] if with_state else [])
    )
    # broadcast: one row per partition
    with_carry = blocks.join(F.broadcast(carries), BLOCK, "left").withColumn(
        CARRY, F.coalesce(CARRY, F.array().cast("array<double>"))  # Arrow writes null lists slowly
    )
    return with_carry.mapInArrow(_emit(fold, keys, value, columns, with_state), schema)


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Interpolated quantiles per group: (groups, probability, quantile).

    Equal values are counted first and put in order over all tasks. Totals per task give the offset of
    each task's running count, which finds the values at the wanted ranks; no task holds a group.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # value order over all tasks: a group of many values spans many of them
    counts = cut_lineage(counted.repartitionByRange(n, *groups, value).withColumn(BLOCK, F.spark_partition_id()))
    totals = counts.groupBy(*groups, BLOCK).agg(F.sum("_n").alias("_in_block"))  # a row per group and task
    earlier = Window.partitionBy(*groups).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, BLOCK, F.coalesce(F.sum("_in_block").over(earlier), F.lit(0.0)).alias("_offset"))
    inside = Window.partitionBy(*groups, BLOCK).orderBy(value)
    running = counts.withColumn("_sum", F.sum("_n").over(inside)).join(offsets, [*groups, BLOCK])
    running = running.select(*groups, value, "_n", (F.col("_sum") + F.col("_offset")).alias("running"))
    ranks = (
        counts.groupBy(*groups)
        .agg(F.sum("_n").alias("_total"))
        .select(*groups, "_total", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"))
        .withColumn("_at", F.col("probability") * (F.col("_total") - 1))
        .withColumns({"_low": F.floor("_at"), "_high": F.ceil("_at")})
    )

    def covers(rank: str):
        return (F.col("running") > F.col(rank)) & (F.col("running") - F.col("_n") <= F.col(rank))

    found = (
        running.join(ranks, list(groups))
        .where(covers("_low") | covers("_high"))
        .groupBy(*groups, "probability", "_at", "_low")
        .agg(
            F.max(F.when(covers("_low"), F.col(value))).alias("_v_low"),
            F.max(F.when(covers("_high"), F.col(value))).alias("_v_high"),
        )
    )
    weight = F.col("_at") - F.col("_low")
    return found.select(
        *groups, "probability", (F.col("_v_low") + (F.col("_v_high") - F.col("_v_low")) * weight).alias("quantile")
    )
