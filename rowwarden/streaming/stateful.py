"""Per-key recursions on live streams, with the folds of `operators.ordered`.

`fold_batches` runs the split scan of a micro-batch in `foreachBatch` with the key states kept in a
folder, so a hot key's backlog spans many tasks. `fold_stream` keeps the state in Spark's state store
and has lower latency, but a key's rows of one micro-batch meet in one task: limit the trigger there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from rowwarden.operators.ordered import STATE, ordered_scan
from rowwarden.session import cut_lineage
from rowwarden.sources.keyed_store import KeyedStore
from rowwarden.streaming.sinks import Handler

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


class FoldProcessor(StatefulProcessor):
    """Keeps the state of one key and emits the fold's outputs for each of its rows.

    The rows of a key in one micro-batch come unordered and are put in order first, so
    the trigger's limits (files or offsets) bound what a task holds.
    """

    def __init__(self, fold, order: Sequence[str], value: str):
        self.fold, self.order, self.value = fold, list(order), value

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = StructType([StructField("state", ArrayType(DoubleType()))])
        self.store = handle.getValueState("fold", schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        state = tuple(self.store.get()[0]) if self.store.exists() else None
        outputs = []
        for v in batch[self.value].tolist():
            if v is None or v != v:
                outputs.append(self.fold.skipped)
            else:
                state, out = self.fold.step(state, v)
                outputs.append(out)
        if state is not None:
            self.store.update((list(state),))
        for position, (name, _) in enumerate(self.fold.outputs):
            batch[name] = [o[position] for o in outputs]
        yield batch

    def close(self) -> None:
        pass


def fold_stream(df: DataFrame, key: str, order: Sequence[str], value: str, fold) -> DataFrame:
    """The stream plus the outputs of `fold` per key; needs the RocksDB state store."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*[f"`{n}` {t}" for n, t in kinds.items()], *[f"{n} {t}" for n, t in fold.outputs]])
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .transformWithStateInPandas(FoldProcessor(fold, order, value), schema, "Append", "None")
    )


def fold_batches(
    folder: str, keys: Sequence[str], order: Sequence[str], value: str, fold, handler: Handler, buckets: int = 16, keep: int = 2
) -> Handler:
    """A handler that adds the outputs of `fold` to each batch and passes it on to `handler`.

    States are kept in a bucketed store under `folder`: a batch reads and writes the buckets of its own keys
    only, and old versions go. A batch that is run again starts from the states below it, so it gives the same rows;
    a new folder starts without states whatever the number of the first batch. Rows without a key or value pass by.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        schema = StructType([*[df.schema[k] for k in keys], StructField("state", ArrayType(DoubleType())), StructField("batch", LongType())])
        store = KeyedStore(spark, folder, schema, keys, ["batch"], buckets)
        df = cut_lineage(df)  # read for the buckets, then scanned
        initial = store.beside(df, batch_id).select(*keys, "state")
        scanned = cut_lineage(ordered_scan(df, keys, order, value, fold, initial=initial, with_state=True))
        stamp = F.struct(*order)
        ended = scanned.where(F.col(STATE).isNotNull()).groupBy(*keys).agg(F.max_by(STATE, stamp).alias("state"))
        handler(scanned.drop(STATE), batch_id)
        store.merge(ended.withColumn("batch", F.lit(batch_id).cast("long")), batch_id)
        store.vacuum(max(keep, 2))

    return handle
