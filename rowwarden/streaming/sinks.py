"""Outputs of a stream: replay-safe folders, several outputs of one batch, upserts.

Each micro-batch writes to `…/batch_id=<id>`, and a batch that is run again after a
failure overwrites just that folder, so every output holds each batch once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowwarden.operators import keyed
from rowwarden.operators.routing import error_letter

Handler = Callable[[DataFrame, int], None]


LANES = 8


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """One folder per batch; a batch run again replaces all of it, whatever the session's overwrite mode.

    Rows are brought together by partition value, over LANES tasks each, so a value gets at most
    LANES files and a hot one is still spread.
    """
    if partition_by:
        rest = [c for c in df.columns if c not in partition_by]
        lane = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in rest]), F.lit(LANES)) if rest else F.lit(0)
        df = df.repartition(*partition_by, lane)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/batch_id={batch_id}")


def results_store(path: str, outputs: Mapping, day: Column) -> Handler:
    """A handler that keeps results as a rule document's `outputs` say: partitions, order in them, name."""

    def handle(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn(outputs["partition_by"], day)
        write_batch(rows, f"{path}/{outputs['table']}", batch_id, [outputs["partition_by"]], outputs.get("clustering_by", ()))

    return handle


def kept_results(spark: SparkSession, path: str, outputs: Mapping, as_of: Column) -> DataFrame:
    """The stored results that are within the document's retention: a filter on the partition column."""
    rows = read_output(spark, f"{path}/{outputs['table']}")
    return keyed.retained(rows, outputs["partition_by"], as_of, int(outputs["retention_days"]))


def replay_safe(path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> Handler:
    return lambda df, batch_id: write_batch(df, path, batch_id, partition_by, sort_by)


def fan_out(outputs: Mapping[str, tuple[Column, Callable[[DataFrame], DataFrame] | None]], root: str) -> Handler:
    """Writes the rows of each output's condition, shaped by its function, under `root/<output>`.

    All outputs of a batch are computed and staged first, in one write; the outputs are then copies of
    staged files. A condition or a shape that fails thus leaves no output with a part of the batch. The
    stage is kept until the next batch replaces it.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        staged = {}
        for name, (condition, shape) in outputs.items():
            rows = df.where(F.coalesce(condition, F.lit(False)))
            staged[name] = shape(rows) if shape else rows
        stage = f"{root}/_stage"
        df = df.persist()
        try:
            for name, rows in staged.items():
                rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{stage}/{name}")
        finally:
            df.unpersist()
        for name, rows in staged.items():
            write_batch(df.sparkSession.read.schema(rows.schema).parquet(f"{stage}/{name}"), f"{root}/{name}", batch_id)

    return handle


def dual_write(paths: Sequence[str]) -> Handler:
    """The same rows to two or more sites."""

    def handle(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            for path in paths:
                write_batch(df, path, batch_id)
        finally:
            df.unpersist()

    return handle


# error classes of Spark that come from the rows themselves
ROW_ERRORS = (
    "CAST_INVALID_INPUT", "CAST_OVERFLOW", "NUMERIC_VALUE_OUT_OF_RANGE", "ARITHMETIC_OVERFLOW", "DIVIDE_BY_ZERO", "INVALID_ARRAY_INDEX",
    "MALFORMED_RECORD_IN_PARSING", "CANNOT_PARSE_TIMESTAMP", "MALFORMED_VARIANT", "INVALID_VARIANT_CAST", "USER_RAISED_EXCEPTION",
)


def conditions(failure: BaseException) -> set[str]:
    """Names of the error conditions of a failure and of what caused it; its text is not looked at."""
    found = {failure.getCondition()} if isinstance(failure, PySparkException) else set()
    cause = getattr(failure, "_origin", None)
    while cause is not None:
        if "SparkThrowable" in {c.getSimpleName() for c in _interfaces(cause.getClass())}:
            found.add(cause.getCondition())
        cause = cause.getCause()
    return found - {None}


def _interfaces(kind):
    while kind is not None:
        yield from kind.getInterfaces()
        kind = kind.getSuperclass()


def with_failure_policy(
    handler: Handler, dead_letters: str | None = None, key: str | None = None, errors: Sequence[str] = ROW_ERRORS
) -> Handler:
    """Raise when a write fails, or divert batches whose rows cannot be processed to dead letters.

    Only the named error classes are diverted; a full disk or a lost cluster still raises, and the
    batch is run again. The handler must write all or nothing, as `fan_out` does.
    """
    if dead_letters is None:
        return handler

    def handle(df: DataFrame, batch_id: int) -> None:
        try:
            handler(df, batch_id)
        except Exception as failure:
            if not conditions(failure) & set(errors):
                raise
            message = F.to_json(F.struct(*([key] if key else []), *[c for c in df.columns if c != key]))
            letter = error_letter(F.lit(f"{type(failure).__name__}"), message, F.current_timestamp().cast("string"))
            write_batch(df.select(letter.alias("letter")), dead_letters, batch_id)

    return handle


def read_output(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Upsert view of a change log: the last row of each key, by order and then by batch."""
    return keyed.latest_by_key(read_output(spark, path), keys, [*order, "batch_id"]).drop("batch_id")


def compact(
    spark: SparkSession, path: str, state: str, keys: Sequence[str], order: Sequence[str], version: int, previous: int | None = None
) -> int:
    """Fold the log's batches into `state/version=<version>`; gives the last batch it holds.

    With `previous` it starts from that version and reads the batches after it only, so batches that every kept
    version holds can be removed from the log. A view reads one state and the batches after it (see `compacted_rows`).
    Versions are new folders, so readers of an older one are not disturbed; run it again to repair.
    """
    rows, through = (read_output(spark, path), None) if previous is None else _state_and_later(spark, path, state, previous)
    last = rows.agg(F.max("batch_id")).first()[0]
    last = through if last is None else last if through is None else max(last, through)
    rows = keyed.latest_by_key(rows.where(F.col("batch_id") <= last), keys, [*order, "batch_id"]) if last is not None else rows
    rows.withColumnRenamed("batch_id", "from_batch").withColumn("through", F.lit(last).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(f"{state}/version={version}")
    return -1 if last is None else int(last)


def _state_and_later(spark: SparkSession, path: str, state: str, version: int) -> tuple[DataFrame, int | None]:
    """Rows of a compacted state and of the batches after it, and the last batch the state holds."""
    base = spark.read.parquet(f"{state}/version={version}")
    through = base.agg(F.max("through")).first()[0]
    later = read_output(spark, path)
    later = later.where(F.col("batch_id") > through) if through is not None else later
    return base.withColumnRenamed("from_batch", "batch_id").select(*later.columns).unionByName(later), through


def compacted_rows(spark: SparkSession, path: str, state: str, version: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The upsert view from a compacted state and the batches after it."""
    rows, _ = _state_and_later(spark, path, state, version)
    return keyed.latest_by_key(rows, keys, [*order, "batch_id"]).drop("batch_id")


def to_topic(df: DataFrame, servers: str, topic: str | None = None):
    """Writer of key/value rows to a topic, or to the topic each row names."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic) if topic else writer


def start(df: DataFrame, handler: Handler, checkpoint: str, interval: str | None = None, mode: str = "append"):
    """Run the stream: at an interval, or once over all that is available."""
    writer = df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).outputMode(mode)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
