"""Keyed tables as bounded input."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowwarden.functions.hashing import key_bucket
from rowwarden.operators.joins import key_join


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def restricted(df: DataFrame, columns: Sequence[str], condition: Column | str) -> DataFrame:
    """Projection and filter; Spark brings both down to the file scan."""
    return df.where(condition).select(*columns)


def newer_than(df: DataFrame, moment: str, high_water_mark: Column) -> DataFrame:
    """Rows after the stored high-water mark; the mark filters row groups in the scan."""
    return df.where(F.col(moment) > high_water_mark)


def read_since_mark(spark: SparkSession, df: DataFrame, moment: str, store: str) -> tuple[DataFrame, Callable[[], None]]:
    """(rows after the stored mark, commit): call commit once the rows are written.

    The mark is a one-row table in `store`, a new one for each commit, so a commit that is cut off leaves the mark
    before it. Without one, all rows with a time are new. The upper end is taken before the rows are read, so that rows
    that arrive meanwhile wait for the next run, and a run that fails before its commit is repeated over the same rows.
    """
    kind = df.schema[moment].dataType
    number, low = -1, None
    try:
        marks = spark.read.parquet(store)
        last = marks.orderBy(F.desc("run")).select("run", "high_water_mark").first()
        number, low = last if last is not None else (-1, None)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    high = df.agg(F.max(moment)).first()[0]
    rows = df.where(F.col(moment) <= F.lit(high).cast(kind)) if high is not None else df.where(F.col(moment).isNotNull())
    rows = rows if low is None else newer_than(rows, moment, F.lit(low).cast(kind))

    def commit() -> None:
        if high is not None:
            mark = spark.range(1).select(F.lit(high).cast(kind).alias("high_water_mark"))
            mark.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{store}/run={number + 1}")

    return rows, commit


def key_range(df: DataFrame, key: str, buckets: int, start: int, end: int) -> DataFrame:
    """Rows whose hashed key lies in buckets [start, end); rows without a key are in bucket 0.

    Ranges that cover [0, buckets) without overlap read every row once.
    """
    bucket = F.coalesce(key_bucket(F.col(key), buckets), F.lit(0).cast("bigint"))
    return df.withColumn("bucket", bucket).where((F.col("bucket") >= start) & (F.col("bucket") < end))


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows with their hashed key range, to read or compare a table in parts."""
    return df.withColumn("bucket", key_bucket(F.col(key), buckets))


def external_table(spark: SparkSession, keyspace: str, name: str, **options) -> DataFrame:
    """A wide-column table through its public Spark connector (which must be on the class path)."""
    return (
        spark.read.format("org.apache.spark.sql.cassandra").options(keyspace=keyspace, table=name, **options).load()
    )


def lookup(messages: DataFrame, table_rows: DataFrame, keys: Sequence[str], not_found: str = "No data found") -> DataFrame:
    """Each message with the stored row of its key (one row per key) and a `lookup` remark.

    Spark broadcasts the table when its size allows; a hot message key is split by AQE.
    """
    found = key_join(messages, table_rows, keys, "left")
    return found.withColumn(
        "lookup", F.when(F.col(f"_r_{keys[0]}").isNull(), not_found).otherwise("found")
    ).drop(*[f"_r_{k}" for k in keys])
