"""Streams of messages: topics, folders of files, generated events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowwarden.functions import hashing


def topic(spark: SparkSession, servers: str, name: str, start: str = "earliest", **options) -> DataFrame:
    """A topic with key and value as bare text; needs Spark's Kafka package on the class path.

    Pass `maxOffsetsPerTrigger` to bound a micro-batch.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", name)
        .option("startingOffsets", start)
        .options(**options)
        .load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("timestamp").alias("arrival_ts"))
    )


def files(spark: SparkSession, folder: str, schema: str, fmt: str = "json", per_trigger: int | None = None) -> DataFrame:
    """Typed rows of the files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(folder)


def stamped(df: DataFrame, name: str = "proc_ts") -> DataFrame:
    """Rows with the time at which they were read."""
    return df.withColumn(name, F.current_timestamp())


def with_payload(df: DataFrame, *columns: str) -> DataFrame:
    """Seed messages {pk, hash, payload, ts} of rows with pk and ts."""
    return df.withColumn("payload", F.to_json(F.struct(*columns))).select(
        "pk", hashing.digest(F.col("payload")).alias("hash"), "payload", "ts"
    )


def generated(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """{id, value in [-100, 500), ts} at a set rate, the same values for the same ids."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    value = F.pmod(F.xxhash64("value"), F.lit(60000)) / 100 - 100
    return rate.select(F.col("value").cast("string").alias("id"), value.alias("value"), F.col("timestamp").alias("ts"))
