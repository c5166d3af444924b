"""Keyed tables on top of append-only change logs: upserts, expiry, change capture.

Each "latest" below is either `row_number() <= n`, which Spark cuts down per map task
(window group limit), or a `max_by`, which combines on the map side. Either way a hot
key sends a handful of rows per task through the shuffle, not its whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowwarden.functions.hashing import key_bucket


def latest_by_key(log: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The last `n` rows of each key by `order`; make `order` total to get one answer."""
    window = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return log.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def first_by_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
    return log.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def merge_partial(log: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the last non-null value of each column: a null leaves the old value."""
    stamp = F.struct(*order)
    return log.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), stamp)).alias(c) for c in columns]
    )


def last_write_wins(log: DataFrame, keys: Sequence[str], write_time: str, tie: Sequence[str] = ()) -> DataFrame:
    return latest_by_key(log, keys, [write_time, *tie])


def alive(rows: DataFrame, write_time: str, ttl_seconds: str, as_of: Column) -> DataFrame:
    """Rows whose write time plus time-to-live is still ahead; no time-to-live never expires."""
    expiry = F.col(write_time) + F.make_dt_interval(secs=F.col(ttl_seconds))
    return rows.where(F.col(ttl_seconds).isNull() | (expiry > as_of))


def insert_if_absent(table: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table plus the first incoming row of each key it does not hold."""
    fresh = first_by_key(incoming, keys, order).join(table.select(*keys).distinct(), list(keys), "left_anti")
    return table.unionByName(fresh.select(*table.columns))


def apply_changes(
    snapshot: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """Present image from an initial snapshot (op `r`) and the changes after it; deletes drop the key."""
    log = changes if snapshot is None else snapshot.unionByName(changes)
    return latest_by_key(log, keys, order).where(F.col(op) != "d")


def retained(rows: DataFrame, day: str, as_of: Column, days: int) -> DataFrame:
    """Partitions not older than `days`: a filter on the partition column alone."""
    return rows.where(F.col(day) >= F.date_sub(F.to_date(as_of), days))


def rekeyed(rows: DataFrame, new_key: str, columns: Sequence[str]) -> DataFrame:
    """Copy of the rows under another key, without those that lack it."""
    return rows.where(F.col(new_key).isNotNull()).select(new_key, *columns)


def hash_sample(rows: DataFrame, key: str, one_in: int) -> DataFrame:
    """A repeatable sample of keys for audits: the same keys at every site and run."""
    return rows.where(key_bucket(F.col(key), one_in) == 0)


def bottom_k(rows: DataFrame, keys: Sequence[str], identity: Sequence[str], k: int) -> DataFrame:
    """A repeatable sample of min(k, rows) rows per key: those with the smallest digests of their identity.

    Every site picks the same rows. Each task sends k rows of a key at most, however hot the key is.
    `identity` names a row; rows with equal identity are told apart by nothing and any of them may stand.
    """
    digest = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity]), 256)
    ranked = Window.partitionBy(*keys).orderBy("_digest")
    return rows.withColumn("_digest", digest).withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k).drop("_digest", "_rank")
