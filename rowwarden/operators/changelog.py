"""Counts that are kept by what changed: each commit's changelog moves them, no table is counted again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowwarden.sources import keyed_store
from rowwarden.sources.keyed_store import KeyedStore


def weight(kind: Column) -> Column:
    """+1 for a row that came, -1 for one that went."""
    signs = F.create_map(*[F.lit(x) for pair in keyed_store.WEIGHT.items() for x in pair])
    return F.element_at(signs, kind).cast("bigint")


def count_deltas(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How a commit moves the number of rows per value of the columns; values that do not move are left out."""
    moved = changes.groupBy(*columns).agg(F.sum(weight(F.col("kind"))).alias("n"))
    return moved.where("n <> 0")


def moved_counts(counts: DataFrame | None, deltas: DataFrame, columns: Sequence[str]) -> DataFrame:
    both = deltas if counts is None else counts.unionByName(deltas)
    return both.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")


class KeptCounts:
    """Counts per value of some expressions over the rows of a store, one version per commit of the store."""

    def __init__(self, store: KeyedStore, root: str, by: dict[str, Column]):
        self.store, self.root, self.by = store, root, by

    def follow(self, version: int) -> None:
        """Bring the counts from the commit before to this one; run again, it gives the same."""
        before, _ = self.store.manifest(version)
        rows = self.store.changes(version).select("kind", *[c.alias(n) for n, c in self.by.items()])
        counts = None if before is None else self.at(before)
        keyed_store._overwrite(moved_counts(counts, count_deltas(rows, list(self.by)), list(self.by)).coalesce(1), self._path(version))

    def at(self, version: int) -> DataFrame:
        return self.store.spark.read.parquet(self._path(version))

    def _path(self, version: int) -> str:
        return f"{self.root}/version={version}"


def merging(store: KeyedStore, *followers: Callable[[int], None], keep: int | None = 2) -> Callable[[DataFrame, int], None]:
    """A handler of micro-batches: merge, then let the followers see the commit, then drop old versions."""

    def handle(df: DataFrame, batch_id: int) -> None:
        store.merge(df, batch_id)
        for follow in followers:
            follow(batch_id)
        if keep:
            store.vacuum(max(keep, 2))  # the commit before is needed to run this batch again

    return handle


def plain_counts(rows: DataFrame, by: dict[str, Column]) -> DataFrame:
    """The same counts from the whole table."""
    return rows.groupBy(*[c.alias(n) for n, c in by.items()]).agg(F.count(F.lit(1)).alias("n"))
