"""Comparison of two keyed stores by their stored digests, level by level.

The root and the buckets stand in the manifests, the leaves in the digest tables. Equal buckets are not opened; in
the others only leaves that differ are, and only rows of those are read and compared. So two equal
tables are compared without reading a row, and the work grows with what differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowwarden.operators import reconcile
from rowwarden.sources.keyed_store import KeyedStore

FEW = 256  # leaves that are looked up by value, so that files are searched by their statistics


def differing_buckets(a: KeyedStore, b: KeyedStore) -> list[int]:
    """Buckets whose row count or digest differ between the last commits, from the manifests alone."""
    if (a.buckets, a.leaves) != (b.buckets, b.leaves):
        raise ValueError("stores must have the same buckets and leaves")
    nothing = (0, (0,) * len(reconcile.DIGEST))
    left, right = ({k: (e.rows, tuple(int(d) for d in e.digest)) for k, e in s.manifest()[1].items()} for s in (a, b))
    return sorted(k for k in left.keys() | right.keys() if left.get(k, nothing) != right.get(k, nothing))


def differing_leaves(a: KeyedStore, b: KeyedStore, buckets: list[int]) -> DataFrame:
    """Leaves of the given buckets that differ."""
    sides = [s.leaf_digests(s.manifest()[1], buckets).where("row_count > 0").withColumnRenamed("leaf", "segment") for s in (a, b)]
    return reconcile.differing_segments(*sides).withColumnRenamed("segment", "leaf")


def open_rows(a: KeyedStore, b: KeyedStore) -> tuple[DataFrame, DataFrame]:
    """Rows of both stores in the leaves that differ."""
    buckets = differing_buckets(a, b)
    leaves = differing_leaves(a, b, buckets)
    some = [r.leaf for r in leaves.limit(FEW + 1).collect()]

    def inside(store: KeyedStore) -> DataFrame:
        rows = store.rows_of(buckets)
        found = rows.where(F.col("leaf").isin(some)) if len(some) <= FEW else rows.join(leaves, "leaf", "left_semi")
        return found.select(*store.schema.names)

    return inside(a), inside(b)


def drift(a: KeyedStore, b: KeyedStore, key: str, a_hash: str, b_hash: str) -> DataFrame:
    """Status of every key in a leaf that differs; all keys that are not OK are among them.

    A store has one row per key and none without one, so the sides are joined as they are.
    """
    left, right = open_rows(a, b)
    if (a.keys, b.keys) != ([key], [key]):
        return reconcile.full_outer(left, right, key, a_hash, b_hash)
    sides = left.select(key, F.col(a_hash).alias("onprem_hash")), right.select(key, F.col(b_hash).alias("azure_hash"))
    status = reconcile.drift_status(F.col("onprem_hash"), F.col("azure_hash"))
    return sides[0].join(sides[1], key, "full_outer").select(key, "onprem_hash", "azure_hash", status.alias("reconciliation_status"))
