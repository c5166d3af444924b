"""Per-key anomaly detection over stored rows (see streaming.stateful for live streams)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowwarden.operators import keyed
from rowwarden.operators.ordered import Ewma, RunningZScore, ordered_scan

GLOBAL_KEY = "__global"


def zscore(
    df: DataFrame, key: str, order: Sequence[str], value: str, threshold: float = 3.0, partitions: int | None = None
) -> DataFrame:
    """Adds z and is_anomaly against the earlier rows of the key."""
    return ordered_scan(df, [key], order, value, RunningZScore(threshold), partitions)


def ewma(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    alpha: float = 0.2,
    threshold: float = 4.0,
    signed: bool = False,
    partitions: int | None = None,
    stage: bool = False,
) -> DataFrame:
    """Adds ema, ewvar, z and is_anomaly; rows without key or number pass by."""
    return ordered_scan(df, [key], order, value, Ewma(alpha, threshold, signed), partitions, stage)


def ewma_lenient(
    df: DataFrame, key: str, order: Sequence[str], value: str, alpha: float = 0.1, threshold: float = 3.0
) -> DataFrame:
    """EWMA with a shared key for rows without one, 0 for a missing value, and a signed z."""
    filled = df.withColumns(
        {key: F.coalesce(F.col(key), F.lit(GLOBAL_KEY)), value: F.coalesce(F.col(value), F.lit(0.0))}
    )
    return ewma(filled, key, order, value, alpha, threshold, signed=True)


def last_state(scanned: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The state each key ends with."""
    seen = scanned.where(F.col("ema").isNotNull())
    return keyed.latest_by_key(seen.select(key, *order, "ema", "ewvar"), [key], order)


def feed(scanned: DataFrame, valid: Column) -> DataFrame:
    """Rows for the anomaly output: valid and anomalous."""
    return scanned.where(valid & F.col("is_anomaly"))
