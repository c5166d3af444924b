"""Joins of streams: time-bounded with a second stream, by key with a stored table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower_seconds: int,
    upper_seconds: int,
    how: str = "leftOuter",
) -> DataFrame:
    """`right_time` within `left_time + [lower, upper]`; both sides carry a watermark.

    Bound and watermarks tell Spark when a row can have no more partners, so its state is
    dropped and, in an outer join, the row comes out alone. Right keys come out as `_r_<key>`.
    """
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    conditions = [left[k] == renamed[f"_r_{k}"] for k in keys]
    conditions.append(renamed[right_time] >= left[left_time] + F.expr(f"INTERVAL {lower_seconds} SECONDS"))
    conditions.append(renamed[right_time] <= left[left_time] + F.expr(f"INTERVAL {upper_seconds} SECONDS"))
    return left.join(renamed, reduce(lambda a, b: a & b, conditions), how)


def with_stored(stream: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream rows with the stored row of their key.

    A left join of two streams without a time bound would keep state for ever and is
    refused; the second topic is read as its latest row per key instead.
    """
    return stream.join(stored, list(keys), "left")
