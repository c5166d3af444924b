"""Watermarks, windows and deduplication of streams.

Window counts are those of `operators.metrics`; a stream needs the watermark first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def watermarked(df: DataFrame, moment: str, delay: str = "5 seconds") -> DataFrame:
    """Event time with an allowed delay; times without zone are taken as the session's."""
    return df.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, delay)


def deduplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First of equal keys; state is dropped when the watermark has passed."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def late_rows(query) -> int:
    """Rows that came behind the watermark and were dropped, over the progress kept."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
