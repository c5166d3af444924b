"""Alerts on keys that fall silent, raised by timers: no row has to arrive for one.

Time is cut into windows. From the first row of a key on, every window without a valid row is an alert, given when the
watermark passes its end. A key without any row for `idle_windows` windows leaves the state store and starts anew with
its next row, so the store holds what is alive and not what was ever seen. The batch form is
`operators.metrics.stalled_by_key`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType


class SilentKeys(StatefulProcessor):
    """Windows of one key that are not judged yet; all times are milliseconds."""

    def __init__(self, names: Sequence[str], size: int, idle: int):
        self.names, self.size, self.idle = list(names), size, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start bigint", "valid boolean")
        self.place = handle.getValueState("place", "next bigint, silent int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        windows: dict[int, bool] = {}
        for r in rows:
            start = r["at"] // self.size * self.size
            windows[start] = windows.get(start, False) or r["valid"]
        first = min(windows)
        if not self.place.exists() or first < self.place.get()[0]:
            # a window that is judged has ended, so rows of it come too late and are not seen here
            self.place.update((first, 0))
            self.handle.registerTimer(first + self.size)
        for start, valid in windows.items():
            held = self.open.getValue((start,)) if self.open.containsKey((start,)) else None
            self.open.updateValue((start,), (valid or bool(held and held[0]),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.place.exists():
            return
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        start, silent = self.place.get()
        if start + self.size > now:
            return  # judged by an earlier timer; that of the next window is set
        open_windows = {k[0]: v[0] for k, v in self.open.iterator()} if self.open.exists() else {}
        while start + self.size <= now:
            silent = 0 if start in open_windows else silent + 1
            if start in open_windows:
                self.open.removeKey((start,))
            if not open_windows.pop(start, False):
                yield Row(*self.names)(*key, start * 1000)
            start += self.size
            if silent >= self.idle:
                if not open_windows:
                    self.place.clear()
                    return
                start, silent = min(open_windows), 0  # it came back later on
        self.place.update((start, silent))
        self.handle.registerTimer(start + self.size)

    def close(self) -> None:
        pass


def silent_keys(
    df: DataFrame, keys: Sequence[str], moment: str, minutes: int, valid: Column, idle_windows: int = 6, delay: str = "5 seconds"
) -> DataFrame:
    """(keys, window_start) of every window in which a live key had no valid row.

    Rows without a time or key are left out. Needs the RocksDB state store.
    """
    at = F.col(moment).cast("timestamp")
    rows = df.where(at.isNotNull()).dropna(subset=list(keys))
    live = rows.select(*keys, at.alias("clock"), F.unix_millis(at).alias("at"), F.coalesce(valid, F.lit(False)).alias("valid")).withWatermark("clock", delay)
    fields = StructType([*[df.schema[k] for k in keys], *StructType.fromDDL("window_start bigint").fields])
    size = minutes * 60_000
    found = live.groupBy(*keys).transformWithState(SilentKeys(fields.names, size, idle_windows), fields, "Append", "EventTime")
    return found.withColumn("window_start", F.timestamp_micros("window_start").cast("timestamp_ntz"))
