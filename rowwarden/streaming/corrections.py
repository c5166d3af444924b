"""Verdicts on two hash streams that are given in time and corrected when a late row comes.

A left row gets its verdict as soon as a right row of its key lies within the bound after it. If none has come
when the clock passes the end of the window, it is reported as missing; a partner that comes after that, until the
horizon, brings a correcting row. Of several partners the latest counts, so the last verdict of a
row does not depend on the order in which things arrive and equals that of the batch form
(`operators.reconcile.verdict_history`).

State is kept by (key, time slot), as in the batch interval join, so a hot key is spread over its time; it is
two maps with a timer per row, and is empty once the clock is past the horizon of every row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from rowwarden.operators.joins import LANES

MATCH, MISMATCH, MISSING = "MATCH", "MISMATCH", "MISSING_CLOUD"
VERDICT = "left_at bigint, left_hash string, right_at bigint, right_hash string, status string, revision int, is_correction boolean"


class LateVerdicts(StatefulProcessor):
    """Left and right rows of one (key, slot) that can still meet; times are microseconds."""

    def __init__(self, names: Sequence[str], window: int, bound: int, horizon: int):
        self.names, self.window, self.bound, self.horizon = list(names), window, bound, horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lefts = handle.getMapState("lefts", "id string", "at bigint, hash string, best_at bigint, best_hash string, revision int")
        self.rights = handle.getMapState("rights", "at bigint, hash string", "n int")

    def _due(self, at: int, after: int) -> int:
        return -(-(at + after) // 1000)  # timers count in whole milliseconds

    def _held(self) -> tuple[dict, list]:
        lefts = {k[0]: list(v) for k, v in self.lefts.iterator()} if self.lefts.exists() else {}
        rights = [(k[0], k[1]) for k in self.rights.keys()] if self.rights.exists() else []
        return lefts, rights

    def _verdict(self, key, name: str, left: list) -> Row:
        at, digest, best_at, best_hash, revision = left
        status = MISSING if best_at is None else MATCH if digest is not None and digest == best_hash else MISMATCH
        return Row(*self.names)(*key, name, at, digest, best_at, best_hash, status, revision, revision > 1)

    @staticmethod
    def _rank(at: int | None, digest: str | None) -> tuple:
        return (at is not None, at or 0, digest is not None, digest or "")

    def _meet(self, left: list, at: int, digest: str | None) -> bool:
        """Take the right row as partner if it is one, and a later one than that of now."""
        if not left[0] <= at <= left[0] + self.bound or self._rank(at, digest) <= self._rank(left[2], left[3]):
            return False
        left[2], left[3] = at, digest
        return True

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lefts, rights = self._held()
        known, changed = set(rights), set()
        for r in rows:
            if not r["is_left"]:
                right = (r["at"], r["hash"])
                if right in known:
                    continue
                known.add(right)
                self.rights.updateValue(right, (1,))
                self.handle.registerTimer(self._due(r["at"], self.horizon))
                changed.update(name for name, left in lefts.items() if self._meet(left, *right))
            elif r["at"] is None or any(k is None for k in key[:-1]):
                yield self._verdict(key[:-1], r["id"], [r["at"], r["hash"], None, None, 1])  # can never match
            elif r["id"] not in lefts:
                left = lefts[r["id"]] = [r["at"], r["hash"], None, None, 0]
                changed.add(r["id"])
                self.handle.registerTimer(self._due(r["at"], self.window))
                self.handle.registerTimer(self._due(r["at"], self.horizon))
                for right in known:
                    self._meet(left, *right)
        for name in sorted(changed):
            left = lefts[name]
            if left[2] is not None:  # one row for all that this batch brought
                for right in known:
                    self._meet(left, *right)
                left[4] += 1
                yield self._verdict(key[:-1], name, left)
            self.lefts.updateValue((name,), tuple(left))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        lefts, rights = self._held()
        for name, left in sorted(lefts.items()):
            missing = left[4] == 0 and self._due(left[0], self.window) <= now
            if missing:
                left[4] = 1
                yield self._verdict(key[:-1], name, left)
            if self._due(left[0], self.horizon) <= now:
                self.lefts.removeKey((name,))
            elif missing:
                self.lefts.updateValue((name,), tuple(left))
        for right in rights:
            if self._due(right[0], self.horizon) <= now:
                self.rights.removeKey(right)

    def close(self) -> None:
        pass


def late_verdicts(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    left_time: str,
    right_time: str,
    left_hash: str,
    right_hash: str,
    window_seconds: int,
    grace_seconds: int,
    horizon_seconds: int | None = None,
    left_clock: str | None = None,
    right_clock: str | None = None,
    delay: str = "5 seconds",
) -> DataFrame:
    """Verdicts (keys, left_id, times, hashes, status, revision, is_correction) of each left row, as a stream of updates.

    A partner's time is within window + grace after the left row's. `left_id` names a left row; one that comes
    again while it is held counts once. The clocks, by default the rows' own times, carry the watermark: rows more than
    `delay` behind it are dropped by Spark and counted (`windows.late_rows`). With an arrival time as
    clock no row is late, and `horizon_seconds` (by default window + grace) says how long after its own time a
    row waits for partners that were delayed on the way. Rows without a key or time are missing at once.
    Needs the RocksDB state store.
    """
    second = 1_000_000
    window, bound = window_seconds * second, (window_seconds + grace_seconds) * second
    horizon = max(bound, (horizon_seconds or 0) * second)
    at = lambda name: F.unix_micros(F.col(name).cast("timestamp"))
    slot = lambda micros: F.floor(micros / F.lit(max(bound, 1))).cast("bigint")

    def side(df: DataFrame, is_left: bool, moment: str, digest: str, clock: str | None, name: Column, place: Column) -> DataFrame:
        return df.select(
            *keys, F.lit(is_left).alias("is_left"), name.cast("string").alias("id"), at(moment).alias("at"), F.col(digest).alias("hash"),
            F.coalesce(F.col(clock or moment).cast("timestamp"), F.timestamp_seconds(F.lit(0))).alias("clock"), place.alias("slot"),
        )

    whole = lambda moment: F.col(moment).isNotNull() & F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull()
    lane = F.pmod(F.xxhash64(left_id), F.lit(LANES))  # rows that cannot match: many groups
    lefts = side(left, True, left_time, left_hash, left_clock, F.col(left_id), F.when(whole(left_time), slot(at(left_time))).otherwise(lane))
    both = F.explode(F.array_distinct(F.array(slot(at(right_time) - bound), slot(at(right_time)))))
    rights = side(right.where(whole(right_time)), False, right_time, right_hash, right_clock, F.lit(None), both)
    live = lefts.unionByName(rights).withWatermark("clock", delay)

    fields = StructType([*[left.schema[k] for k in keys], *StructType.fromDDL(f"id string, {VERDICT}").fields])
    found = live.groupBy(*keys, "slot").transformWithState(LateVerdicts(fields.names, window, bound, horizon), fields, "Update", "EventTime")
    moment = lambda name: F.timestamp_micros(name).alias(name)
    return found.select(
        *keys, F.col("id").cast(left.schema[left_id].dataType).alias(left_id), moment("left_at"), "left_hash", moment("right_at"), "right_hash",
        "status", "revision", "is_correction",
    )


def last_verdicts(verdicts: DataFrame, left_id: str) -> DataFrame:
    """The verdict of each left row that holds, from all that were put out."""
    rest = [c for c in verdicts.columns if c not in (left_id, "revision")]
    return verdicts.groupBy(left_id).agg(F.max(F.struct("revision", *rest)).alias("last")).select(left_id, "last.*")
