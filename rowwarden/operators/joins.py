"""Equi-joins and time-bounded joins that hold up with null and hot keys."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rowwarden.operators.keyed import latest_by_key

SPREAD = "_spread"
SLOT = "_slot"
ROW, COPIES = "_row_id", "_copies"
LANES = 4096
WIDER = 8


def _row_hash(df: DataFrame) -> Column:
    names = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*names)


def _spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for rows with a full key; rows with a null key, which never match, go to many lanes.

    The 0 is written so that Spark keeps it as a join key. A side that was grouped by the
    keys is then shuffled once more, which is what lets AQE split a hot key of the other.
    """
    incomplete = reduce(operator.or_, [F.col(k).isNull() for k in keys])
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    return F.when(incomplete, F.pmod(_row_hash(df), F.lit(LANES))).otherwise(zero)


def key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join whose null-key rows do not all land in one task, and whose left side AQE can split.

    Column names other than the keys must differ. Left keys come out as they are,
    right keys as `_r_<key>`, so "no right row" can be told from "null value".
    The right side of a left join is meant to be one row per key (see
    `keyed.latest_by_key`), for a full join both sides are; use `many_to_many_full_join`
    when neither is.
    """
    l = left.withColumn(SPREAD, _spread(left, keys))
    r = right.withColumn("_r" + SPREAD, _spread(right, keys))
    for k in keys:
        r = r.withColumnRenamed(k, f"_r_{k}")
    on = [l[k] == r[f"_r_{k}"] for k in keys] + [l[SPREAD] == r["_r" + SPREAD]]
    return l.join(r, on, how).drop(SPREAD, "_r" + SPREAD)


def without_partner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose key the right side lacks; right keys are made distinct first."""
    held = right.select(*keys).dropna().distinct()
    return key_join(left, held, keys, "left_anti")


def many_to_many_full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join for sides that may both repeat a key.

    AQE cannot split a skewed full join, but it can split an inner join on either
    side and an anti join on its left, so the three row classes are made apart.
    """
    matched = key_join(left, right, keys, "inner")
    left_only = without_partner(left, right, keys)
    right_only = without_partner(right, left, keys)
    for k in keys:
        right_only = right_only.withColumnRenamed(k, f"_r_{k}")
    return matched.unionByName(left_only, allowMissingColumns=True).unionByName(right_only, allowMissingColumns=True)


def aliased_left_join(
    left: DataFrame, right: DataFrame, key: str, left_alias: str, right_alias: str, right_order: Sequence[str] | None = None
) -> DataFrame:
    """`key_join` that keeps `alias.column` names for rule texts.

    With `right_order` the right side counts with the last row of each key by those columns, so
    copies of a key never multiply the left rows; rows without a key match nothing and are left out.
    """
    if right_order is not None:
        right = latest_by_key(right.where(F.col(key).isNotNull()), [key], right_order)
    l = left.withColumn(SPREAD, _spread(left, [key])).alias(left_alias)
    r = right.withColumn(SPREAD, _spread(right, [key])).alias(right_alias)
    on = (F.col(f"{left_alias}.{key}") == F.col(f"{right_alias}.{key}")) & (
        F.col(f"{left_alias}.{SPREAD}") == F.col(f"{right_alias}.{SPREAD}")
    )
    return l.join(r, on, "left")


def _slot_of(micros: Column, width: int) -> Column:
    return F.floor(micros / F.lit(width)).cast("bigint")


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower_seconds: int,
    upper_seconds: int,
    how: str = "left",
) -> DataFrame:
    """Rows of equal keys with `right_time` in `left_time + [lower, upper]`.

    `how` is inner, left or full. Joining on the key alone would compare all rows of a
    hot key with each other. Time is cut in slots as wide as the bound instead: a left
    row is in its own slot, a right row in the one or two slots where its partners can
    be, and the join key is (key, slot). Each left row meets all its partners in one
    slot, so the left join needs no row id. A full join uses slots WIDER times as wide: few right rows
    are then in two slots, and of those that come out of both without a partner one is kept.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError("how must be inner, left or full")
    width = max(upper_seconds - lower_seconds, 1) * 1_000_000 * (WIDER if how == "full" else 1)
    low = F.make_dt_interval(secs=F.lit(lower_seconds))
    high = F.make_dt_interval(secs=F.lit(upper_seconds))
    low_us, high_us = lower_seconds * 1_000_000, upper_seconds * 1_000_000
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")

    def unplaced(df: DataFrame, names: Sequence[str]) -> Column:
        # null keys or times never match: any slot will do, so use many
        gap = reduce(operator.or_, [F.col(n).isNull() for n in names])
        return F.when(gap, F.pmod(_row_hash(df), F.lit(LANES)))

    def single(df: DataFrame, key_names: Sequence[str], moment: str) -> Column:
        return F.coalesce(unplaced(df, [*key_names, moment]), _slot_of(_micros(F.col(moment)), width))

    def slots_of(moment: str) -> Column:
        at = _micros(F.col(moment))
        return F.array_distinct(F.array(_slot_of(at - F.lit(high_us), width), _slot_of(at - F.lit(low_us), width)))

    def bound(l: DataFrame, r: DataFrame) -> list[Column]:
        return [
            *[l[k] == r[f"_r_{k}"] for k in keys],
            l[SLOT] == r["_r" + SLOT],
            r[right_time] >= l[left_time] + low,
            r[right_time] <= l[left_time] + high,
        ]

    right_keys = [f"_r_{k}" for k in keys]
    l = left.withColumn(SLOT, single(left, keys, left_time))
    if how != "full":
        placed = renamed.where(reduce(operator.and_, [F.col(n).isNotNull() for n in [*right_keys, right_time]]))
        r = placed.withColumn("_r" + SLOT, F.explode(slots_of(right_time)))
        return l.join(r, bound(l, r), how).drop(SLOT, "_r" + SLOT)
    own = unplaced(renamed, [*right_keys, right_time])
    slots = F.when(own.isNotNull(), F.array(own.cast("bigint"))).otherwise(slots_of(right_time))
    r = renamed.withColumn(ROW, F.monotonically_increasing_id()).withColumn(COPIES, slots)
    r = r.withColumn("_r" + SLOT, F.explode(COPIES)).withColumn(COPIES, F.size(COPIES))
    joined = l.join(r, bound(l, r), "full").drop("_r" + SLOT)
    in_doubt = F.col(SLOT).isNull() & (F.col(COPIES) > 1)  # a right row alone in one of its slots
    out = [c for c in joined.columns if c not in (SLOT, ROW, COPIES)]
    # a generated row: both parts ask the same of the join below it, so they share its shuffles
    rows = joined.select(F.inline(F.array(F.struct(*joined.columns))))
    certain = rows.where(~in_doubt).select(*out)
    alone = rows.where(in_doubt).groupBy(ROW).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*out)).alias("_row"))
    return certain.unionByName(alone.where("_n > 1").select("_row.*"))
