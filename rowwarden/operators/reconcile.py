"""Comparison of two copies of a keyed table or of two hash streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowwarden.functions import checks, hashing
from rowwarden.operators import joins, rules as rule_ops
from rowwarden.session import cut_lineage


def drift_status(onprem: Column, azure: Column) -> Column:
    return checks.first_match(
        [
            (onprem.isNull() & azure.isNull(), "MISSING_BOTH"),
            (onprem.isNull(), "MISSING_IN_ONPREM"),
            (azure.isNull(), "MISSING_IN_AZURE"),
            (onprem != azure, "DRIFT"),
        ],
        "OK",
    )


def match_status(onprem: Column, cloud: Column) -> Column:
    return checks.first_match(
        [(onprem.isNull(), "MISSING_ONPREM"), (cloud.isNull(), "MISSING_CLOUD"), (onprem != cloud, "DRIFT")],
        "MATCH",
    )


def latest_hash(side: DataFrame, key: str, row_hash: str, order: Sequence[str] = ()) -> DataFrame:
    """(key, row_hash) with one row per key: the last by `order`, the greatest hash among equals.

    Rows without a key are all kept. The aggregate combines on the map side, so a key repeated
    many times sends one row per task.
    """
    rows = side.select(F.col(key), F.struct(*order, F.col(row_hash).alias("_hash")).alias("_last"), *_lane(key))
    return rows.groupBy(key, "_lane").agg(F.max("_last").alias("_last")).select(key, F.col("_last._hash").alias(row_hash))


def _lane(key: str, side: int = 0) -> list[Column]:
    """0 for rows with a key; rows without one match nothing and get a number each."""
    own = F.monotonically_increasing_id() * 2 + side
    return [F.when(F.col(key).isNull(), own).otherwise(F.lit(0).cast("bigint")).alias("_lane")]


def full_outer(
    onprem: DataFrame,
    cloud: DataFrame,
    key: str,
    onprem_hash: str,
    cloud_hash: str,
    onprem_order: Sequence[str] = (),
    cloud_order: Sequence[str] = (),
) -> DataFrame:
    """(key, onprem_hash, azure_hash, reconciliation_status) of two keyed tables.

    Each side counts with one row per key, its last by the order columns. Both sides meet in one
    aggregate by key that combines on the map side: a repeated or hot key costs a row per task, and
    there is no full join to be skewed.
    """

    def tagged(df: DataFrame, row_hash: str, order: Sequence[str], number: int) -> DataFrame:
        last = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(row_hash).alias("_hash"))
        name, other = ("_a", "_b") if number == 0 else ("_b", "_a")
        return df.select(key, *_lane(key, number), last.alias(name), F.lit(None).alias(other))

    a, b = tagged(onprem, onprem_hash, onprem_order, 0), tagged(cloud, cloud_hash, cloud_order, 1)
    kinds = {"_a": a.schema["_a"].dataType, "_b": b.schema["_b"].dataType}
    both = a.withColumn("_b", F.col("_b").cast(kinds["_b"])).unionByName(b.withColumn("_a", F.col("_a").cast(kinds["_a"])))
    met = both.groupBy(key, "_lane").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    left, right = F.col("_a._hash"), F.col("_b._hash")
    return met.select(
        key, left.alias("onprem_hash"), right.alias("azure_hash"), drift_status(left, right).alias("reconciliation_status")
    )


def left_check(
    onprem: DataFrame, cloud: DataFrame, key: str, onprem_hash: str, cloud_hash: str, cloud_order: Sequence[str] = ()
) -> DataFrame:
    """Every source row with the last cloud digest of its key: MISSING_CLOUD, MATCH or MISMATCH."""
    held = latest_hash(cloud.where(F.col(key).isNotNull()), key, cloud_hash, cloud_order)
    both = joins.key_join(onprem, held, [key], "left")
    status = checks.first_match(
        [(F.col(cloud_hash).isNull(), "MISSING_CLOUD"), (F.col(onprem_hash) == F.col(cloud_hash), "MATCH")],
        "MISMATCH",
    )
    return both.drop(f"_r_{key}").withColumn("dq_status", status)


def delete_aware(joined: DataFrame, cloud_key: str, onprem_hash: str, cloud_hash: str) -> DataFrame:
    """Status and reason of a left join where a DELETE is never compared."""

    def verdict(status: str, reason: str) -> Column:
        return F.struct(F.lit(status).alias("dq_status"), F.lit(reason).alias("dq_reason"))

    outcome = checks.first_match(
        [
            (F.col("action") == "DELETE", verdict("DELETE_EVENT", "source row is gone, digests not compared")),
            (F.col(cloud_key).isNull(), verdict("MISSING_CLOUD", "no cloud row for the key")),
            (F.col(onprem_hash) != F.col(cloud_hash), verdict("MISMATCH", "digests of the sites differ")),
        ],
        verdict("MATCH", "OK"),
    )
    return joined.withColumn("_v", outcome).select("*", "_v.dq_status", "_v.dq_reason").drop("_v")


def action_status(joined: DataFrame, onprem_hash: str, cloud_hash: str, known: Sequence[str]) -> DataFrame:
    """Comparison by change type; an unknown change type is marked for the dead letters."""
    return joined.withColumn(
        "dq_status",
        checks.first_match(
            [
                (F.col("action") == "DELETE", "SKIPPED_DELETE"),
                (~F.coalesce(F.col("action").isin(list(known)), F.lit(False)), "UNKNOWN_ACTION"),
                (F.col(cloud_hash).isNull(), "MISSING_CLOUD"),
                (F.col(onprem_hash) == F.col(cloud_hash), "MATCH"),
            ],
            "MISMATCH",
        ),
    )


def interval_status(
    onprem: DataFrame, cloud: DataFrame, key: str, seconds: int, onprem_time: str, cloud_time: str
) -> DataFrame:
    """Full outer match of two digests whose times differ by at most `seconds`."""
    both = joins.interval_join(
        onprem.select(key, "onprem_hash", onprem_time),
        cloud.select(key, "cloud_hash", cloud_time),
        [key],
        onprem_time,
        cloud_time,
        -seconds,
        seconds,
        "full",
    )
    return both.select(
        F.coalesce(key, f"_r_{key}").alias(key),
        "onprem_hash",
        "cloud_hash",
        match_status(F.col("onprem_hash"), F.col("cloud_hash")).alias("status"),
        F.coalesce(onprem_time, cloud_time).alias("event_ts"),
    )


def by_rules(joined: DataFrame, rules: Sequence[rule_ops.Emit]) -> DataFrame:
    """Joined sides (aliased as the rules name them) with dq_status and dq_reason."""
    return joined.withColumn("_v", rule_ops.emitted(rules)).select("*", "_v.dq_status", "_v.dq_reason").drop("_v")


def site_membership(sides: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Number of sites each digest is found on.

    Sites are known, so each is a bit: one aggregate that combines on the map side
    instead of a distinct count with its second shuffle.
    """
    tagged = None
    for bit, side in enumerate(sides.values()):
        rows = side.select(column, F.lit(1 << bit).cast("bigint").alias("_site"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return tagged.groupBy(column).agg(F.bit_count(F.bit_or("_site")).cast("bigint").alias("site_count"))


DIGEST = [f"digest_{i}" for i in range(4)]


def segment_of(key: Column, segments: int) -> Column:
    """Segment of a key; rows without a key have the segment -1."""
    return F.coalesce(hashing.key_bucket(key, segments), F.lit(-1).cast("bigint"))


def segment_digest(side: DataFrame, segment: Column, key: Column, row_hash: Column) -> DataFrame:
    """Per segment the row count and an order-free digest of its rows.

    The digest binds each row digest to its key and sums all 256 bits as four decimals, so swapped
    hashes, one-sided nulls and malformed digests change it. Count and sums combine on the map
    side: a hot segment costs one row per task.
    """
    words = hashing.words(hashing.bound_digest(key, row_hash))
    rows = side.select(segment.alias("segment"), *[w.alias(n) for w, n in zip(words, DIGEST)])
    return rows.groupBy("segment").agg(
        F.count(F.lit(1)).alias("row_count"), *[F.sum(n).cast("decimal(38,0)").alias(n) for n in DIGEST]
    )


def differing_segments(left: DataFrame, right: DataFrame) -> DataFrame:
    """Segments of two digest tables that do not agree."""
    values = ["row_count", *DIGEST]
    tagged = left.select("segment", F.struct(*values).alias("a"), F.lit(None).cast(_struct_of(right, values)).alias("b")).unionByName(
        right.select("segment", F.lit(None).cast(_struct_of(left, values)).alias("a"), F.struct(*values).alias("b"))
    )
    met = tagged.groupBy("segment").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return met.where(~F.col("a").eqNullSafe(F.col("b"))).select("segment")


def _struct_of(df: DataFrame, names: Sequence[str]):
    return df.select(F.struct(*names).alias("s")).schema["s"].dataType


def drill_down(
    left: DataFrame, right: DataFrame, key: str, segments: int, left_hash: str, right_hash: str
) -> DataFrame:
    """Row reconciliation of those key segments only whose digests differ.

    Both sides are read and hashed once, into a staged table of (side, segment, key, hash); the
    digests come from it, and only its rows in differing segments are shuffled by key. Choose
    `segments` so that a segment holds some dozens of rows (see `segments_for`).
    """

    def staged(df: DataFrame, row_hash: str, number: int) -> DataFrame:
        return df.select(
            F.lit(number).alias("side"), segment_of(F.col(key), segments).alias("segment"), key, F.col(row_hash).alias("row_hash")
        )

    rows = cut_lineage(staged(left, left_hash, 0).unionByName(staged(right, right_hash, 1)))
    a, b = rows.where("side = 0"), rows.where("side = 1")
    digest = lambda df: segment_digest(df, F.col("segment"), F.col(key), F.col("row_hash"))
    open_segments = differing_segments(digest(a), digest(b))
    inside = rows.join(open_segments, "segment", "left_semi")
    return full_outer(inside.where("side = 0"), inside.where("side = 1"), key, "row_hash", "row_hash")


def segments_for(rows: int, rows_per_segment: int = 32) -> int:
    """Number of segments for a table of so many rows."""
    return max(1, -(-rows // rows_per_segment))


def row_counts(sides: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Counts of each table on both sites side by side."""
    report = None
    for name, (left, right) in sides.items():
        a = left.agg(F.count(F.lit(1)).alias("onprem_rows"), F.lit(0).cast("bigint").alias("cloud_rows"))
        b = right.agg(F.lit(0).cast("bigint").alias("onprem_rows"), F.count(F.lit(1)).alias("cloud_rows"))
        pair = a.unionByName(b).select(F.lit(name).alias("table_name"), "onprem_rows", "cloud_rows")
        report = pair if report is None else report.unionByName(pair)
    return (
        report.groupBy("table_name")
        .agg(F.sum("onprem_rows").alias("onprem_rows"), F.sum("cloud_rows").alias("cloud_rows"))
        .withColumn("difference", F.col("onprem_rows") - F.col("cloud_rows"))
    )


def completeness(source: DataFrame, sink: DataFrame, source_key: str, sink_key: str, day: Column) -> DataFrame:
    """Per day: source changes, those without a sink row, and the share that arrived.

    The sink keys are made distinct before the join, so a hot sink key is one row.
    """
    arrived = sink.select(F.col(sink_key).alias(source_key)).dropna().distinct()
    return (
        joins.key_join(source.withColumn("day", day), arrived, [source_key], "left")
        .groupBy("day")
        .agg(
            F.count(F.lit(1)).alias("source_changes"),
            F.count_if(F.col(f"_r_{source_key}").isNull()).alias("missing_in_sink"),
        )
        .withColumn("completeness", F.round(1 - F.col("missing_in_sink") / F.col("source_changes"), 6))
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, as_of: Column) -> DataFrame:
    """INSERTED / UPDATED / DELETED rows between two images of a keyed table.

    Gives the new row, or the old one for a delete, as a change-audit table would hold it. A column
    that only one image has is null in the other. A row without a key matches nothing: it is a
    delete in the old image and an insert in the new one. Both images meet in one aggregate by key.
    """
    columns = [c for c in before.columns if c != key] + [c for c in after.columns if c not in before.columns]
    kinds = {f.name: f.dataType for f in [*after.schema.fields, *before.schema.fields]}

    def image(df: DataFrame, number: int) -> DataFrame:
        cells = [(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns]
        return df.select(key, *_lane(key, number), F.struct(*cells).alias("row"), F.lit(number).alias("number"))

    both = image(before, 0).unionByName(image(after, 1))
    pick = lambda n: F.max_by("row", F.when(F.col("number") == n, F.lit(1)))
    there = lambda n: F.max(F.col("number") == n)
    met = both.groupBy(key, "_lane").agg(
        pick(0).alias("old"), pick(1).alias("new"), there(0).alias("was"), there(1).alias("is")
    )
    operation = (
        F.when(~F.col("was"), "INSERTED").when(~F.col("is"), "DELETED").when(~F.col("old").eqNullSafe(F.col("new")), "UPDATED")
    )
    kept = F.when(F.col("is"), F.col("new")).otherwise(F.col("old"))
    found = met.select(operation.alias("operation"), as_of.alias("stamp"), key, kept.alias("kept"))
    return found.where("operation is not null").select("operation", "stamp", key, *[F.col("kept")[c].alias(c) for c in columns])


def verdict_history(
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
) -> DataFrame:
    """Every verdict of each left row in event-time order: (left_id, hashes, status, revision, is_correction).

    A row without a partner within the window is first reported missing; each partner within window + grace
    then brings a verdict. The last one is what holds, as in `streaming.corrections.late_verdicts`.
    `left_id` names a left row.
    """
    joined = joins.interval_join(
        left.select(left_id, *keys, left_time, left_hash), right.select(*keys, right_time, right_hash), keys, left_time, right_time, 0, window_seconds + grace_seconds
    )
    per_row = Window.partitionBy(left_id)
    number = F.row_number().over(per_row.orderBy(right_time, right_hash))
    first = F.min(right_time).over(per_row)
    late = F.coalesce(first > F.col(left_time) + F.make_dt_interval(secs=F.lit(window_seconds)), F.lit(True))
    marked = joined.select(left_id, left_hash, right_hash, right_time, number.alias("_n"), late.alias("_late"))
    found = F.col(right_time).isNotNull()
    status = checks.first_match([(F.col(left_hash) == F.col(right_hash), "MATCH")], "MISMATCH")
    met = F.struct(F.col(right_hash), status.alias("status"), (F.col("_n") + F.col("_late").cast("int")).alias("revision"))
    missing = F.struct(F.lit(None).cast("string").alias(right_hash), F.lit("MISSING_CLOUD").alias("status"), F.lit(1).alias("revision"))
    rows = F.concat(F.when((F.col("_n") == 1) & F.col("_late"), F.array(missing)).otherwise(F.array()), F.when(found, F.array(met)).otherwise(F.array()))
    return marked.select(left_id, left_hash, F.inline(rows)).withColumn("is_correction", F.col("revision") > 1)
