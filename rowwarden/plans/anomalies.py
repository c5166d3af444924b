"""Duplicates and per-key anomaly detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowwarden.functions import checks, jsontext
from rowwarden.operators import anomaly, keyed, metrics, schema
from rowwarden.plans import inputs
from rowwarden.plans.registry import query
from rowwarden.plans.rulesets import DECLARED, _FAULTS_SQL
from rowwarden.sources import parse, tables

ORDER = ["ts", "event_id"]


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
      THEN 'FAIL' ELSE 'PASS' END AS duplicate_check FROM lineitem"""
)
def duplicate_flag(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return metrics.duplicate_flag(lines, ["l_orderkey", "l_linenumber"])


@query(
    """SELECT pk, ts, max(event_id) AS event_id FROM (
      SELECT user_id AS pk, ts, event_id FROM events UNION ALL SELECT user_id, ts, event_id FROM events WHERE event_type = 'click') GROUP BY 1, 2"""
)
def dedup_pk_ts(spark, folder):
    """Messages delivered again are dropped by key and time; clicks arrive twice here."""
    events = inputs.events(spark, folder).select(F.col("user_id").alias("pk"), "ts", "event_id")
    again = inputs.events(spark, folder).where("event_type = 'click'").select(F.col("user_id").alias("pk"), "ts", "event_id")
    return keyed.latest_by_key(events.unionByName(again), ["pk", "ts"], ["event_id"])


@query(
    """WITH s AS (SELECT event_id, user_id, value, coalesce(avg(value) OVER w, 0) AS m, coalesce(stddev_samp(value) OVER w, 0) AS sd FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, user_id, round(CASE WHEN sd > 0 THEN (value - m) / sd ELSE 0 END, 4) AS z,
      sd > 0 AND abs((value - m) / sd) > 3 AS is_anomaly FROM s"""
)
def zscore_running(spark, folder):
    events = inputs.events(spark, folder).select("event_id", "user_id", "ts", "value")
    return anomaly.zscore(events, "user_id", ORDER, "value").select(
        "event_id", "user_id", F.round("z", 4).alias("z"), "is_anomaly"
    )


def ewma_sql(alpha, source, key="user_id", order="ts, event_id"):
    """Recursion over the ordered list of each key, one state per row."""
    a, b = alpha, f"(1 - {alpha})"
    return f"""l AS (SELECT {key} AS k, list(value ORDER BY {order}) AS vs, list(event_id ORDER BY {order}) AS ids FROM {source} GROUP BY 1),
    u AS (SELECT k, unnest(ids) AS event_id, unnest(vs) AS v, generate_subscripts(ids, 1) AS pos FROM l),
    r AS (SELECT k, event_id, v, pos, ema, var, 0.0::DOUBLE AS z FROM (SELECT *, v AS ema, 0.0::DOUBLE AS var FROM u WHERE pos = 1)
      UNION ALL
      SELECT k, event_id, v, pos, ema, var, (v - ema) / (sqrt(var + 1e-9) + 1e-9) FROM (
        SELECT u.k, u.event_id, u.v, u.pos, {a} * u.v + {b} * r.ema AS ema, {b} * r.var + {a} * (u.v - r.ema) * (u.v - r.ema) AS var
        FROM r JOIN u ON u.k IS NOT DISTINCT FROM r.k AND u.pos = r.pos + 1))"""


def scan(spark, folder, alpha=0.2, threshold=4.0):
    events = inputs.events(spark, folder).select("event_id", "user_id", "ts", "event_type", "value")
    return anomaly.ewma(events, "user_id", ORDER, "value", alpha, threshold)


@query(
    f"""WITH RECURSIVE {ewma_sql(0.2, 'events')}
    SELECT event_id, k AS user_id, round(ema, 6) AS ema, round(var, 6) AS ewvar, round(abs(z), 6) AS z, abs(z) > 4.0 AS is_anomaly FROM r"""
)
def ewma_anomaly(spark, folder):
    return scan(spark, folder).select(
        "event_id", "user_id", F.round("ema", 6).alias("ema"), F.round("ewvar", 6).alias("ewvar"), F.round("z", 6).alias("z"), "is_anomaly"
    )


@query(
    f"""WITH RECURSIVE s AS (SELECT event_id, event_ts AS ts, coalesce(CASE WHEN event_id % 50 <> 0 THEN 'u' || user_id END, '__global') AS key,
      coalesce(val, 0.0) AS value FROM de),
    {ewma_sql(0.1, 's', 'key', 'ts NULLS LAST, event_id')}
    SELECT event_id, k AS key, round(z, 6) AS z, abs(z) > 3.0 AS is_anomaly FROM r""",
    ("de",),
)
def ewma_anomaly_signed(spark, folder):
    """Shared key for rows without one, 0 for a missing value, z with its sign; rows without a time come last."""
    rows = inputs.dirty_events(spark, folder).select(
        "event_id",
        F.col("event_ts").isNull().alias("untimed"),
        F.col("event_ts").alias("ts"),
        F.when(F.col("id").isNotNull(), F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("key"),
        F.col("val").alias("value"),
    )
    scanned = anomaly.ewma_lenient(rows, "key", ["untimed", *ORDER], "value")
    return scanned.select("event_id", "key", F.round("z", 6).alias("z"), "is_anomaly")


@query(
    f"""WITH RECURSIVE {ewma_sql(0.2, 'events')}
    SELECT k AS user_id, event_id, round(ema, 6) AS ema, round(var, 6) AS ewvar FROM r
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY pos DESC) = 1"""
)
def ewma_last_state(spark, folder):
    last = anomaly.last_state(scan(spark, folder), "user_id", ORDER)
    return last.select("user_id", "event_id", F.round("ema", 6).alias("ema"), F.round("ewvar", 6).alias("ewvar"))


# z of an EWMA stays below (1 - alpha) / sqrt(alpha): 4.2 here, so 2.5 can be passed.
ALPHA, THRESHOLD = 0.05, 2.5


@query(
    f"""WITH RECURSIVE {ewma_sql(ALPHA, 'events')}
    SELECT r.event_id, k AS user_id, v AS value, round(abs(z), 6) AS z, ts FROM r JOIN events USING (event_id)
    WHERE abs(z) > {THRESHOLD} AND event_type <> 'error'"""
)
def anomaly_feed(spark, folder):
    """{{key, value, z, time}} of valid and anomalous rows; error events count as invalid."""
    found = anomaly.feed(scan(spark, folder, ALPHA, THRESHOLD), F.col("event_type") != "error")
    return found.select("event_id", "user_id", "value", F.round("z", 6).alias("z"), "ts")


_ERRORS = f"""concat_ws('; ', CASE WHEN j IS NULL THEN 'no JSON object' END, CASE WHEN j IS NOT NULL THEN nullif({_FAULTS_SQL}, '') END,
  CASE WHEN j IS NOT NULL AND coalesce(json_type(j, '$.id'), 'NULL') = 'NULL' THEN 'id: null' END,
  CASE WHEN json_type(j, '$.email') = 'VARCHAR' AND NOT regexp_full_match(json_extract_string(j, '$.email'), '[^@ ]+@[^@ ]+') THEN 'email: odd shape' END,
  CASE WHEN vt IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND CAST(vs AS DOUBLE) < 0 THEN 'value: below zero' END)"""


@query(
    f"""WITH RECURSIVE m AS (SELECT event_id, ts, {_ERRORS} AS errors, json_extract_string(j, '$.id') AS key,
      CASE WHEN vt IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(vs AS DOUBLE) END AS value FROM rawj),
    feed AS (SELECT * FROM m WHERE key IS NOT NULL AND value IS NOT NULL),
    {ewma_sql(ALPHA, 'feed', 'key')}
    SELECT m.event_id, coalesce(m.key, '') AS key, errors, errors = '' AS is_valid, coalesce(abs(z) > {THRESHOLD}, FALSE) AS is_anomaly,
      CASE WHEN errors <> '' THEN 'dead_letter' WHEN coalesce(abs(z) > {THRESHOLD}, FALSE) THEN 'anomalies' ELSE 'table' END AS output
    FROM m LEFT JOIN r ON r.event_id = m.event_id""",
    ("rawj",),
)
def advanced_quality_flow(spark, folder):
    """Parse, schema check, rules, EWMA per key, and the output each message goes to."""
    return advanced_flow(inputs.raw_messages(spark, folder))


def checked_messages(raw, keep=()):
    """Messages with errors, key and number: everything before the anomaly state."""
    docs = parse.messages(raw, "raw", list(DECLARED), ["event_id", "ts", *keep]).select(
        "event_id",
        "ts",
        *keep,
        "malformed",
        jsontext.text("id").alias("key"),
        jsontext.number("value").alias("value"),
        jsontext.text("email").alias("email"),
        F.when(F.col("malformed"), parse.MALFORMED).otherwise(F.nullif(schema.fault_text(DECLARED), F.lit(""))).alias("faults"),
        jsontext.given("id").alias("has_id"),
    )
    errors = F.concat_ws(
        "; ",
        "faults",
        F.when(~F.col("malformed") & ~F.coalesce("has_id", F.lit(False)), "id: null"),
        F.when(checks.not_like(F.col("email"), "[^@ ]+@[^@ ]+", "full"), "email: odd shape"),
        F.when(checks.outside(F.col("value"), 0), "value: below zero"),
    )
    return docs.select("event_id", "ts", "key", "value", errors.alias("errors"), *keep)


def advanced_flow(raw):
    scanned = anomaly.ewma(checked_messages(raw), "key", ORDER, "value", ALPHA, THRESHOLD, stage=True)
    valid = F.col("errors") == ""
    output = checks.first_match([(~valid, "dead_letter"), (F.col("is_anomaly"), "anomalies")], "table")
    return scanned.select(
        "event_id", F.coalesce("key", F.lit("")).alias("key"), "errors", valid.alias("is_valid"), "is_anomaly", output.alias("output")
    )
