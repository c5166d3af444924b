"""Quality counters, ratios and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowwarden.functions import checks
from rowwarden.operators import metrics, rules
from rowwarden.plans import inputs
from rowwarden.plans.reconciliation import V0, V1, sides
from rowwarden.plans.registry import query
from rowwarden.plans.rulesets import STATUS_SQL, checked
from rowwarden.sources import tables

_PASS = "CASE WHEN id IS NULL OR val < 0 OR event_ts IS NULL THEN FALSE ELSE TRUE END"


def judged(spark, folder):
    """Dirty events with their PASS / FAIL_… status."""
    status = checks.pass_fail(F.col("id"), F.col("val"), F.col("event_ts"))
    return inputs.dirty_events(spark, folder).select("event_id", "event_type", "event_ts", status.alias("dq_status"))


@query(f"SELECT {STATUS_SQL} AS dq_status, count(*) AS total FROM de GROUP BY 1", ("de",))
def count_by_status(spark, folder):
    return metrics.count_by(checked(spark, folder), "dq_status")


_JOINED = "FROM op LEFT JOIN cl ON op.pk = cl.pk"
# conditions of the rules of site_rules_v1.yaml that are counted, by metric
V1_SQL = {
    "differing": "status = 'F' AND hash_onprem <> hash_cloud",
    "unknown_change": "action = 'NOOP'",
    "not_copied": "cl.pk IS NULL AND amount > 100000",
    "slow_copies": "arrival_ts > event_ts + INTERVAL 12 SECOND",
}
COUNTERS = list(V1_SQL)


def _v1_counts(prefix="", suffix=""):
    return ", ".join(f"count(*) FILTER ({test}) AS {prefix}{name}{suffix}" for name, test in V1_SQL.items())


@query(
    f"""SELECT count(*) FILTER (op.pk IS NULL) AS orders_without_key,
      count(*) FILTER (NOT regexp_matches(hash_onprem, '^[a-f0-9]{{64}}$')) AS digests_not_hex,
      count(*) FILTER (action = 'DELETE') AS orders_cancelled, count(*) FILTER (hash_onprem <> hash_cloud) AS copies_differ,
      count(*) FILTER (hash_onprem = hash_cloud AND cloud_ts > event_ts + INTERVAL 20 MINUTE) AS late_copies,
      count(*) FILTER (hash_onprem = hash_cloud) AS copies_agree
    {_JOINED}""",
    ("op", "cl"),
)
def rule_metrics(spark, folder):
    """Rows per rule condition, independent of which rule gave the status."""
    return sides(spark, folder).agg(*rules.emit_metrics(rules.emit_rules(V0)))


@query(
    f"""SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start, 'staging' AS env, 'plant' AS dc, 'orders' AS table_name,
      'shop.orders.changes' AS topic_name, {_v1_counts('"checks.orders.', '"')}
    {_JOINED} GROUP BY 1""",
    ("op", "cl"),
)
def tumbling_tagged_metrics(spark, folder):
    document = rules.read_document(V1)
    site = document["sources"]["onprem"]
    tags = {"env": document["metadata"]["env"], "dc": site["dc"], "table_name": site["table"], "topic_name": site["topic"]}
    counts = rules.emit_metrics(rules.emit_rules(V1), document["metrics"]["namespace"])
    return metrics.tumbling(sides(spark, folder), "t1.event_ts", document["metrics"]["window"], counts, tags)


def _counter_sql(name, test):
    return f"""SELECT 'cloud_dq_job' AS job_name, time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS metric_ts, count(*) AS {name}
    FROM de WHERE {test} {_PASS} GROUP BY 2"""


def _counter(spark, folder, condition, name):
    counted = metrics.window_counter(judged(spark, folder), "event_ts", "1 minute", condition, name)
    return counted.select(F.lit("cloud_dq_job").alias("job_name"), "metric_ts", name)


@query(_counter_sql("valid_count", ""), ("de",))
def valid_counter(spark, folder):
    return _counter(spark, folder, F.col("dq_status") == "PASS", "valid_count")


@query(_counter_sql("invalid_count", "NOT"), ("de",))
def invalid_counter(spark, folder):
    return _counter(spark, folder, F.col("dq_status") != "PASS", "invalid_count")


@query(
    f"""SELECT count(*) FILTER (({V1_SQL["differing"]}) OR ({V1_SQL["not_copied"]})) AS dq_error_total,
      count(*) FILTER ({V1_SQL["unknown_change"]}) AS dq_warn_total, count(*) FILTER ({V1_SQL["slow_copies"]}) AS dq_info_total {_JOINED}""",
    ("op", "cl"),
)
def severity_totals(spark, folder):
    return sides(spark, folder).agg(*rules.severity_totals(rules.emit_rules(V1)))


@query(
    """WITH x AS (SELECT event_type, val, time_bucket(INTERVAL 30 SECONDS, event_ts) AS slot FROM de WHERE event_ts IS NOT NULL AND val IS NOT NULL),
    w AS (SELECT event_type, val, slot AS window_start FROM x UNION ALL SELECT event_type, val, slot - INTERVAL 30 SECONDS FROM x)
    SELECT event_type, window_start, window_start + INTERVAL 1 MINUTE AS window_end, count(*) AS n, round(avg(val), 6) AS mean,
      round(greatest(var_pop(val), 1e-9), 8) AS variance, round(sqrt(greatest(var_pop(val), 1e-9)), 6) AS stddev
    FROM w GROUP BY 1, 2""",
    ("de",),
)
def window_stats(spark, folder):
    stats = metrics.window_stats(
        inputs.dirty_events(spark, folder), ["event_type"], "event_ts", "val", "1 minute", "30 seconds"
    )
    return stats.withColumns({c: F.round(c, n) for c, n in (("mean", 6), ("variance", 8), ("stddev", 6))})


@query(
    f"""SELECT window_start, valid_count, invalid_count, round(invalid_count / (valid_count + 1), 6) AS breach_ratio,
      round(invalid_count / (valid_count + invalid_count), 6) AS invalid_share FROM (
      SELECT time_bucket(INTERVAL 60 SECONDS, event_ts) AS window_start, count(*) FILTER ({_PASS}) AS valid_count,
        count(*) FILTER (NOT {_PASS}) AS invalid_count FROM de GROUP BY 1)""",
    ("de",),
)
def invalid_ratio(spark, folder):
    return metrics.invalid_ratio(judged(spark, folder), "event_ts", "60 seconds", F.col("dq_status") == "PASS")


def _long_metrics(spark, folder, duration):
    """Counters of the two sites per window, one row per metric."""
    wide = metrics.tumbling(sides(spark, folder), "t1.event_ts", duration, rules.emit_metrics(rules.emit_rules(V1)))
    return metrics.long_form(wide, ["window_start"], COUNTERS)


_LONG_SQL = f"""SELECT window_start, metric_type, metric_value FROM (
      SELECT date_trunc('day', event_ts) AS window_start, {_v1_counts()} {_JOINED} GROUP BY 1)
      UNPIVOT (metric_value FOR metric_type IN ({", ".join(COUNTERS)}))"""


@query(
    f"""SELECT window_start, metric_type, metric_value, limit_value FROM ({_LONG_SQL})
    JOIN (VALUES ('not_copied', 0), ('differing', 1), ('unknown_change', 1)) t(metric_type, limit_value) USING (metric_type)
    WHERE metric_value > limit_value""",
    ("op", "cl"),
)
def alert_thresholds(spark, folder):
    """Counters above their limit; window and limits come from the rule document."""
    alerts = rules.read_document(V1)["alerts"]
    table = spark.createDataFrame(list(alerts["limits"].items()), "metric_type string, limit_value int")
    return metrics.breaches(_long_metrics(spark, folder, alerts["window"]), table)


@query(
    f"""WITH m AS (SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS minute, count(*) AS n FROM de
      WHERE NOT {_PASS} GROUP BY 1)
    SELECT 'sum' AS alert, time_bucket(INTERVAL 10 MINUTES, minute) AS window_start, CAST(sum(n) AS DOUBLE) AS metric_value
    FROM m GROUP BY 2 HAVING sum(n) > 1
    UNION ALL SELECT 'avg', time_bucket(INTERVAL 5 MINUTES, minute), round(avg(n), 6) FROM m GROUP BY 2 HAVING avg(n) > 1""",
    ("de",),
)
def alert_windows(spark, folder):
    """Invalid rows over ten minutes, and per minute over five, above a limit of one."""
    found = metrics.window_alerts(judged(spark, folder), "event_ts", F.col("dq_status") != "PASS", 10, 1, 5, 1)
    return found.withColumn("metric_value", F.round("metric_value", 6))


@query(
    f"""WITH good AS (SELECT DISTINCT time_bucket(INTERVAL 5 MINUTES, event_ts) AS w FROM de WHERE event_ts IS NOT NULL AND {_PASS}),
    span AS (SELECT time_bucket(INTERVAL 5 MINUTES, min(event_ts)) AS a, time_bucket(INTERVAL 5 MINUTES, max(event_ts)) AS b FROM de)
    SELECT w AS window_start FROM (SELECT unnest(generate_series(a, b, INTERVAL 5 MINUTES)) AS w FROM span) WHERE w NOT IN (SELECT w FROM good)""",
    ("de",),
)
def alert_stalled(spark, folder):
    """Five-minute windows without one valid row."""
    return metrics.stalled_windows(judged(spark, folder), "event_ts", 5, F.col("dq_status") == "PASS")


@query(
    f"""WITH h AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTES, event_ts) AS w, bool_or({_PASS}) AS ok FROM de WHERE event_ts IS NOT NULL GROUP BY ALL),
    n AS (SELECT *, coalesce(lead(w) OVER (PARTITION BY event_type ORDER BY w), TIMESTAMP '2024-01-31') AS e FROM h)
    SELECT event_type, w AS window_start FROM n WHERE NOT ok
    UNION ALL SELECT event_type, unnest(generate_series(w + INTERVAL 5 MINUTES, least(e - INTERVAL 5 MINUTES, w + INTERVAL 30 MINUTES), INTERVAL 5 MINUTES)) FROM n""",
    ("de",),
)
def alert_stalled_keys(spark, folder):
    """Five-minute windows in which a kind of event had no valid row, as long as it is watched: half an hour after its last row."""
    return metrics.stalled_by_key(judged(spark, folder), ["event_type"], "event_ts", 5, F.col("dq_status") == "PASS", 6, inputs.as_of())


@query(
    f"""SELECT 'dq_job' AS job_name, window_start AS metric_ts, metric_type, metric_value
    FROM ({_LONG_SQL})""",
    ("op", "cl"),
)
def metrics_long(spark, folder):
    long = _long_metrics(spark, folder, "1 day")
    return long.select(F.lit("dq_job").alias("job_name"), F.col("window_start").alias("metric_ts"), "metric_type", "metric_value")


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, folder):
    return metrics.duplicates(tables.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    f"""SELECT event_type, count(*) AS total, count(*) FILTER (NOT {_PASS}) AS errors,
      round(count(*) FILTER (NOT {_PASS}) * 100 / count(*), 6) AS error_rate_pct,
      round((count(*) - count(*) FILTER (NOT {_PASS})) / count(*), 6) AS availability FROM de GROUP BY 1""",
    ("de",),
)
def error_rate_slo(spark, folder):
    return metrics.error_rate(judged(spark, folder), ["event_type"], F.col("dq_status") != "PASS")


@query(
    f"""SELECT count(*) AS records_total, count(*) FILTER ({_PASS}) AS records_pass, count(*) FILTER (NOT {_PASS}) AS records_fail FROM de""",
    ("de",),
)
def dq_summary(spark, folder):
    ok = F.col("dq_status") == "PASS"
    return judged(spark, folder).agg(
        F.count(F.lit(1)).alias("records_total"),
        F.count_if(ok).alias("records_pass"),
        F.count_if(~ok).alias("records_fail"),
    )


@query(
    """SELECT word, count(*) AS count FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1"""
)
def word_count(spark, folder):
    return metrics.word_counts(tables.table(spark, folder, "documents"), "text")


@query("SELECT user_id, event_type, CAST(sum(event_id % 5) AS BIGINT) AS counter_value FROM events GROUP BY ALL")
def counter_accumulate(spark, folder):
    """Counter increments summed by key."""
    steps = inputs.events(spark, folder).withColumn("delta", F.col("event_id") % 5)
    return steps.groupBy("user_id", "event_type").agg(F.sum("delta").alias("counter_value"))


@query(
    """SELECT lower(w) AS word, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS "count" FROM (
      SELECT ts, unnest(string_split_regex(event_type || ' seen by U' || CAST(user_id % 50 AS VARCHAR), '\\s')) AS w FROM events)
    WHERE w <> '' GROUP BY 1, 2"""
)
def word_count_windowed(spark, folder):
    """Words of a line per event, counted per hour."""
    line = F.concat("event_type", F.lit(" seen by U"), (F.col("user_id") % 50).cast("string"))
    events = inputs.events(spark, folder).select("ts", line.alias("line"))
    return metrics.word_counts(events, "line", "ts", "1 hour")
