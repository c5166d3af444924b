"""Comparison of the on-prem and the cloud copy."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowwarden.operators import joins, keyed, metrics, ordered, reconcile, rules, sketches
from rowwarden.plans import inputs
from rowwarden.plans.registry import CONFIG, query
from rowwarden.session import checkpoint_dir
from rowwarden.sources import bucketed, tables

_DRIFT = """CASE WHEN op.hash_onprem IS NULL AND cl.hash_cloud IS NULL THEN 'MISSING_BOTH'
  WHEN op.hash_onprem IS NULL THEN 'MISSING_IN_ONPREM' WHEN cl.hash_cloud IS NULL THEN 'MISSING_IN_AZURE'
  WHEN op.hash_onprem <> cl.hash_cloud THEN 'DRIFT' ELSE 'OK' END"""


def drift(spark, folder):
    return reconcile.full_outer(
        inputs.onprem(spark, folder), inputs.cloud(spark, folder), "pk", "hash_onprem", "hash_cloud"
    )


@query(
    f"""SELECT coalesce(CAST(coalesce(op.pk, cl.pk) AS VARCHAR), '') AS id, op.hash_onprem AS onprem_hash, cl.hash_cloud AS azure_hash,
      {_DRIFT} AS reconciliation_status FROM op FULL JOIN cl ON op.pk = cl.pk""",
    ("op", "cl"),
)
def reconcile_full_outer(spark, folder):
    return drift(spark, folder).select(
        F.coalesce(F.col("pk").cast("string"), F.lit("")).alias("id"), "onprem_hash", "azure_hash", "reconciliation_status"
    )


@query(
    f"""SELECT coalesce(CAST(pk AS VARCHAR), '') AS id, reconciliation_status FROM (
      SELECT coalesce(op.pk, cl.pk) AS pk, {_DRIFT} AS reconciliation_status FROM op FULL JOIN cl ON op.pk = cl.pk)
    WHERE reconciliation_status <> 'OK' ORDER BY pk NULLS FIRST, 2 LIMIT 200""",
    ("op", "cl"),
)
def drift_report(spark, folder):
    """The first 200 rows that drifted, those without a key first (the report's own limit)."""
    found = drift(spark, folder).where("reconciliation_status <> 'OK'")
    first = found.orderBy(F.asc_nulls_first("pk"), "reconciliation_status").limit(200)
    return first.select(F.coalesce(F.col("pk").cast("string"), F.lit("")).alias("id"), "reconciliation_status")


@query(
    """SELECT order_key, hash_onprem, hash_cloud, CASE WHEN hash_cloud IS NULL THEN 'MISSING_CLOUD'
      WHEN hash_onprem = hash_cloud THEN 'MATCH' ELSE 'MISMATCH' END AS dq_status
    FROM op LEFT JOIN cl ON op.pk = cl.pk""",
    ("op", "cl"),
)
def hash_check_left(spark, folder):
    checked = reconcile.left_check(
        inputs.onprem(spark, folder).select("order_key", "pk", "hash_onprem"),
        inputs.cloud(spark, folder),
        "pk",
        "hash_onprem",
        "hash_cloud",
    )
    return checked.select("order_key", "hash_onprem", "hash_cloud", "dq_status")


def _joined(spark, folder, *columns):
    cloud = inputs.cloud(spark, folder).select("pk", "hash_cloud", "cloud_ts").where("pk is not null")
    return joins.key_join(
        inputs.onprem(spark, folder).select("order_key", "pk", "hash_onprem", *columns),
        keyed.latest_by_key(cloud, ["pk"], ["cloud_ts", "hash_cloud"]).drop("cloud_ts"),
        ["pk"],
        "left",
    )


@query(
    """SELECT order_key, action, CASE WHEN action = 'DELETE' THEN 'DELETE_EVENT' WHEN cl.pk IS NULL THEN 'MISSING_CLOUD'
        WHEN hash_onprem <> hash_cloud THEN 'MISMATCH' ELSE 'MATCH' END AS dq_status,
      CASE WHEN action = 'DELETE' THEN 'source row is gone, digests not compared' WHEN cl.pk IS NULL THEN 'no cloud row for the key'
        WHEN hash_onprem <> hash_cloud THEN 'digests of the sites differ' ELSE 'OK' END AS dq_reason
    FROM op LEFT JOIN cl ON op.pk = cl.pk""",
    ("op", "cl"),
)
def results_delete_aware(spark, folder):
    judged = reconcile.delete_aware(_joined(spark, folder, "action"), "_r_pk", "hash_onprem", "hash_cloud")
    return judged.select("order_key", "action", "dq_status", "dq_reason")


def sides(spark, folder):
    """The two sites joined under the aliases the rule documents use."""
    t1, t2 = inputs.onprem(spark, folder).alias("t1"), inputs.cloud(spark, folder).alias("t2")
    return joins.aliased_left_join(t1, t2, "pk", "t1", "t2", ["cloud_ts", "hash_cloud"])


V0, V1, V2 = CONFIG / "site_rules.yaml", CONFIG / "site_rules_v1.yaml", CONFIG / "table_rules.yaml"

_BAD_HASH = "NOT regexp_matches(hash_onprem, '^[a-f0-9]{64}$')"
_V0_SQL = f"""CASE WHEN op.pk IS NULL THEN {{}} WHEN {_BAD_HASH} THEN {{}} WHEN action = 'DELETE' THEN {{}} WHEN cl.pk IS NULL THEN {{}}
  WHEN hash_onprem <> hash_cloud THEN {{}} WHEN hash_onprem = hash_cloud AND cloud_ts > event_ts + INTERVAL 20 MINUTE THEN {{}}
  WHEN hash_onprem = hash_cloud THEN {{}} ELSE {{}} END""".replace("{64}", "{{64}}")
_V0_STATUS = _V0_SQL.format("'MISSING_PK'", "'INVALID_HASH'", "'DELETE_EVENT'", "'MISSING_CLOUD'", "'MISMATCH'", "'MATCH'", "'MATCH'", "'VALID'")
_V0_REASON = _V0_SQL.format(
    "'order has no key to look up'", "'digest is not 64 hex digits'", "'order was cancelled at the source'", "'order never reached the cloud'",
    "'copies differ'", "'copies agree, the cloud one came late'", "'OK'", "'OK'",
)


@query(
    f"SELECT order_key, {_V0_STATUS} AS dq_status, {_V0_REASON} AS dq_reason FROM op LEFT JOIN cl ON op.pk = cl.pk",
    ("op", "cl"),
)
def reconcile_rules_v0(spark, folder):
    judged = reconcile.by_rules(sides(spark, folder), rules.emit_rules(V0))
    return judged.select("t1.order_key", "dq_status", "dq_reason")


@query(
    """SELECT order_key, CASE WHEN status = 'F' AND hash_onprem <> hash_cloud THEN 'MISMATCH' WHEN action = 'NOOP' THEN 'UNKNOWN_ACTION'
        WHEN cl.pk IS NULL AND amount > 100000 THEN 'MISSING_CLOUD' WHEN arrival_ts > event_ts + INTERVAL 12 SECOND THEN 'LATE' ELSE 'VALID' END AS dq_status
    FROM op LEFT JOIN cl ON op.pk = cl.pk""",
    ("op", "cl"),
)
def reconcile_rules_v1(spark, folder):
    judged = reconcile.by_rules(sides(spark, folder), rules.emit_rules(V1))
    return judged.select("t1.order_key", "dq_status")


# both sides of the tables of table_rules.yaml, in terms of their key, price, kind and day
_SIDES = {
    "lineitem": ("line_id", "concat_ws('/', l_orderkey, l_linenumber, l_partkey)", "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag"),
    "part": ("part_id", "CAST(p_partkey AS STRING)", "p_partkey", "p_size", "p_retailprice", "p_type"),
}


def _table_columns(name, sha, day):
    key_name, key, number, other, price, kind = _SIDES[name]
    far_price = f"CASE WHEN {other} % 13 = 0 THEN {price} + 25 WHEN {other} % 17 = 0 THEN {price} + 0.25 ELSE {price} END"
    far_kind = f"CASE WHEN {number} % 37 = 0 THEN 'Z' ELSE {kind} END"
    text = "concat_ws('|', {}, CAST(CAST({} AS DECIMAL(18,2)) AS STRING), {})"
    event = day.format(f"{number} % 500", "0")
    own = {key_name: key, "price": price, "kind": kind, "event_ts": event, "row_sum": sha.format(text.format(key, price, kind))}
    far = {
        key_name: f"CASE WHEN {number} % 41 = 0 THEN concat({key}, 'x') ELSE {key} END", "price": far_price, "kind": far_kind,
        "copied_at": day.format(f"{number} % 500", f"{other} % 60"), "far_sum": sha.format(text.format(key, far_price, far_kind)),
    }
    return own, far


def _list(columns):
    return [f"{e} AS {n}" for n, e in columns.items()]


# digests as bytes: they are compared and ordered as in hex, and are most of what is shuffled
_SPARK_TABLE = ("unhex(sha2({}, 256))", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, {}, 0) + make_dt_interval(0, {}, 0, 0)")
_DUCK_TABLE = ("sha256({})", "TIMESTAMP '2024-01-01 00:00:00' + to_minutes({}) + to_hours({})")


def each_table(spark, folder):
    """(table description, its rules, its joined sides) of every table in the document."""
    for pair in rules.table_pairs(V2):
        own, far = (tables.table(spark, folder, pair.name).selectExpr(*_list(c)) for c in _table_columns(pair.name, *_SPARK_TABLE))
        joined = joins.aliased_left_join(own, far, pair.pk, pair.onprem["alias"], pair.cloud["alias"], [pair.hash_cloud, "copied_at"])
        yield pair, rules.emit_rules(V2, pair), joined


def _table_sql(name, table_name, topic):
    own, far = _table_columns(name, *_DUCK_TABLE)
    key = _SIDES[name][0]
    last = f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY far_sum DESC, copied_at DESC) = 1"
    return f"""SELECT '{name}' AS table_name, '{table_name}' AS source_table, '{topic}' AS topic_name, a.{key} AS pk, event_ts,
      a.price AS price, b.price AS far_price, a.kind AS kind, b.kind AS far_kind, copied_at, row_sum, far_sum, b.{key} AS far_pk
    FROM (SELECT {", ".join(_list(own))} FROM {name}) a
    LEFT JOIN (FROM (SELECT {", ".join(_list(far))} FROM {name}) {last}) b ON a.{key} = b.{key}"""


_TABLES_SQL = f"""WITH j AS ({_table_sql("lineitem", "lines", "works.lines")} UNION ALL {_table_sql("part", "parts", "works.parts")}),
k AS (SELECT *, coalesce(abs(price - far_price) > 0.01 * abs(price), FALSE) AS off, coalesce(kind <> far_kind, FALSE) AS moved,
    coalesce(copied_at > event_ts + INTERVAL 2 DAY, FALSE) AS slow, far_pk IS NULL AND price >= 1000 AS dear, coalesce(row_sum <> far_sum, FALSE) AS other FROM j)
"""


@query(
    _TABLES_SQL
    + """SELECT table_name, coalesce(pk, '') AS pk, CASE WHEN off THEN 'MISMATCH' WHEN moved THEN 'DRIFT' WHEN slow THEN 'LATE'
      WHEN dear THEN 'MISSING_CLOUD' WHEN other THEN 'DRIFT' ELSE 'VALID' END AS dq_status,
      CASE WHEN off THEN 'prices are more than a hundredth apart' WHEN moved THEN 'kind_moved' WHEN slow THEN 'the copy came more than two days later'
        WHEN dear THEN 'dear_row_not_copied' WHEN other THEN 'something else differs' ELSE 'OK' END AS dq_reason FROM k"""
)
def multi_table_results(spark, folder):
    """One rule set filled in for each table, their results side by side."""
    report = None
    for pair, rule_list, joined in each_table(spark, folder):
        judged = reconcile.by_rules(joined, rule_list).select(
            F.lit(pair.name).alias("table_name"),
            F.coalesce(F.col(f"{pair.onprem['alias']}.{pair.pk}").cast("string"), F.lit("")).alias("pk"),
            "dq_status",
            "dq_reason",
        )
        report = judged if report is None else report.unionByName(judged)
    return report


@query(
    _TABLES_SQL
    + """SELECT time_bucket(INTERVAL 10 SECONDS, event_ts) AS window_start, 'trial' AS env, 'works' AS dc, source_table AS table_name, topic_name,
      count(*) FILTER (off) AS price_off, count(*) FILTER (moved) AS kind_moved, count(*) FILTER (slow) AS copy_slow, count(*) FILTER (dear) AS dear_not_copied
    FROM k GROUP BY ALL"""
)
def multi_table_metrics(spark, folder):
    """Counts per rule condition, 10-second window and table; a rule without a metric is not counted."""
    report = None
    for pair, rule_list, joined in each_table(spark, folder):
        moment = f"{pair.onprem['alias']}.event_ts"
        tags = {
            "env": rules.read_document(V2)["metadata"]["env"], "dc": pair.onprem["dc"], "table_name": pair.onprem["table"], "topic_name": pair.onprem["topic"],
        }
        counted = metrics.tumbling(joined, moment, "10 seconds", rules.emit_metrics(rule_list), tags)
        report = counted if report is None else report.unionByName(counted)
    return report


_SITES = """WITH s AS (SELECT hash_onprem AS row_hash, 'ONPREM' AS site FROM op UNION ALL SELECT hash_cloud, 'CLOUD' FROM cl)
SELECT coalesce(row_hash, '') AS row_hash, count(DISTINCT site) AS site_count FROM s GROUP BY 1 HAVING count(DISTINCT site) """


def _membership(spark, folder):
    return reconcile.site_membership(
        {
            "ONPREM": inputs.onprem(spark, folder).select(F.coalesce("hash_onprem", F.lit("")).alias("row_hash")),
            "CLOUD": inputs.cloud(spark, folder).select(F.coalesce("hash_cloud", F.lit("")).alias("row_hash")),
        },
        "row_hash",
    )


@query(_SITES + "> 1", ("op", "cl"))
def hash_on_both_sites(spark, folder):
    return _membership(spark, folder).where("site_count > 1")


@query(_SITES + "= 1", ("op", "cl"))
def hash_on_one_site(spark, folder):
    return _membership(spark, folder).where("site_count = 1")


def _left_interval(spark, folder, cloud_time, low, high):
    joined = joins.interval_join(
        inputs.onprem(spark, folder).select("order_key", "pk", "hash_onprem", "event_ts"),
        inputs.cloud(spark, folder).select("pk", "hash_cloud", cloud_time),
        ["pk"],
        "event_ts",
        cloud_time,
        low,
        high,
    )
    return joined.select("order_key", "event_ts", "hash_onprem", "hash_cloud")


@query(
    """SELECT order_key, event_ts, hash_onprem, hash_cloud FROM op LEFT JOIN cl ON op.pk = cl.pk
      AND arrival_ts BETWEEN event_ts AND event_ts + INTERVAL 10 SECOND""",
    ("op", "cl"),
)
def interval_left_10s(spark, folder):
    return _left_interval(spark, folder, "arrival_ts", 0, 10)


@query(
    """SELECT order_key, event_ts, hash_onprem, hash_cloud FROM op LEFT JOIN cl ON op.pk = cl.pk
      AND cloud_ts BETWEEN event_ts AND event_ts + INTERVAL 15 MINUTE""",
    ("op", "cl"),
)
def interval_left_grace(spark, folder):
    """Window of 10 minutes with 5 minutes of grace."""
    document = rules.read_document(V0)["join"]
    return _left_interval(spark, folder, "cloud_ts", 0, 60 * (document["size_minutes"] + document["grace_minutes"]))


def _full_interval(spark, folder, seconds):
    both = reconcile.interval_status(
        inputs.onprem(spark, folder).withColumnRenamed("hash_onprem", "onprem_hash"),
        inputs.cloud(spark, folder).withColumnRenamed("hash_cloud", "cloud_hash"),
        "pk",
        seconds,
        "event_ts",
        "cloud_ts",
    )
    return both.withColumn("id", F.coalesce(F.col("pk").cast("string"), F.lit(""))).drop("pk")


def _full_sql(minutes):
    return f"""SELECT coalesce(CAST(coalesce(op.pk, cl.pk) AS VARCHAR), '') AS id, hash_onprem AS onprem_hash, hash_cloud AS cloud_hash,
      CASE WHEN hash_onprem IS NULL THEN 'MISSING_ONPREM' WHEN hash_cloud IS NULL THEN 'MISSING_CLOUD'
        WHEN hash_onprem <> hash_cloud THEN 'DRIFT' ELSE 'MATCH' END AS status,
      coalesce(event_ts, cloud_ts) AS event_ts
    FROM op FULL JOIN cl ON op.pk = cl.pk AND cloud_ts >= event_ts - INTERVAL {minutes} MINUTE AND cloud_ts <= event_ts + INTERVAL {minutes} MINUTE"""


@query(_full_sql(1), ("op", "cl"))
def interval_full_1m(spark, folder):
    return _full_interval(spark, folder, 60)


@query(_full_sql(10), ("op", "cl"))
def interval_full_10m(spark, folder):
    return _full_interval(spark, folder, 600)


@query(
    """WITH j AS (SELECT order_key, event_ts, hash_onprem, hash_cloud, cloud_ts,
        row_number() OVER (PARTITION BY order_key ORDER BY cloud_ts, hash_cloud NULLS FIRST) AS n,
        coalesce(min(cloud_ts) OVER (PARTITION BY order_key) > event_ts + INTERVAL 10 MINUTE, TRUE) AS late
      FROM op LEFT JOIN cl ON op.pk = cl.pk AND cloud_ts BETWEEN event_ts AND event_ts + INTERVAL 15 MINUTE)
    SELECT order_key, hash_onprem, NULL::VARCHAR AS hash_cloud, 'MISSING_CLOUD' AS status, 1 AS revision, FALSE AS is_correction FROM j WHERE late AND n = 1
    UNION ALL SELECT order_key, hash_onprem, hash_cloud, CASE WHEN hash_onprem = hash_cloud THEN 'MATCH' ELSE 'MISMATCH' END,
      (n + late::INT)::INT, n + late::INT > 1 FROM j WHERE cloud_ts IS NOT NULL""",
    ("op", "cl"),
)
def verdict_history(spark, folder):
    """Verdicts as they are given and corrected: missing after 10 minutes, corrected by a row within 5 more."""
    document = rules.read_document(V0)["join"]
    return reconcile.verdict_history(
        inputs.onprem(spark, folder), inputs.cloud(spark, folder), ["pk"], "order_key", "event_ts", "cloud_ts", "hash_onprem", "hash_cloud",
        60 * document["size_minutes"], 60 * document["grace_minutes"],
    )


@query(
    """SELECT date_trunc('month', event_ts) AS month, count(*) AS matched, count(*) FILTER (cloud_ts > event_ts + INTERVAL 10 MINUTE) AS late,
      max(date_diff('second', event_ts, cloud_ts)) AS max_lag_seconds
    FROM op JOIN cl ON op.pk = cl.pk AND cloud_ts BETWEEN event_ts AND event_ts + INTERVAL 15 MINUTE GROUP BY 1""",
    ("op", "cl"),
)
def late_arrivals(spark, folder):
    """Matches that came after the 10-minute window but within its grace."""
    matched = joins.interval_join(
        inputs.onprem(spark, folder).select("pk", "event_ts"),
        inputs.cloud(spark, folder).select("pk", "cloud_ts"),
        ["pk"],
        "event_ts",
        "cloud_ts",
        0,
        900,
        "inner",
    )
    lag = F.timestamp_diff("SECOND", F.col("event_ts"), F.col("cloud_ts"))
    return (
        matched.select(F.date_trunc("month", "event_ts").cast("timestamp_ntz").alias("month"), lag.alias("lag"))
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("matched"),
            F.count_if(F.col("lag") > 600).alias("late"),
            F.max("lag").alias("max_lag_seconds"),
        )
    )


@query(
    f"SELECT * EXCLUDE (event_ts), TIMESTAMP '2024-01-31' AS audit_ts FROM ({_full_sql(10)}) WHERE status <> 'MATCH'", ("op", "cl")
)
def mismatch_audit(spark, folder):
    found = _full_interval(spark, folder, 600).where("status <> 'MATCH'").drop("event_ts")
    return found.withColumn("audit_ts", inputs.as_of())


@query("SELECT order_key, hash_onprem FROM op WHERE pk IN (SELECT pk FROM cl)", ("op", "cl"))
def matched_only(spark, folder):
    """Source rows that have a cloud row; every row is final, so an append-only sink takes it."""
    return (
        inputs.onprem(spark, folder)
        .join(inputs.cloud(spark, folder).select("pk"), "pk", "left_semi")
        .select("order_key", "hash_onprem")
    )


@query(
    """SELECT DISTINCT l_orderkey, l_suppkey, o_orderstatus FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey"""
)
def distinct_enriched(spark, folder):
    """Rows enriched by key, repeats dropped before the join they cannot change."""
    rows = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    orders = tables.table(spark, folder, "orders").selectExpr("o_orderkey AS l_orderkey", "o_orderstatus")
    return joins.key_join(rows, orders, ["l_orderkey"], "left").select("l_orderkey", "l_suppkey", "o_orderstatus")


@query(
    """SELECT 'customer' AS table_name, a.n AS onprem_rows, b.n AS cloud_rows, a.n - b.n AS difference
    FROM (SELECT count(*) AS n FROM customer) a, (SELECT count(DISTINCT o_custkey) AS n FROM orders) b
    UNION ALL SELECT 'orders', a.n, b.n, a.n - b.n
    FROM (SELECT count(*) AS n FROM orders) a, (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem) b"""
)
def rowcount_compare(spark, folder):
    """Tables against what arrived of them: customers with orders, orders with lines."""
    customer, orders, lines = (tables.table(spark, folder, n) for n in ("customer", "orders", "lineitem"))
    return reconcile.row_counts(
        {
            "customer": (customer, orders.select("o_custkey").distinct()),
            "orders": (orders, lines.select("l_orderkey").distinct()),
        }
    )


@query(
    """WITH s AS (SELECT 'onprem' AS side, c_acctbal AS v FROM snap_a UNION ALL SELECT 'cloud', c_acctbal FROM snap_b)
    SELECT side, count(*) AS n, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS stddev, round(quantile_cont(v, 0.25), 4) AS q25,
      round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.95), 4) AS q95 FROM s GROUP BY 1""",
    ("snap_a", "snap_b"),
)
def stats_compare(spark, folder):
    """Mean, spread and exact quantiles of both sides."""
    before, after = inputs.snapshots(spark, folder)
    both = before.select(F.lit("onprem").alias("side"), F.col("c_acctbal").alias("v")).unionByName(
        after.select(F.lit("cloud").alias("side"), F.col("c_acctbal").alias("v"))
    )
    moments = both.groupBy("side").agg(
        F.count("v").alias("n"), F.round(F.avg("v"), 4).alias("mean"), F.round(F.stddev_samp("v"), 4).alias("stddev")
    )
    names = {0.25: "q25", 0.5: "q50", 0.95: "q95"}
    points = (
        ordered.exact_quantiles(both, ["side"], "v", list(names))
        .groupBy("side")
        .agg(*[F.round(F.max(F.when(F.col("probability") == p, F.col("quantile"))), 4).alias(n) for p, n in names.items()])
    )
    return moments.join(points, "side")


@query(
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS source_changes, count(*) FILTER (l_orderkey IS NULL) AS missing_in_sink,
      round(1 - count(*) FILTER (l_orderkey IS NULL) / count(*), 6) AS completeness
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey GROUP BY 1"""
)
def cdc_completeness(spark, folder):
    """Orders by day that never reached the line items."""
    return reconcile.completeness(
        tables.table(spark, folder, "orders").select("o_orderkey", "o_orderdate"),
        tables.table(spark, folder, "lineitem"),
        "o_orderkey",
        "l_orderkey",
        F.to_date("o_orderdate"),
    )


@query(
    f"SELECT coalesce(op.pk, cl.pk) AS pk, {_DRIFT} AS reconciliation_status FROM (FROM op WHERE pk IS NOT NULL) op FULL JOIN cl ON op.pk = cl.pk",
    ("op", "cl"),
)
def bucketed_compare(spark, folder):
    """Both copies written by hashed key, and compared bucket by bucket without a shuffle."""
    names = []
    for name, rows in (("onprem", inputs.onprem(spark, folder).select("pk", "hash_onprem")), ("cloud", inputs.cloud(spark, folder).select("pk", "hash_cloud"))):
        names.append(f"{name}_{uuid.uuid4().hex}")
        bucketed.write_bucketed(rows.where("pk is not null"), names[-1], f"{checkpoint_dir(spark)}/{names[-1]}", ["pk"], 16)
    both = bucketed.joined(spark, *names, ["pk"])
    return both.select("pk", reconcile.drift_status(F.col("hash_onprem"), F.col("hash_cloud")).alias("reconciliation_status"))


@query(
    """WITH s AS (SELECT 'onprem' AS side, c_acctbal AS v FROM snap_a UNION ALL SELECT 'cloud', c_acctbal FROM snap_b)
    SELECT side, count(v) AS n, unnest([0.05, 0.25, 0.5, 0.95]::DOUBLE[]) AS probability, TRUE AS within_error FROM s GROUP BY 1""",
    ("snap_a", "snap_b"),
)
def quantile_sketches(spark, folder):
    """Quantiles of both sides from sketches of parts of them, and whether their ranks are as near as is stated."""
    before, after = inputs.snapshots(spark, folder)
    both = before.select(F.lit("onprem").alias("side"), "c_custkey", "c_acctbal").unionByName(after.select(F.lit("cloud").alias("side"), "c_custkey", "c_acctbal"))
    parts = sketches.quantile_sketches(both.withColumn("part", F.pmod("c_custkey", F.lit(5))), ["side", "part"], "c_acctbal")
    found = sketches.quantiles(sketches.merged_sketches(parts, ["side"]), ["side"], [0.05, 0.25, 0.5, 0.95])
    judged = sketches.off_by(both, ["side"], "c_acctbal", found.drop("n"))
    return found.select("side", "n", "probability").join(judged, ["side", "probability"]).select(
        "side", "n", "probability", (F.col("off") <= sketches.rank_error()).alias("within_error")
    )


@query(
    """WITH a AS (SELECT DISTINCT month(event_ts) AS m, hash_onprem AS h FROM op WHERE hash_onprem IS NOT NULL),
    b AS (SELECT DISTINCT month(cloud_ts) AS m, hash_cloud AS h FROM cl WHERE hash_cloud IS NOT NULL)
    SELECT coalesce(a.m, b.m) AS m, count(*) FILTER (a.h IS NOT NULL AND b.h IS NOT NULL) AS both, count(*) FILTER (b.h IS NULL) AS onprem_only,
      count(*) FILTER (a.h IS NULL) AS cloud_only, TRUE AS within_error FROM a FULL JOIN b ON a.m = b.m AND a.h = b.h GROUP BY 1""",
    ("op", "cl"),
)
def membership_sketches(spark, folder):
    """Digests per month that both sites or one of them hold: exact numbers, and whether those from sketches are as near as is stated."""
    a = inputs.onprem(spark, folder).select(F.month("event_ts").cast("bigint").alias("m"), F.col("hash_onprem").alias("h"))
    b = inputs.cloud(spark, folder).select(F.month("cloud_ts").cast("bigint").alias("m"), F.col("hash_cloud").alias("h"))
    made = [sketches.set_sketches(side, ["m"], "h").withColumnRenamed("sketch", name) for side, name in ((a, "sa"), (b, "sb"))]
    guessed = made[0].join(made[1], "m").select("m", *sketches.overlap(F.col("sa"), F.col("sb")))
    tagged = a.withColumn("site", F.lit(1)).unionByName(b.withColumn("site", F.lit(2))).where("h is not null")
    sites = tagged.groupBy("m", "h").agg(F.bit_or("site").alias("sites"))
    exact = sites.groupBy("m").agg(*[F.count_if(F.col("sites") == n).alias(c) for n, c in ((3, "both"), (1, "onprem_only"), (2, "cloud_only"))])
    near = lambda x, y: F.abs(F.col(x) - F.col(y)) <= sketches.overlap_error(F.col("either"))
    met = exact.join(guessed.withColumnRenamed("both", "guess"), "m")
    ok = near("both", "guess") & near("onprem_only", "first_only") & near("cloud_only", "second_only")
    return met.select("m", "both", "onprem_only", "cloud_only", ok.alias("within_error"))
