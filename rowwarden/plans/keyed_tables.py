"""Keyed-table semantics over change logs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowwarden.operators import changelog, digest_tree, keyed, reconcile
from rowwarden.plans import inputs
from rowwarden.plans.registry import query
from rowwarden.session import checkpoint_dir
from rowwarden.sources import parse, tables
from rowwarden.sources.keyed_store import KeyedStore

ENVELOPE = (
    "op string, ts_ms bigint, after struct<id:string,amount:double,event_ts:string>, "
    "source struct<keyspace:string,table_name:string,dc:string>"
)
_LAST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query(f"SELECT user_id, event_id, event_type, value, ts FROM events {_LAST}")
def upsert_latest(spark, folder):
    return keyed.latest_by_key(
        inputs.events(spark, folder).select("user_id", "event_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"]
    )


@query(
    """SELECT user_id, arg_max(a, (ts, event_id)) FILTER (a IS NOT NULL) AS a, arg_max(b, (ts, event_id)) FILTER (b IS NOT NULL) AS b,
      arg_max(c, (ts, event_id)) FILTER (c IS NOT NULL) AS c FROM part GROUP BY 1""",
    ("part",),
)
def upsert_ignore_nulls(spark, folder):
    return keyed.merge_partial(inputs.partial_updates(spark, folder), ["user_id"], ["ts", "event_id"], ["a", "b", "c"])


@query(
    """SELECT user_id, event_id, value FROM (SELECT *, ts - to_seconds(event_id % 7 * 3600) AS write_ts FROM events)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY write_ts DESC, event_id DESC) = 1"""
)
def upsert_lww(spark, folder):
    """The newest write time wins, whatever order the writes arrive in."""
    writes = inputs.events(spark, folder).select(
        "user_id", "event_id", "value", F.expr("ts - make_dt_interval(0, event_id % 7, 0, 0)").alias("write_ts")
    )
    return keyed.last_write_wins(writes, ["user_id"], "write_ts", ["event_id"]).select("user_id", "event_id", "value")


@query(
    """SELECT event_id, ts FROM (SELECT *, CASE WHEN event_id % 4 > 0 THEN event_id % 4 * 864000 END AS ttl FROM events)
    WHERE ttl IS NULL OR ts + to_seconds(ttl) > TIMESTAMP '2024-01-31'"""
)
def ttl_filter(spark, folder):
    rows = inputs.events(spark, folder).withColumn(
        "ttl", F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 4 * 864000)
    )
    return keyed.alive(rows, "ts", "ttl", inputs.as_of()).select("event_id", "ts")


@query(
    """SELECT c_custkey AS member_id, c_acctbal AS value FROM customer
    UNION ALL SELECT member_id, value FROM (FROM vis QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY ts, event_id) = 1)
    WHERE member_id NOT IN (SELECT c_custkey FROM customer)""",
    ("vis",),
)
def insert_if_absent(spark, folder):
    stored = tables.table(spark, folder, "customer").selectExpr("c_custkey AS member_id", "c_acctbal AS value")
    return keyed.insert_if_absent(stored, inputs.visits(spark, folder), ["member_id"], ["ts", "event_id"])


_STEPS = 3  # commits that the queries over a store are built in
_UPSERTS = "user_id bigint, event_id bigint, event_type string, value double, ts timestamp_ntz"


def _folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _merged(spark, name, schema, keys, order, rows, step, **options):
    """A store that has taken the rows in, `_STEPS` commits, and what follows it."""
    store = KeyedStore(spark, _folder(spark, name), schema, keys, order, **options)
    for v in range(_STEPS):
        yield store, v, store.merge(rows.where(step == v).select(*store.schema.names), v)


@query(f"SELECT user_id, event_id, event_type, value, ts FROM events {_LAST}")
def upsert_store(spark, folder):
    """The view of a bucketed store after several merges in which keys come again, late ones among them."""
    for store, _, _ in _merged(spark, "store", _UPSERTS, ["user_id"], ["ts", "event_id"], inputs.events(spark, folder), F.col("event_id") % _STEPS, buckets=16):
        pass
    return store.read()


@query(
    """SELECT event_type, value >= 50 AS large, count(*) AS n FROM (
      SELECT user_id, event_type, value, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    ) WHERE event_id % 5 > 0 GROUP BY ALL"""
)
def changelog_counts(spark, folder):
    """Counts over the latest rows, kept commit by commit from the changelog; a fifth of the messages are deletes."""
    counts = None
    by = {"event_type": F.col("event_type"), "large": F.col("value") >= 50}
    gone = lambda row: row("event_id") % 5 == 0
    for store, v, _ in _merged(
        spark, "counted", _UPSERTS, ["user_id"], ["ts", "event_id"], inputs.events(spark, folder), F.col("event_id") % _STEPS, buckets=16, deleted=gone
    ):
        counts = counts or changelog.KeptCounts(store, _folder(spark, "counts"), by)
        counts.follow(v)
    return counts.at(v)


@query(
    """SELECT coalesce(op.pk, cl.pk) AS pk, hash_onprem AS onprem_hash, hash_cloud AS azure_hash,
      CASE WHEN hash_onprem IS NULL THEN 'MISSING_IN_ONPREM' WHEN hash_cloud IS NULL THEN 'MISSING_IN_AZURE' ELSE 'DRIFT' END AS reconciliation_status
    FROM (FROM op WHERE pk IS NOT NULL) op FULL JOIN cl ON op.pk = cl.pk WHERE hash_onprem IS DISTINCT FROM hash_cloud""",
    ("op", "cl"),
)
def digest_tree_drift(spark, folder):
    """Rows that differ between two stores, found by their digests; both are filled in several commits."""
    stores = []
    for rows, digest, name in ((inputs.onprem(spark, folder), "hash_onprem", "onprem"), (inputs.cloud(spark, folder), "hash_cloud", "cloud")):
        rows = rows.select("pk", F.lit(0).alias("at"), F.col(digest).alias("row_hash"))
        for store, _, _ in _merged(
            spark, name, "pk bigint, at int, row_hash string", ["pk"], ["at"], rows, F.pmod("pk", F.lit(_STEPS)), buckets=16, leaves=4096, digest_columns=["row_hash"]
        ):
            pass
        stores.append(store)
    found = digest_tree.drift(*stores, "pk", "row_hash", "row_hash")
    return found.where("reconciliation_status not in ('OK', 'MISSING_BOTH')")


def changes(spark, folder):
    return parse.typed(inputs.change_envelopes(spark, folder), "envelope", ENVELOPE, keep=("event_id", "user_id", "ts"))


@query(
    """SELECT event_id, CAST(user_id AS VARCHAR) AS id, value AS amount, ts AS event_ts, ts_ms, 'azure' AS source_dc FROM cdc WHERE op IN ('c', 'u')""",
    ("cdc",),
)
def cdc_flatten(spark, folder):
    """Nested change envelopes to flat rows, deletes left out."""
    return (
        changes(spark, folder)
        .where(F.col("op").isin("c", "u"))
        .select(
            "event_id",
            F.col("after.id").alias("id"),
            F.col("after.amount").alias("amount"),
            F.col("after.event_ts").cast("timestamp_ntz").alias("event_ts"),
            "ts_ms",
            F.col("source.dc").alias("source_dc"),
        )
    )


@query(
    """WITH log AS (SELECT user_id, value AS amount, op, ts_ms, event_id FROM cdc
      UNION ALL SELECT c_custkey, c_acctbal, 'r', 0, -1 FROM customer)
    SELECT user_id, amount, op FROM (FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1) WHERE op <> 'd'""",
    ("cdc",),
)
def cdc_materialize(spark, folder):
    """Initial image, then the changes; the last operation of a key decides."""
    image = tables.table(spark, folder, "customer").selectExpr(
        "c_custkey AS user_id", "c_acctbal AS amount", "'r' AS op", "0L AS ts_ms", "-1L AS event_id"
    )
    log = changes(spark, folder).select("user_id", F.col("after.amount").alias("amount"), "op", "ts_ms", "event_id")
    return keyed.apply_changes(image, log, ["user_id"], ["ts_ms", "event_id"]).select("user_id", "amount", "op")


@query(
    """SELECT CASE WHEN a.c_custkey IS NULL THEN 'INSERTED' WHEN b.c_custkey IS NULL THEN 'DELETED' ELSE 'UPDATED' END AS operation,
      TIMESTAMP '2024-01-31' AS stamp, coalesce(b.c_custkey, a.c_custkey) AS c_custkey, coalesce(b.c_name, a.c_name) AS c_name,
      coalesce(b.c_acctbal, a.c_acctbal) AS c_acctbal
    FROM snap_a a FULL JOIN snap_b b ON a.c_custkey = b.c_custkey
    WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR a.c_name IS DISTINCT FROM b.c_name OR a.c_acctbal IS DISTINCT FROM b.c_acctbal""",
    ("snap_a", "snap_b"),
)
def snapshot_audit(spark, folder):
    before, after = inputs.snapshots(spark, folder)
    return reconcile.snapshot_diff(before, after, "c_custkey", inputs.as_of())


@query("SELECT email, event_id, action FROM de WHERE email IS NOT NULL", ("de",))
def rekeyed_view(spark, folder):
    return keyed.rekeyed(inputs.dirty_events(spark, folder), "email", ["event_id", "action"])


@query(
    """SELECT event_id, CAST(ts AS DATE) AS dq_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 10"""
)
def retention_filter(spark, folder):
    rows = inputs.events(spark, folder).select("event_id", F.to_date("ts").alias("dq_date"))
    return keyed.retained(rows, "dq_date", inputs.as_of(), 10)


@query(
    """SELECT event_type, CAST(ts AS DATE) AS day, ts, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) <= 5"""
)
def latest_n_per_day(spark, folder):
    rows = inputs.events(spark, folder).select("event_type", F.to_date("ts").alias("day"), "ts", "event_id")
    return keyed.latest_by_key(rows, ["event_type", "day"], ["ts", "event_id"], 5)


@query(
    """SELECT event_id, user_id FROM events WHERE ('0x' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 20 = 0"""
)
def audit_sample(spark, folder):
    """One key in twenty for audits (sampling is the operator)."""
    return keyed.hash_sample(inputs.events(spark, folder), "event_id", 20).select("event_id", "user_id")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sha256(CAST(event_id AS VARCHAR))) <= 3")
def audit_sample_by_key(spark, folder):
    """Three rows of every user for audits, the same at every site (sampling is the operator)."""
    return keyed.bottom_k(inputs.events(spark, folder), ["user_id"], ["event_id"], 3).select("user_id", "event_id")
