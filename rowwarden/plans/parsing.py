"""Scans, parsing and look-ups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowwarden.functions import hashing, jsontext
from rowwarden.operators import keyed
from rowwarden.plans import inputs
from rowwarden.plans.registry import query
from rowwarden.session import checkpoint_dir
from rowwarden.sources import parse, tables
from rowwarden.sources.keyed_store import KeyedStore

MESSAGE_SCHEMA = "event bigint, id string, timestamp string, value double, email string, action string"


@query(
    """SELECT event_id,
      json_extract_string(j, '$.event') AS event,
      json_extract_string(j, '$.id') AS id,
      CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMP) AS event_ts,
      CASE WHEN vt <> 'VARCHAR' THEN CAST(vs AS DOUBLE) END AS value,
      json_extract_string(j, '$.email') AS email, json_extract_string(j, '$.action') AS action
    FROM rawj""",
    ("rawj",),
)
def scan_events_json(spark, folder):
    raw = inputs.raw_messages(spark, folder)
    typed = parse.typed(raw, "raw", MESSAGE_SCHEMA, keep=("event_id",))
    return typed.select(
        "event_id", F.col("event").cast("string").alias("event"), "id", F.col("timestamp").cast("timestamp_ntz").alias("event_ts"),
        "value", "email", "action",
    )


@query(
    """SELECT event_id, json_extract_string(j, '$.id') AS id,
      CASE WHEN vt IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(vs AS DOUBLE) END AS value
    FROM rawj WHERE j IS NOT NULL""",
    ("rawj",),
)
def parse_permissive(spark, folder):
    good = parse.well_formed(inputs.raw_messages(spark, folder), "raw", ["id", "value"], ["event_id"])
    return good.select("event_id", jsontext.text("id").alias("id"), jsontext.number("value").alias("value"))


@query(
    """SELECT event_id, CASE WHEN j IS NULL THEN 'no JSON object' ELSE '' END AS errors,
      CASE WHEN j IS NOT NULL THEN raw END AS payload FROM rawj""",
    ("rawj",),
)
def parse_dead_letter(spark, folder):
    rows = parse.with_errors(inputs.raw_messages(spark, folder), "raw", ["id"], ["event_id"])
    return rows.select("event_id", F.array_join("errors", ",").alias("errors"), "payload")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def scan_keyed_table(spark, folder):
    return tables.table(spark, folder, "orders")


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'"""
)
def scan_project_filter(spark, folder):
    recent = "o_orderdate >= TIMESTAMP_NTZ'1998-01-01' AND o_orderstatus = 'F'"
    return tables.restricted(tables.table(spark, folder, "orders"), ["o_orderkey", "o_totalprice"], recent)


@query(
    """SELECT ('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 64 AS bucket,
      count(*) AS row_count, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders GROUP BY 1"""
)
def bucket_scan(spark, folder):
    """Rows per hashed key range: the sizes of the parts a table is read or compared in."""
    return (
        tables.with_bucket(tables.table(spark, folder, "orders"), "o_orderkey", 64)
        .groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@query("SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def incremental_scan(spark, folder):
    newer = tables.newer_than(inputs.events(spark, folder), "ts", F.expr("TIMESTAMP_NTZ'2024-01-20 00:00:00'"))
    return newer.select("event_id", "ts", "event_type")


@query("SELECT event_id, ts, event_type FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 3 = 0 AND ts < TIMESTAMP '2024-01-20 00:00:00')")
def stored_mark_scan(spark, folder):
    """Rows after the mark that an earlier run has stored: that run had a third of the rows, up to a day."""
    events = inputs.events(spark, folder).select("event_id", "ts", "event_type")
    store = f"{checkpoint_dir(spark)}/mark-{uuid.uuid4().hex}"
    _, commit = tables.read_since_mark(spark, events.where("event_id % 3 = 0 and ts < TIMESTAMP_NTZ'2024-01-20 00:00:00'"), "ts", store)
    commit()
    fresh, _ = tables.read_since_mark(spark, events, "ts", store)
    return fresh


@query(
    """SELECT CAST(event_id AS VARCHAR) AS pk, sha256(payload) AS hash, payload, ts FROM (
      SELECT event_id, ts, '{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type
        || '","user":' || CAST(user_id AS VARCHAR) || '}' AS payload FROM events)"""
)
def generate_events(spark, folder):
    """Seed messages {pk, hash, payload, ts}, one per stored event."""
    payload = F.to_json(
        F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"), F.col("user_id").alias("user"))
    )
    return (
        inputs.events(spark, folder)
        .select(F.col("event_id").cast("string").alias("pk"), payload.alias("payload"), "ts")
        .select("pk", hashing.digest(F.col("payload")).alias("hash"), "payload", "ts")
    )


@query(
    """SELECT event_id, c_name, c_acctbal,
      CASE WHEN c_custkey IS NULL THEN 'No data found' ELSE 'found' END AS lookup
    FROM events LEFT JOIN customer ON event_id = c_custkey"""
)
def lookup_enrich(spark, folder):
    stored = tables.table(spark, folder, "customer").selectExpr("c_custkey AS event_id", "c_name", "c_acctbal")
    found = tables.lookup(inputs.events(spark, folder).select("event_id"), stored, ["event_id"])
    return found.select("event_id", "c_name", "c_acctbal", "lookup")


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    """WITH line AS (
      SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
    SELECT o_orderkey, n AS line, CAST(l_partkey AS VARCHAR) AS part, CAST(l_suppkey AS VARCHAR) AS supplier,
      CASE WHEN l_orderkey IS NULL THEN 'No data found' ELSE 'found' END AS lookup
    FROM (SELECT o_orderkey, unnest([1, 2, 3, 4, 5, 6, 7]) AS n FROM orders) LEFT JOIN line ON l_orderkey = o_orderkey AND l_linenumber = n"""
)
def lookup_composite(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
    stored = keyed.latest_by_key(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER).selectExpr(
        "l_orderkey AS o_orderkey", "l_linenumber AS line", "CAST(l_partkey AS STRING) AS part", "CAST(l_suppkey AS STRING) AS supplier"
    )
    # every line an order can have is asked for
    messages = tables.table(spark, folder, "orders").selectExpr("o_orderkey", "explode(sequence(1, 7)) AS line")
    found = tables.lookup(messages, stored, ["o_orderkey", "line"])
    return found.select("o_orderkey", "line", "part", "supplier", "lookup")


@query(
    """SELECT event_id,
      nullif(regexp_extract(raw, '"keyspace":"(.*?)"', 1), '') AS keyspace,
      nullif(regexp_extract(raw, '"table":"(.*?)"', 1), '') AS table_name,
      nullif(regexp_extract(raw, '"action":"(.*?)"', 1), '') AS action,
      nullif(regexp_extract(raw, '"name":"([^"]*)","value":"[^"]*","type":"PK"', 1), '') AS pk_name,
      nullif(regexp_extract(raw, '"value":"([^"]*)","type":"PK"', 1), '') AS pk_value
    FROM raw""",
    ("raw",),
)
def extract_key(spark, folder):
    raw = F.col("raw")
    rows = parse.typed(
        inputs.raw_messages(spark, folder),
        "raw",
        "partitionColumns array<struct<name:string,value:string,type:string>>",
        keep=["event_id", "raw"],
    )
    parts = F.col("partitionColumns")
    return rows.select(
        "event_id",
        jsontext.quoted_field(raw, "keyspace").alias("keyspace"),
        jsontext.quoted_field(raw, "table").alias("table_name"),
        jsontext.quoted_field(raw, "action").alias("action"),
        jsontext.element_by_role(parts, "PK", "name").alias("pk_name"),
        jsontext.element_by_role(parts, "PK", "value").alias("pk_value"),
    )


@query(
    """SELECT event_id, json_extract_string(p, '$.value') AS pk FROM (
      SELECT event_id, unnest(CAST(json_extract(j, '$.partitionColumns') AS JSON[])) AS p FROM rawj WHERE j IS NOT NULL)
    WHERE json_extract_string(p, '$.type') = 'PK'""",
    ("rawj",),
)
def unnest_pk(spark, folder):
    typed = parse.typed(
        inputs.raw_messages(spark, folder),
        "raw",
        "partitionColumns array<struct<type:string,value:string>>",
        keep=("event_id",),
    )
    return (
        typed.select("event_id", F.explode("partitionColumns").alias("p"))
        .where("p.type = 'PK'")
        .select("event_id", F.col("p.value").alias("pk"))
    )


@query(
    """SELECT o_orderkey, ('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 16 AS bucket,
      CASE WHEN ('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 16 < 5 THEN 'a'
        WHEN ('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 16 < 12 THEN 'b' ELSE 'c' END AS part FROM orders"""
)
def key_range_scan(spark, folder):
    """The table read in three key ranges; together they give each row once."""
    orders = tables.table(spark, folder, "orders").select("o_orderkey")
    parts = {"a": (0, 5), "b": (5, 12), "c": (12, 16)}
    read = None
    for name, (start, end) in parts.items():
        part = tables.key_range(orders, "o_orderkey", 16, start, end).withColumn("part", F.lit(name))
        read = part if read is None else read.unionByName(part)
    return read


@query(
    """SELECT o_orderkey, o_totalprice, ('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 64 AS leaf FROM orders
    WHERE ('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 64 BETWEEN 10 AND 29"""
)
def stored_key_range(spark, folder):
    """A range of a table that is laid out by hashed key: the files of other ranges are not opened."""
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.lit(0).alias("at"))
    store = KeyedStore(spark, f"{checkpoint_dir(spark)}/ranges-{uuid.uuid4().hex}", "o_orderkey bigint, o_totalprice double, at int", ["o_orderkey"], ["at"], 16, 64)
    store.merge(orders, 0)
    return store.key_range(10, 30).select("o_orderkey", "o_totalprice", "leaf")
