"""Inputs derived from the given tables, in Spark and as CTEs for the checking SQL.

The tables are clean, so faults are put in by key arithmetic that reads the same in
both dialects. Each input covers its whole table; a row one site lacks is one it holds under
another key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowwarden.sources.tables import table

AS_OF_TEXT = "2024-01-31 00:00:00"


def as_of():
    return F.expr(f"TIMESTAMP_NTZ'{AS_OF_TEXT}'")


# ------------------------------------------------------------ shared expressions

_EMAIL = """CASE WHEN event_id % 11 = 0 THEN NULL
  WHEN event_id % 7 = 0 THEN 'not-an-email'
  WHEN event_id % 5 = 0 THEN 'x u' || CAST(event_id AS STRING) || '@d.com'
  WHEN event_id % 3 = 0 THEN 'u' || CAST(event_id AS STRING) || '@d.com y'
  ELSE 'u' || CAST(event_id AS STRING) || '@d.com' END"""

_ACTION = """CASE event_id % 10 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'UPSERT'
  WHEN 3 THEN NULL WHEN 4 THEN 'NOOP' ELSE 'CREATE' END"""

_MONEY = "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)"

DIRTY = {
    "event_id": "event_id",
    "user_id": "user_id",
    "event_type": "event_type",
    "id": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(event_id AS STRING) END",
    "val": "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -value ELSE value END",
    "event_ts": "CASE WHEN event_id % 71 = 0 THEN NULL ELSE ts END",
    "email": _EMAIL,
    "action": _ACTION,
    "raw_json": f"""'{{"id":"' || CAST(event_id AS STRING) || '","value":' || {_MONEY} || '}}'""",
}

RAW = {
    "event_id": "event_id",
    "user_id": "user_id",
    "ts": "ts",
    "event_type": "event_type",
    "raw": f"""CASE WHEN event_id % 19 = 0 THEN '{{bad' ELSE
  '{{"event":' || CAST(event_id AS STRING)
  || CASE WHEN event_id % 43 = 0 THEN '' WHEN event_id % 47 = 0 THEN ',"id":null'
          ELSE ',"id":"u' || CAST(user_id AS STRING) || '"' END
  || CASE WHEN event_id % 37 = 0 THEN '' ELSE ',"timestamp":"' || CAST(ts AS STRING) || '"' END
  || CASE WHEN event_id % 23 = 0 THEN ',"value":"12"' WHEN event_id % 29 = 0 THEN ''
          WHEN event_id % 31 = 0 THEN ',"value":null'
          WHEN event_id % 13 = 0 THEN ',"value":-' || {_MONEY} ELSE ',"value":' || {_MONEY} END
  || COALESCE(',"email":"' || ({_EMAIL}) || '"', ',"email":null')
  || COALESCE(',"action":"' || ({_ACTION}) || '"', '')
  || ',"keyspace":"shop","table":"' || event_type || '","age":' || CAST(event_id % 97 - 4 AS STRING)
  || ',"partitionColumns":['
  || CASE WHEN event_id % 41 = 0 THEN '' ELSE
       '{{"name":"id","value":"u' || CAST(user_id AS STRING) || '","type":"PK"}},' END
  || '{{"name":"kind","value":"' || event_type || '","type":"CK"}}]}}' END""",
}


# Either site holds some rows under a key the other does not have.
CLOUD_KEY = "CASE WHEN o_orderkey % 97 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END"


def _order_hash(sha: str, price: str) -> str:
    text = f"concat_ws('|', CAST(o_orderkey AS STRING), CAST(CAST({price} AS DECIMAL(18,2)) AS STRING), o_orderstatus)"
    return sha.format(text)


def onprem_columns(sha: str, minutes: str) -> dict[str, str]:
    return {
        "order_key": "o_orderkey",
        "pk": "CASE WHEN o_orderkey % 113 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END",
        "hash_onprem": f"CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN 'zz' "
        f"ELSE {_order_hash(sha, 'o_totalprice')} END",
        "action": "CASE WHEN o_orderkey % 20 = 0 THEN 'DELETE' WHEN o_orderkey % 61 = 0 THEN NULL "
        "WHEN o_orderkey % 59 = 0 THEN 'NOOP' WHEN o_orderkey % 3 = 0 THEN 'UPDATE' ELSE 'CREATE' END",
        "event_ts": f"o_orderdate + {minutes.format('o_orderkey % 1440')}",
        "amount": "CAST(o_totalprice AS DECIMAL(18,2))",
        "status": "o_orderstatus",
    }


def cloud_columns(sha: str, minutes: str, seconds: str) -> dict[str, str]:
    return {
        "pk": CLOUD_KEY,
        "hash_cloud": "CASE WHEN o_orderkey % 103 = 0 OR o_orderkey % 127 = 0 THEN NULL "
        f"WHEN o_orderkey % 89 = 0 THEN {_order_hash(sha, 'o_totalprice + 1')} ELSE {_order_hash(sha, 'o_totalprice')} END",
        "cloud_ts": f"o_orderdate + {minutes.format('o_orderkey % 1440')} + {minutes.format('o_orderkey % 25')}",
        "arrival_ts": f"o_orderdate + {minutes.format('o_orderkey % 1440')} + {seconds.format('o_orderkey % 25')}",
    }


CHANGES = {
    "event_id": "event_id",
    "user_id": "user_id",
    "ts": "ts",
    "envelope": f"""'{{"op":"' || CASE event_id % 10 WHEN 0 THEN 'd' WHEN 1 THEN 'u' WHEN 2 THEN 'u' WHEN 3 THEN 'u'
    WHEN 4 THEN 'u' WHEN 5 THEN 'u' ELSE 'c' END || '","ts_ms":' || CAST(@ms AS STRING) || ',"after":'
  || CASE WHEN event_id % 10 = 0 THEN 'null' ELSE
     '{{"id":"' || CAST(user_id AS STRING) || '","amount":' || {_MONEY} || ',"event_ts":"' || CAST(ts AS STRING) || '"}}' END
  || ',"source":{{"keyspace":"sales","table_name":"events","dc":"azure"}}}}'""",
}

PARTIAL = {
    "event_id": "event_id",
    "user_id": "user_id",
    "ts": "ts",
    "a": "CASE WHEN event_id % 3 = 0 THEN value END",
    "b": "CASE WHEN event_id % 3 = 1 THEN event_type END",
    "c": "CASE WHEN event_id % 3 = 2 THEN props END",
}

# Every user of the events is a customer; some visits come under an id that no customer has.
VISITS = {
    "event_id": "event_id",
    "member_id": "CASE WHEN event_id % 14 = 0 THEN -user_id - 1 ELSE user_id END",
    "ts": "ts",
    "value": "value",
    "action": _ACTION,
}

SNAP_BEFORE = {"c_custkey": "c_custkey", "c_name": "c_name", "c_acctbal": "c_acctbal"}
# A changed key is a delete and an insert.
SNAP_AFTER = {
    "c_custkey": "CASE WHEN c_custkey % 31 = 0 THEN -c_custkey - 1 ELSE c_custkey END",
    "c_name": "c_name",
    "c_acctbal": "CASE WHEN c_custkey % 37 = 0 THEN c_acctbal + 10 ELSE c_acctbal END",
}

# One row per schema field a user's messages declare, by version: (field, type, nullable,
# default, simple) with the changes a diff has to tell apart.
SCHEMA_FIELDS = {
    "id": ("'string'", "FALSE", "FALSE", "TRUE", "TRUE"),
    "amount": (
        "CASE WHEN v = 2 AND user_id % 3 = 0 THEN 'long' WHEN v = 2 AND user_id % 3 = 1 THEN 'string' "
        "WHEN v = 3 AND user_id % 3 = 0 THEN 'float' WHEN v = 3 AND user_id % 3 = 2 THEN 'double' ELSE 'int' END",
        "FALSE", "FALSE", "TRUE", "TRUE",
    ),
    "email": ("'string'", "FALSE", "FALSE", "TRUE", "NOT (v = 3 AND user_id % 5 = 0)"),
    "phone": ("'string'", "user_id % 4 = 1", "user_id % 4 = 2", "TRUE", "v = 3"),
    "address": ("CASE WHEN v = 3 THEN 'map' ELSE 'record' END", "FALSE", "FALSE", "FALSE", "TRUE"),
}
SCHEMA_HEAD = (
    "'user-' || CAST(user_id AS STRING) AS subject",
    "v AS version",
    "CASE WHEN user_id % 17 = 0 THEN 'enum' ELSE 'record' END AS kind",
)

_LINE = """'{{"part":' || {part} || CASE WHEN o_orderkey % {m} = {at} THEN '' WHEN o_orderkey % {m} = {at} + 1 THEN ',"price":"free"'
  ELSE ',"price":' || CAST(o_orderkey % 90 AS STRING) || '.25' END || CASE WHEN o_orderkey % 8 = {at} THEN ',"remark":7' ELSE ',"extra":[]' END || '}}'"""
_KEY = "CAST(o_orderkey AS STRING)"

# One nested message per order, with faults at every level of the document `order_message.avsc`.
NESTED = {
    "order_key": "o_orderkey",
    "raw": f"""CASE WHEN o_orderkey % 211 = 0 THEN '{{"id":' ELSE
  '{{"id":' || CASE WHEN o_orderkey % 17 = 0 THEN '"' || {_KEY} || '"' WHEN o_orderkey % 29 = 0 THEN {_KEY} || '.5' ELSE {_KEY} END
  || CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN ',"buyer":null' WHEN o_orderkey % 19 = 0 THEN ',"buyer":[]' ELSE
     ',"buyer":{{"key":' || CASE WHEN o_orderkey % 23 = 0 THEN '3000000000' ELSE CAST(o_custkey AS STRING) END
     || ',"tier":' || CASE o_orderkey % 7 WHEN 0 THEN '"tin"' WHEN 1 THEN '"gold"' WHEN 2 THEN '"lead"' WHEN 3 THEN '4' ELSE '"silver"' END || '}}' END
  || CASE WHEN o_orderkey % 31 = 0 THEN ',"lines":{{}}' WHEN o_orderkey % 37 = 0 THEN ',"lines":[' || {_KEY} || ']'
     WHEN o_orderkey % 5 = 0 THEN ',"lines":[]' ELSE
     ',"lines":[' || {_LINE.format(part=_KEY, m=9, at=0)} || ',' || {_LINE.format(part="CASE WHEN o_orderkey % 6 = 0 THEN 'true' ELSE '12' END", m=10, at=3)} || ']' END
  || CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN ',"labels":{{"a":"x","b":3}}' WHEN 2 THEN ',"labels":{{}}' ELSE ',"labels":{{"c":null}}' END
  || CASE o_orderkey % 12 WHEN 0 THEN ',"note":"text"' WHEN 1 THEN ',"note":{{"code":5}}' WHEN 2 THEN ',"note":{{"code":"x"}}' WHEN 3 THEN ',"note":true'
     WHEN 4 THEN ',"note":{{"code":1,"about":{{"code":2,"about":{{"code":null}}}}}}' WHEN 5 THEN ',"note":null' ELSE '' END || '}}' END""",
}


def _select(columns: dict[str, str]) -> str:
    return ",\n".join(f"{e} AS {n}" for n, e in columns.items())


# ------------------------------------------------------------------------ Spark

_SPARK_SHA, _SPARK_MIN, _SPARK_SEC = "sha2({}, 256)", "make_dt_interval(0, 0, {}, 0)", "make_dt_interval(0, 0, 0, {})"


def _derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(events(spark, folder), DIRTY)


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(events(spark, folder), RAW)


def nested_messages(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(table(spark, folder, "orders"), NESTED)


def onprem(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(table(spark, folder, "orders"), onprem_columns(_SPARK_SHA, _SPARK_MIN))


def cloud(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(table(spark, folder, "orders"), cloud_columns(_SPARK_SHA, _SPARK_MIN, _SPARK_SEC))


def change_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    columns = {n: e.replace("@ms", "unix_millis(CAST(ts AS TIMESTAMP))") for n, e in CHANGES.items()}
    return _derive(events(spark, folder), columns)


def partial_updates(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(events(spark, folder), PARTIAL)


def visits(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(events(spark, folder), VISITS)


def snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, folder, "customer")
    return _derive(customer, SNAP_BEFORE), _derive(customer, SNAP_AFTER)


def schema_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Schema fields as the events declare them, one row per subject, version and field."""
    fields = ", ".join(
        f"named_struct('field', '{n}', 'type', {t}, 'nullable', {u}, 'has_default', {d}, 'simple', {s}, 'kept', {k})"
        for n, (t, u, d, s, k) in SCHEMA_FIELDS.items()
    )
    return (
        events(spark, folder)
        .selectExpr("user_id", "1 + event_id % 3 AS v")
        .distinct()
        .selectExpr(*SCHEMA_HEAD, f"explode(array({fields})) AS f")
        .where("f.kept")
        .selectExpr("subject", "version", "kind", "f.field", "f.type", "f.nullable", "f.has_default", "f.simple")
    )


# ------------------------------------------------------------------ checking SQL

_DUCK_SHA, _DUCK_MIN, _DUCK_SEC = "sha256({})", "to_minutes({})", "to_seconds({})"

_SCHEMA_SQL = " UNION ALL ".join(
    f"SELECT {', '.join(SCHEMA_HEAD)}, '{n}' AS field, {t} AS type, {u} AS nullable, {d} AS has_default, {s} AS simple "
    f"FROM (SELECT DISTINCT user_id, 1 + event_id % 3 AS v FROM events) WHERE {k}"
    for n, (t, u, d, s, k) in SCHEMA_FIELDS.items()
)

CTES = {
    "de": f"SELECT {_select(DIRTY)} FROM events",
    "raw": f"SELECT {_select(RAW)} FROM events",
    # j: the text where it is JSON; vt: kind of its value field
    "rawj": "SELECT *, json_type(j, '$.value') AS vt, json_extract_string(j, '$.value') AS vs "
    "FROM (SELECT *, CASE WHEN json_valid(raw) THEN raw END AS j FROM raw)",
    "op": f"SELECT {_select(onprem_columns(_DUCK_SHA, _DUCK_MIN))} FROM orders",
    "cl": f"SELECT {_select(cloud_columns(_DUCK_SHA, _DUCK_MIN, _DUCK_SEC))} FROM orders",
    "cdc": f"SELECT *, CASE event_id % 10 WHEN 0 THEN 'd' WHEN 1 THEN 'u' WHEN 2 THEN 'u' WHEN 3 THEN 'u' "
    "WHEN 4 THEN 'u' WHEN 5 THEN 'u' ELSE 'c' END AS op, epoch_us(ts) // 1000 AS ts_ms FROM events",
    "nest": f"SELECT {_select(NESTED)} FROM orders",
    # n: the text where it is JSON
    "nestj": "SELECT *, CASE WHEN json_valid(raw) THEN raw::JSON END AS n FROM nest",
    "vis": f"SELECT {_select(VISITS)} FROM events",
    "part": f"SELECT {_select(PARTIAL)} FROM events",
    "snap_a": f"SELECT {_select(SNAP_BEFORE)} FROM customer",
    "snap_b": f"SELECT {_select(SNAP_AFTER)} FROM customer",
    "sch": _SCHEMA_SQL,
}
_NEEDS = {"rawj": ("raw",), "nestj": ("nest",)}


def with_inputs(sql: str, inputs: tuple[str, ...]) -> str:
    """The SQL with the CTEs it names (and those they need) in front."""
    wanted: list[str] = []
    for name in inputs:
        for needed in (*_NEEDS.get(name, ()), name):
            if needed not in wanted:
                wanted.append(needed)
    sql = sql.strip()
    if not wanted:
        return sql
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted)
    for start in ("WITH RECURSIVE ", "WITH "):
        if sql.startswith(start):
            return f"{start}{head},\n{sql[len(start):]}"
    return f"WITH {head}\n{sql}"
