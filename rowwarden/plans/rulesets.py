"""Rules one by one and as rule sets."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from rowwarden.functions import checks, jsontext
from rowwarden.operators import nested, rules, schema
from rowwarden.plans import inputs
from rowwarden.plans.registry import CONFIG, query
from rowwarden.sources import parse, tables

DECLARED = {"event": "long", "id": "string", "timestamp": "string", "value": "double", "email": "string"}
EMAIL = "u[0-9]+@d[.]com"


def violated(df, *specs):
    """event_id with one flag per rule given as (name, rule dict)."""
    flags = [F.coalesce(rules.Rule.parse(r).violation(inputs.as_of()), F.lit(False)).alias(n) for n, r in specs]
    return df.select("event_id", *flags)


@query(
    """SELECT event_id, id IS NULL OR val IS NULL OR event_ts IS NULL AS violated, FALSE AS violated_skip FROM de""",
    ("de",),
)
def rule_required(spark, folder):
    rule = {"id": "r", "type": "required", "fields": ["id", "val", "event_ts"]}
    return violated(
        inputs.dirty_events(spark, folder), ("violated", rule), ("violated_skip", {**rule, "null_handling": "skip"})
    )


@query(
    """SELECT event_id, j IS NULL OR coalesce(json_type(j, '$.id'), 'NULL') = 'NULL' AS no_id,
      j IS NULL OR coalesce(vt, 'NULL') = 'NULL' AS no_value FROM rawj""",
    ("rawj",),
)
def rule_required_json(spark, folder):
    docs = parse.messages(inputs.raw_messages(spark, folder), "raw", ["id", "value"], ["event_id"])
    return docs.select(
        "event_id",
        F.coalesce(~jsontext.given("id"), F.lit(True)).alias("no_id"),
        F.coalesce(~jsontext.given("value"), F.lit(True)).alias("no_value"),
    )


@query(
    """SELECT event_id, coalesce(val < 0 OR val > 400, FALSE) AS violated,
      val IS NULL OR val < 0 OR val > 400 AS violated_fail, coalesce(val > 100, FALSE) AS violated_max FROM de""",
    ("de",),
)
def rule_range(spark, folder):
    rule = {"id": "r", "type": "range", "field": "val", "min": 0, "max": 400}
    return violated(
        inputs.dirty_events(spark, folder),
        ("violated", rule),
        ("violated_fail", {**rule, "null_handling": "fail"}),
        ("violated_max", {"id": "t", "type": "threshold", "field": "val", "max": 100}),
    )


_REGEX = {"id": "r", "type": "regex", "field": "email", "pattern": EMAIL}


@query(
    f"""SELECT event_id, coalesce(NOT regexp_matches(email, '{EMAIL}'), FALSE) AS violated,
      email IS NOT NULL AND NOT regexp_matches(email, '{EMAIL}') AS violated_skip,
      email IS NULL OR NOT regexp_matches(email, '{EMAIL}') AS violated_fail FROM de""",
    ("de",),
)
def rule_regex(spark, folder):
    return violated(
        inputs.dirty_events(spark, folder),
        ("violated", _REGEX),
        ("violated_skip", {**_REGEX, "null_handling": "skip"}),
        ("violated_fail", {**_REGEX, "null_handling": "fail"}),
    )


@query(
    f"SELECT event_id, coalesce(NOT regexp_full_match(email, '{EMAIL}'), FALSE) AS violated FROM de", ("de",)
)
def rule_regex_full(spark, folder):
    return violated(
        inputs.dirty_events(spark, folder), ("violated", {**_REGEX, "match": "full", "null_handling": "skip"})
    )


@query(
    f"SELECT event_id, coalesce(NOT regexp_matches(email, '^(?:{EMAIL})'), FALSE) AS violated FROM de", ("de",)
)
def rule_regex_prefix(spark, folder):
    return violated(inputs.dirty_events(spark, folder), ("violated", {**_REGEX, "match": "prefix"}))


@query(
    """SELECT event_id, coalesce(event_ts < TIMESTAMP '2024-01-31' - INTERVAL 1 DAY, FALSE) AS violated,
      coalesce(event_ts < TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR, FALSE) AS violated_hour FROM de""",
    ("de",),
)
def rule_freshness(spark, folder):
    rule = {"id": "r", "type": "timestamp_freshness", "field": "event_ts", "max_age_seconds": 86400}
    return violated(
        inputs.dirty_events(spark, folder), ("violated", rule), ("violated_hour", {**rule, "max_age_seconds": 3600})
    )


@query(
    """SELECT event_id, coalesce(NOT (val <= user_id * 2), FALSE) AS violated,
      coalesce(NOT (id <> '7'), FALSE) AS violated_ne FROM de""",
    ("de",),
)
def rule_cross_field(spark, folder):
    return violated(
        inputs.dirty_events(spark, folder),
        ("violated", {"id": "r", "type": "cross_field", "left": "val", "op": "<=", "right": "user_id * 2"}),
        ("violated_ne", {"id": "n", "type": "cross_field", "left": "id", "op": "<>", "right": "'7'"}),
    )


def _listed_keys(spark, folder):
    """Visitors are looked up among the customers; the whole table is the list."""
    return tables.table(spark, folder, "customer").select("c_custkey")


@query(
    """SELECT event_id, coalesce(action NOT IN ('CREATE', 'UPDATE', 'DELETE', 'UPSERT'), FALSE) AS violated,
      member_id NOT IN (SELECT c_custkey FROM customer) AS violated_table FROM vis""",
    ("vis",),
)
def rule_lookup_in(spark, folder):
    """Against a literal list, and against a list kept in a table."""
    by_list = {"id": "l", "type": "lookup_in", "field": "action", "values": ["CREATE", "UPDATE", "DELETE", "UPSERT"]}
    by_table = {"id": "t", "type": "lookup_in", "field": "member_id", "table": "customers"}
    rows = rules.attach_lookups(
        inputs.visits(spark, folder), [rules.Rule.parse(by_table)], {"customers": _listed_keys(spark, folder)}
    )
    return violated(rows, ("violated", by_list), ("violated_table", by_table))


@query(
    """SELECT event_id, coalesce(action IN ('NOOP', 'DELETE'), FALSE) AS violated,
      member_id IN (SELECT c_custkey FROM customer) AS violated_table FROM vis""",
    ("vis",),
)
def rule_lookup_not_in(spark, folder):
    by_list = {"id": "l", "type": "lookup_not_in", "field": "action", "values": ["NOOP", "DELETE"]}
    by_table = {"id": "t", "type": "lookup_not_in", "field": "member_id", "table": "customers"}
    rows = rules.attach_lookups(
        inputs.visits(spark, folder), [rules.Rule.parse(by_table)], {"customers": _listed_keys(spark, folder)}
    )
    return violated(rows, ("violated", by_list), ("violated_table", by_table))


@query(
    "SELECT event_id, coalesce(val > 100 AND event_type = 'click', FALSE) AS violated FROM de", ("de",)
)
def rule_custom_sql(spark, folder):
    rule = {"id": "r", "type": "custom_sql", "sql": "val > 100 and event_type = 'click'"}
    return violated(inputs.dirty_events(spark, folder), ("violated", rule))


@query(
    """WITH t AS (SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'n/a' WHEN event_id % 7 = 0 THEN '' WHEN event_id % 8 = 0 THEN ' 12.5 '
        ELSE CAST(CAST(val AS DECIMAL(18,2)) AS VARCHAR) END AS amount FROM de)
    SELECT event_id, coalesce(TRY_CAST(trim(amount) AS DOUBLE) < 0 OR TRY_CAST(trim(amount) AS DOUBLE) > 400, FALSE) AS violated,
      coalesce(TRY_CAST(trim(amount) AS DOUBLE) < 0.5, FALSE) AS violated_floor FROM t""",
    ("de",),
)
def rule_range_text(spark, folder):
    """Bounds over a text column in which some values are no numbers: those are passed over."""
    amount = (
        F.when(F.col("event_id") % 6 == 0, "n/a")
        .when(F.col("event_id") % 7 == 0, "")
        .when(F.col("event_id") % 8 == 0, " 12.5 ")
        .otherwise(F.col("val").cast("decimal(18,2)").cast("string"))
    )
    rows = inputs.dirty_events(spark, folder).select("event_id", amount.alias("amount"))
    return violated(
        rows,
        ("violated", {"id": "r", "type": "range", "field": "amount", "min": 0, "max": 400}),
        ("violated_floor", {"id": "f", "type": "range", "field": "amount", "min": 0.5}),
    )


_FAULTS_SQL = """concat_ws('; ',
  CASE WHEN json_type(j, '$.event') IS NULL THEN 'event: absent' WHEN json_type(j, '$.event') NOT IN ('UBIGINT', 'BIGINT') THEN 'event: not int' END,
  CASE WHEN json_type(j, '$.id') IS NULL THEN 'id: absent' WHEN json_type(j, '$.id') <> 'VARCHAR' THEN 'id: not string' END,
  CASE WHEN json_type(j, '$.timestamp') IS NULL THEN 'timestamp: absent' WHEN json_type(j, '$.timestamp') <> 'VARCHAR' THEN 'timestamp: not string' END,
  CASE WHEN vt IS NULL THEN 'value: absent' WHEN vt NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'value: not float' END,
  CASE WHEN json_type(j, '$.email') IS NULL THEN 'email: absent' WHEN json_type(j, '$.email') <> 'VARCHAR' THEN 'email: not string' END)"""


def declared_fields(spark, folder):
    return parse.messages(inputs.raw_messages(spark, folder), "raw", list(DECLARED), ["event_id"])


def conforming(spark, folder, types=True):
    return declared_fields(spark, folder).select("event_id", schema.conformance_faults(DECLARED, types).alias("schema_faults"))


@query(f"SELECT event_id, {_FAULTS_SQL} <> '' AS violated FROM rawj", ("rawj",))
def rule_schema(spark, folder):
    rule = {"id": "s", "type": "schema_registry", "subject": "events"}
    return violated(conforming(spark, folder), ("violated", rule))


@query(
    f"""SELECT event_id, {_FAULTS_SQL} = '' AS conforms, {_FAULTS_SQL} AS faults,
      nullif(split_part({_FAULTS_SQL}, '; ', 1), '') AS reason FROM rawj""",
    ("rawj",),
)
def schema_conformance(spark, folder):
    faults = F.col("schema_faults")
    return conforming(spark, folder).select(
        "event_id",
        (F.size(faults) == 0).alias("conforms"),
        F.array_join(faults, "; ").alias("faults"),
        F.get(faults, F.lit(0)).alias("reason"),
    )


# json_type of the checking engine: whole numbers are BIGINT or UBIGINT, a missing path has none
_WHOLE = "('BIGINT', 'UBIGINT')"
_NUMBER = "('BIGINT', 'UBIGINT', 'DOUBLE')"
NESTED_SQL = f"""
WITH items AS (
    SELECT order_key, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS x FROM (SELECT order_key, json_extract(n, '$.lines[*]') AS ls FROM nestj WHERE json_type(n, '$.lines') = 'ARRAY')
), notes AS (
    SELECT order_key, 1 AS d, 'note' AS path, json_extract(n, '$.note') AS x FROM nestj WHERE json_type(n, '$.note') = 'OBJECT'
    UNION ALL SELECT order_key, 2, 'note.about', json_extract(n, '$.note.about') FROM nestj WHERE json_type(n, '$.note.about') = 'OBJECT'
    UNION ALL SELECT order_key, 3, 'note.about.about', json_extract(n, '$.note.about.about') FROM nestj WHERE json_type(n, '$.note.about.about') = 'OBJECT'
)
SELECT order_key, '$: malformed' AS fault FROM nestj WHERE n IS NULL
UNION ALL SELECT order_key, 'id: not long' FROM nestj WHERE json_type(n, '$.id') NOT IN {_WHOLE}
UNION ALL SELECT order_key, 'buyer: absent' FROM nestj WHERE n IS NOT NULL AND json_type(n, '$.buyer') IS NULL
UNION ALL SELECT order_key, 'buyer: none of null|Buyer' FROM nestj WHERE json_type(n, '$.buyer') NOT IN ('NULL', 'OBJECT')
UNION ALL SELECT order_key, 'buyer.key: not int' FROM nestj WHERE json_type(n, '$.buyer.key') IN {_WHOLE} AND (n->>'$.buyer.key')::BIGINT > 2147483647
UNION ALL SELECT order_key, 'buyer.tier: not one of lead|silver|gold' FROM nestj
    WHERE json_type(n, '$.buyer.tier') IS NOT NULL AND (json_type(n, '$.buyer.tier') <> 'VARCHAR' OR n->>'$.buyer.tier' NOT IN ('lead', 'silver', 'gold'))
UNION ALL SELECT order_key, 'lines: not array' FROM nestj WHERE json_type(n, '$.lines') <> 'ARRAY'
UNION ALL SELECT order_key, 'lines[' || i || ']: not record' FROM items WHERE json_type(x) <> 'OBJECT'
UNION ALL SELECT order_key, 'lines[' || i || '].part: not long' FROM items WHERE json_type(x, '$.part') NOT IN {_WHOLE}
UNION ALL SELECT order_key, 'lines[' || i || '].price: absent' FROM items WHERE json_type(x) = 'OBJECT' AND json_type(x, '$.price') IS NULL
UNION ALL SELECT order_key, 'lines[' || i || '].price: not double' FROM items WHERE json_type(x, '$.price') NOT IN {_NUMBER}
UNION ALL SELECT order_key, 'lines[' || i || '].remark: not string' FROM items WHERE json_type(x, '$.remark') <> 'VARCHAR'
UNION ALL SELECT order_key, 'labels.' || key || ': not string' FROM nestj, json_each(json_extract(n, '$.labels')) WHERE type <> 'VARCHAR'
UNION ALL SELECT order_key, 'note: none of null|string|Note' FROM nestj WHERE json_type(n, '$.note') NOT IN ('NULL', 'VARCHAR', 'OBJECT')
UNION ALL SELECT order_key, path || '.code: not int' FROM notes WHERE json_type(x, '$.code') NOT IN {_WHOLE}
"""


@query(NESTED_SQL, ("nestj",))
def nested_conformance(spark, folder):
    """Every fault of nested messages against an Avro document: records, arrays, maps, enums, unions, a type that holds itself."""
    check = nested.avro(json.loads((CONFIG / "order_message.avsc").read_text()))
    checked = nested.conforming(inputs.nested_messages(spark, folder), "raw", check)
    return checked.select("order_key", F.explode("schema_faults").alias("fault"))


@query(
    """SELECT event_id, json_type(j, '$.event') IS NOT NULL AND json_type(j, '$.id') IS NOT NULL
      AND json_type(j, '$.timestamp') IS NOT NULL AND vt IS NOT NULL AND json_type(j, '$.email') IS NOT NULL AS conforms
    FROM rawj""",
    ("rawj",),
)
def schema_presence(spark, folder):
    return conforming(spark, folder, types=False).select("event_id", (F.size("schema_faults") == 0).alias("conforms"))


@query(
    """SELECT event_id, CAST(date_diff('second', event_ts, TIMESTAMP '2024-01-31') AS VARCHAR) AS age_seconds,
      coalesce(date_diff('second', event_ts, TIMESTAMP '2024-01-31') >= 864000, FALSE) AS violated FROM de""",
    ("de",),
)
def rule_preprocess(spark, folder):
    """A derived value, then a condition on it."""
    step = {"name": "age_seconds", "expression": "timestampdiff(SECOND, date_trunc('SECOND', event_ts), TIMESTAMP_NTZ'2024-01-31')"}
    rule = rules.Condition.parse(
        {"id": "age", "severity": "warn", "preprocess": [step], "condition": "age_seconds < 864000"}
    )
    rows = rules.with_preprocess(inputs.dirty_events(spark, folder), [rule])
    return rows.select(
        "event_id",
        F.col("age_seconds").cast("string").alias("age_seconds"),
        F.coalesce(~F.expr(rule.holds), F.lit(False)).alias("violated"),
    )


RECORD_RULES = CONFIG / "record_rules.yaml"

_RULES_SQL = {
    "amount_floor": "val < 0",
    "key_and_amount": "id IS NULL OR val IS NULL",
    "mail_shape": "email IS NOT NULL AND NOT regexp_full_match(email, 'u[0-9]+@d[.]com')",
    "amount_ceiling": "val > 400",
    "handled_change": "action NOT IN ('CREATE', 'UPDATE', 'DELETE', 'UPSERT')",
    "owner_scale": "NOT (val <= user_id * 40)",
    "seen_lately": "event_ts < TIMESTAMP '2024-01-31' - INTERVAL 1 DAY",
}


def _first_sql(*outcomes):
    branches = " ".join(f"WHEN {test} THEN '{o}'" for test, o in zip(_RULES_SQL.values(), outcomes))
    return f"CASE {branches} ELSE '{outcomes[-1]}' END"


STATUS_SQL = _first_sql("INVALID", "INVALID", "INVALID", "QUARANTINE", "UNKNOWN", "QUARANTINE", "QUARANTINE", "VALID")
REASON_SQL = _first_sql(
    "amount is below zero", "row lacks its key or its amount", "mail address has an odd shape", "amount is unusually large",
    "change kind is not handled", "amount is out of scale for its owner", "row is older than a day", "OK",
)


def checked(spark, folder):
    return rules.with_status(inputs.dirty_events(spark, folder), rules.typed_rules(RECORD_RULES), inputs.as_of())


@query(f"SELECT event_id, {STATUS_SQL} AS dq_status, {REASON_SQL} AS dq_reason FROM de", ("de",))
def ruleset_first_match(spark, folder):
    return checked(spark, folder).select("event_id", "dq_status", "dq_reason")


_ALL_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _RULES_SQL.items()) + ")"


@query(
    f"""SELECT event_id, failed, CASE WHEN failed = '' THEN 0 ELSE len(string_split(failed, ',')) END AS failure_count
    FROM (SELECT event_id, {_ALL_SQL} AS failed FROM de)""",
    ("de",),
)
def ruleset_all_failures(spark, folder):
    failed = rules.failures(rules.typed_rules(RECORD_RULES), inputs.as_of())
    return (
        inputs.dirty_events(spark, folder)
        .select("event_id", failed.alias("failures"))
        .select(
            "event_id",
            F.array_join(F.transform("failures", lambda f: f["id"]), ",").alias("failed"),
            F.size("failures").cast("bigint").alias("failure_count"),
        )
    )


MESSAGE_RULES = CONFIG / "message_rules.yaml"


def message_fields(spark, folder):
    """What the message conditions look at, taken from the parsed text once."""
    docs = parse.messages(
        inputs.raw_messages(spark, folder), "raw", ["timestamp", "value", "table", "age", "action"], ["event_id", "raw"]
    )
    return docs.select(
        "event_id",
        "raw",
        jsontext.text("timestamp").alias("timestamp_text"),
        jsontext.number("value").alias("amount"),
        jsontext.text("table").alias("kind"),
        jsontext.number("age").alias("age"),
        jsontext.text("action").alias("action"),
    )


def message_failures(spark, folder):
    conditions = rules.condition_rules(MESSAGE_RULES)
    rows = rules.with_preprocess(message_fields(spark, folder), conditions)
    return rows.select("event_id", "raw", rules.condition_failures(conditions).alias("failures"))


_MESSAGE_CTES = """WITH c AS (SELECT *, hour(TRY_CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMP)) AS sent_hour,
    CASE WHEN vt IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN TRY_CAST(vs AS DOUBLE) END AS amount, json_extract_string(j, '$.table') AS kind,
    TRY_CAST(json_extract_string(j, '$.age') AS DOUBLE) AS age, json_extract_string(j, '$.action') AS action FROM rawj),
t AS (SELECT event_id, raw, sent_hour, amount <= CASE kind WHEN 'purchase' THEN 300 WHEN 'click' THEN 120 ELSE 200 END AS in_scale,
    NOT (kind = 'purchase' AND age < 18) AS of_age, coalesce(action, '') <> 'DELETE' OR amount = 0 AS is_empty FROM c),
f AS (SELECT event_id, raw,
    CASE WHEN sent_hour IS NULL THEN 'quiet_hours:preprocess,quiet_hours:error' WHEN NOT (sent_hour BETWEEN 6 AND 22) THEN 'quiet_hours:warn' END AS f1,
    CASE WHEN in_scale IS NULL THEN 'amount_for_kind:error' WHEN NOT in_scale THEN 'amount_for_kind:fail' END AS f2,
    CASE WHEN in_scale IS NULL THEN NULL WHEN of_age IS NULL THEN 'minor_buys:error' WHEN NOT of_age THEN 'minor_buys:fail' END AS f3,
    CASE WHEN in_scale IS NULL OR of_age IS NULL THEN NULL WHEN is_empty IS NULL THEN 'removal_is_empty:error'
      WHEN NOT is_empty THEN 'removal_is_empty:warn' END AS f4 FROM t),
g AS (SELECT event_id, raw, concat_ws(',', f1, f2, f3, f4) AS failed FROM f)
"""


@query(_MESSAGE_CTES + "SELECT event_id, failed FROM g", ("rawj",))
def ruleset_error_as_failure(spark, folder):
    """A condition that cannot be computed counts as a failure, and ends the list for a fail rule."""
    kind = {"condition error": "error", "preprocess error": "preprocess"}

    def label(f):
        tag = f["severity"]
        for message, word in kind.items():
            tag = F.when(f["message"] == message, word).otherwise(tag)
        return F.concat(f["id"], F.lit(":"), tag)

    return message_failures(spark, folder).select(
        "event_id", F.array_join(F.transform("failures", label), ",").alias("failed")
    )


@query(
    """SELECT event_id, j IS NOT NULL AND coalesce(CAST(json_extract_string(j, '$.age') AS BIGINT), 0) >= 0
      AND regexp_matches(coalesce(json_extract_string(j, '$.email'), ''), '^(?:[^@]+@[^@]+\\.[^@]+)') AS passes
    FROM rawj""",
    ("rawj",),
)
def business_rules(spark, folder):
    """age, 0 when absent, is not negative; email, empty when absent, starts like an address."""
    docs = parse.messages(inputs.raw_messages(spark, folder), "raw", ["age", "email"], ["event_id"])
    age = F.coalesce(jsontext.number("age"), F.lit(0.0))
    email = F.coalesce(jsontext.text("email"), F.lit(""))
    broken = checks.outside(age, 0) | checks.not_like(email, checks.EMAIL_PREFIX, "prefix")
    return docs.select("event_id", (~F.col("malformed") & ~broken).alias("passes"))


@query(
    """SELECT event_id, json_type(j, '$.id') IS NOT NULL AND json_type(j, '$.timestamp') IS NOT NULL AND vt IS NOT NULL
      AND TRY_CAST(vs AS DOUBLE) IS NOT NULL AS passes FROM rawj""",
    ("rawj",),
)
def validate_message(spark, folder):
    """id, timestamp and value are there, and value reads as a number (text or not)."""
    docs = parse.messages(inputs.raw_messages(spark, folder), "raw", ["id", "timestamp", "value"], ["event_id"])
    number = jsontext.value("value", "string").try_cast("double")
    return docs.select(
        "event_id", (schema.required_present(["id", "timestamp", "value"]) & number.isNotNull()).alias("passes")
    )


_EVOLUTION_SQL = """WITH v AS (SELECT * FROM (SELECT DISTINCT subject, version FROM sch)
    QUALIFY row_number() OVER (PARTITION BY subject ORDER BY version DESC) <= 2),
pair AS (SELECT subject, min(version) AS old_version, max(version) AS new_version FROM v GROUP BY 1 HAVING count(*) = 2),
o AS (SELECT sch.*, old_version, new_version FROM sch JOIN pair ON sch.subject = pair.subject AND version = old_version),
n AS (SELECT sch.*, old_version, new_version FROM sch JOIN pair ON sch.subject = pair.subject AND version = new_version),
odd AS (SELECT DISTINCT subject, old_version, new_version FROM (FROM o UNION ALL FROM n) WHERE kind <> 'record'),
changes AS (
  SELECT subject, old_version, new_version, 'warn' AS level, 'kind: no record, fields not compared' AS change FROM odd
  UNION ALL
  SELECT o.subject, o.old_version, o.new_version, 'break', 'dropped: ' || o.field FROM o LEFT JOIN n ON n.subject = o.subject AND n.field = o.field
    WHERE n.field IS NULL AND o.subject NOT IN (SELECT subject FROM odd)
  UNION ALL
  SELECT n.subject, n.old_version, n.new_version, 'break', 'needs default: ' || n.field
    FROM n LEFT JOIN o ON n.subject = o.subject AND n.field = o.field
    WHERE o.field IS NULL AND NOT n.has_default AND NOT n.nullable AND n.subject NOT IN (SELECT subject FROM odd)
  UNION ALL
  SELECT o.subject, o.old_version, o.new_version, CASE WHEN o.simple AND n.simple THEN 'break' ELSE 'warn' END,
    CASE WHEN o.simple AND n.simple THEN 'retyped: ' || o.field || ' ' || o.type || ' -> ' || n.type
      ELSE 'nested, look closer: ' || o.field END
    FROM o JOIN n ON n.subject = o.subject AND n.field = o.field
    WHERE o.subject NOT IN (SELECT subject FROM odd) AND (NOT (o.simple AND n.simple) OR (o.type <> n.type AND (o.type, n.type) NOT IN
      (('int', 'long'), ('int', 'float'), ('int', 'double'), ('long', 'double'), ('float', 'double')))))
"""


@query(_EVOLUTION_SQL + "SELECT * FROM changes", ("sch",))
def schema_evolution(spark, folder):
    return schema.evolution(inputs.schema_registry(spark, folder))


@query(
    _EVOLUTION_SQL
    + """SELECT count(DISTINCT subject) AS dq_schema_drift_detected,
      count(*) FILTER (change LIKE 'dropped: %') AS dq_column_removed,
      count(*) FILTER (level = 'break') AS breaks, count(*) FILTER (level = 'warn') AS warns FROM changes""",
    ("sch",),
)
def schema_drift_counts(spark, folder):
    return schema.drift_counts(schema.evolution(inputs.schema_registry(spark, folder)))
