"""Routing of checked rows and the payloads of each output."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowwarden.functions import jsontext
from rowwarden.operators import reconcile, routing, rules, joins
from rowwarden.plans import inputs
from rowwarden.plans.registry import query
from rowwarden.plans.rulesets import RECORD_RULES, REASON_SQL, STATUS_SQL, _ALL_SQL, _MESSAGE_CTES, checked, message_failures
from rowwarden.sources import parse


@query(
    f"""SELECT event_id, CASE WHEN {STATUS_SQL} = 'VALID' THEN 'validated' ELSE 'invalid' END AS output,
      CASE WHEN {STATUS_SQL} <> 'VALID' THEN {REASON_SQL} END AS dq_reason FROM de""",
    ("de",),
)
def route_split(spark, folder):
    good, bad = routing.split_by_status(checked(spark, folder))
    return good.select("event_id", F.lit("validated").alias("output"), F.lit(None).cast("string").alias("dq_reason")).unionByName(
        bad.select("event_id", F.lit("invalid").alias("output"), "dq_reason")
    )


_WARN_ONLY = "regexp_matches(failed, 'key_and_amount|amount_floor|mail_shape')"


@query(
    f"""SELECT event_id, CASE WHEN failed = '' THEN 'validated' WHEN {_WARN_ONLY} THEN 'invalid' ELSE 'quarantine' END AS route,
      failed FROM (SELECT event_id, {_ALL_SQL} AS failed FROM de)""",
    ("de",),
)
def route_three_way(spark, folder):
    failed = rules.failures(rules.typed_rules(RECORD_RULES), inputs.as_of())
    return (
        inputs.dirty_events(spark, folder)
        .select("event_id", failed.alias("failures"))
        .select(
            "event_id",
            rules.verdict_route(F.col("failures")).alias("route"),
            F.array_join(F.transform("failures", lambda f: f["id"]), ",").alias("failed"),
        )
    )


@query(
    _MESSAGE_CTES
    + """SELECT event_id, route FROM (
      SELECT event_id, 'validated' AS route FROM g WHERE failed = ''
      UNION SELECT event_id, 'invalid' FROM g WHERE regexp_matches(failed, 'amount_for_kind|removal_is_empty')
      UNION SELECT event_id, 'quarantine' FROM g WHERE regexp_matches(failed, 'quiet_hours|minor_buys'))""",
    ("rawj",),
)
def route_by_rule(spark, folder):
    """Every output a row goes to by the routes of the rules it fails."""
    return routing.fan_out(message_failures(spark, folder)).select("event_id", "route")


@query(
    """SELECT event_id, 'onprem.' || event_type || '.events' AS source_topic, 'cloud.' || event_type || '.hash' AS topic FROM events"""
)
def route_topic(spark, folder):
    source = F.concat(F.lit("onprem."), "event_type", F.lit(".events"))
    topic = routing.topic_name(source, "^onprem\\.(.*)\\.events$", "cloud.$1.hash")
    return inputs.events(spark, folder).select("event_id", source.alias("source_topic"), topic.alias("topic"))


@query(
    """SELECT event_id, '{"errors":["no JSON object"],"payload":null,"key":null}' AS letter FROM rawj WHERE j IS NULL
    UNION ALL
    SELECT event_id, '{"errors":["id: null"],"payload":"' || replace(raw, '"', '\\"') || '","key":null}'
    FROM rawj WHERE j IS NOT NULL AND json_extract_string(j, '$.id') IS NULL""",
    ("rawj",),
)
def dead_letter_payload(spark, folder):
    """{errors, payload, key} of messages that are malformed or lack their id."""
    rows = parse.with_errors(inputs.raw_messages(spark, folder), "raw", ["id"], ["event_id"]).withColumn("key", jsontext.text("id"))
    no_id = ~F.col("malformed") & F.col("key").isNull()
    errors = F.when(no_id, F.array(F.lit("id: null"))).otherwise(F.col("errors"))
    return rows.where(F.col("key").isNull()).select(
        "event_id", routing.dead_letter(errors, F.col("payload"), F.col("key")).alias("letter")
    )


@query(
    """SELECT event_id, '{"error":"value is no number","originalMessage":"' || replace(raw, '"', '\\"')
      || '","timestamp":"2024-01-31 00:00:00"}' AS letter
    FROM rawj WHERE TRY_CAST(vs AS DOUBLE) IS NULL""",
    ("rawj",),
)
def dead_letter_error(spark, folder):
    docs = parse.messages(inputs.raw_messages(spark, folder), "raw", ["value"], ["event_id", "raw"])
    number = jsontext.value("value", "string").try_cast("double")
    letter = routing.error_letter(F.lit("value is no number"), F.col("raw"), inputs.as_of().cast("string"))
    return docs.where(number.isNull()).select("event_id", letter.alias("letter"))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS key, '{"user_id":' || CAST(user_id AS VARCHAR) || ',"event_type":"' || event_type
      || '","action":' || coalesce('"' || action || '"', 'null') || '}' AS value FROM de""",
    ("de",),
)
def json_payload(spark, folder):
    return routing.keyed_message(
        inputs.dirty_events(spark, folder).select("event_id", "user_id", "event_type", "action"), "event_id"
    )


@query(
    """SELECT order_key, action, CASE WHEN action = 'DELETE' THEN 'SKIPPED_DELETE'
      WHEN coalesce(action NOT IN ('CREATE', 'UPDATE', 'UPSERT'), TRUE) THEN 'UNKNOWN_ACTION'
      WHEN hash_cloud IS NULL THEN 'MISSING_CLOUD' WHEN hash_onprem = hash_cloud THEN 'MATCH' ELSE 'MISMATCH' END AS dq_status,
      coalesce(action NOT IN ('CREATE', 'UPDATE', 'UPSERT', 'DELETE'), TRUE) AS to_dead_letter
    FROM op LEFT JOIN cl ON op.pk = cl.pk""",
    ("op", "cl"),
)
def unknown_action_dlq(spark, folder):
    joined = joins.key_join(
        inputs.onprem(spark, folder).select("order_key", "pk", "action", "hash_onprem"),
        inputs.cloud(spark, folder).select("pk", "hash_cloud"),
        ["pk"],
        "left",
    )
    judged = reconcile.action_status(joined, "hash_onprem", "hash_cloud", ["CREATE", "UPDATE", "UPSERT"])
    return judged.select(
        "order_key", "action", "dq_status", (F.col("dq_status") == "UNKNOWN_ACTION").alias("to_dead_letter")
    )


@query(
    _MESSAGE_CTES + """SELECT event_id, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"_dq_reasons":[' || ids || ']}' AS payload FROM (
      SELECT event_id, array_to_string(list_transform(string_split(failed, ','), lambda x: '"' || split_part(x, ':', 1) || '"'), ',') AS ids FROM g WHERE failed <> '')""",
    ("rawj",),
)
def invalid_reasons(spark, folder):
    """Failed messages with the ids of what they failed as `_dq_reasons`."""
    failed = message_failures(spark, folder).where(F.size("failures") > 0)
    ids = failed.select("event_id", F.transform("failures", lambda f: f["id"]).alias("failures"))
    return ids.select("event_id", routing.invalid_payload(ids, ["event_id"]).alias("payload"))
