"""Filters and first-match classifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowwarden.functions import checks
from rowwarden.operators import joins
from rowwarden.plans import inputs
from rowwarden.plans.registry import query
from rowwarden.sources import tables


@query("SELECT event_id, val FROM de WHERE val >= 0", ("de",))
def filter_clean(spark, folder):
    return inputs.dirty_events(spark, folder).where("val >= 0").select("event_id", "val")


@query(
    """SELECT event_id, CASE WHEN id IS NULL THEN 'FAIL_ID_NULL' WHEN val < 0 THEN 'FAIL_NEG_VALUE'
      WHEN event_ts IS NULL THEN 'FAIL_TS_NULL' ELSE 'PASS' END AS dq_status FROM de""",
    ("de",),
)
def classify_pass_fail(spark, folder):
    return inputs.dirty_events(spark, folder).select(
        "event_id", checks.pass_fail(F.col("id"), F.col("val"), F.col("event_ts")).alias("dq_status")
    )


@query(
    """SELECT event_id, CASE WHEN id IS NULL THEN 'FAIL_ID_NULL' WHEN val IS NULL THEN 'FAIL_AMOUNT_NULL'
      WHEN val < 0 THEN 'FAIL_NEG_AMOUNT' WHEN event_ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY THEN 'WARN_OLD_EVENT'
      ELSE 'PASS' END AS dq_status FROM de""",
    ("de",),
)
def classify_cdc(spark, folder):
    return inputs.dirty_events(spark, folder).select(
        "event_id",
        checks.change_status(F.col("id"), F.col("val"), F.col("event_ts"), inputs.as_of()).alias("dq_status"),
    )


@query(
    """SELECT event_id, CASE WHEN val IS NULL OR val < 0 THEN 'INVALID' ELSE 'VALID' END AS dq_status FROM de""",
    ("de",),
)
def classify_amount(spark, folder):
    bad = F.col("val").isNull() | (F.col("val") < 0)
    return inputs.dirty_events(spark, folder).select("event_id", F.when(bad, "INVALID").otherwise("VALID").alias("dq_status"))


@query(
    """SELECT event_id, CASE WHEN id IS NULL THEN 'MISSING_ID' WHEN val IS NULL THEN 'MISSING_VALUE'
      WHEN val < 0 THEN 'NEGATIVE_VALUE' ELSE 'VALID' END AS dq_status FROM de""",
    ("de",),
)
def classify_missing(spark, folder):
    return inputs.dirty_events(spark, folder).select(
        "event_id", checks.missing_or_negative(F.col("id"), F.col("val")).alias("dq_status")
    )


@query(
    """SELECT event_id, CASE WHEN id IS NULL THEN 'FAIL' ELSE 'PASS' END AS id_check,
      CASE WHEN val IS NULL THEN 'FAIL' ELSE 'PASS' END AS val_check,
      CASE WHEN event_ts IS NULL THEN 'FAIL' ELSE 'PASS' END AS ts_check FROM de""",
    ("de",),
)
def check_null(spark, folder):
    return inputs.dirty_events(spark, folder).select(
        "event_id",
        checks.null_check(F.col("id")).alias("id_check"),
        checks.null_check(F.col("val")).alias("val_check"),
        checks.null_check(F.col("event_ts")).alias("ts_check"),
    )


@query("SELECT event_id, CASE WHEN val < 0 OR val > 100 THEN 'FAIL' ELSE 'PASS' END AS range_check FROM de", ("de",))
def check_range(spark, folder):
    return inputs.dirty_events(spark, folder).select("event_id", checks.bounds_check(F.col("val")).alias("range_check"))


def hash_pairs(spark, folder):
    """On-prem rows with the cloud digest of their key."""
    return joins.key_join(
        inputs.onprem(spark, folder).select("order_key", "pk", "hash_onprem"),
        inputs.cloud(spark, folder).select("pk", "hash_cloud"),
        ["pk"],
        "left",
    )


@query(
    """SELECT order_key,
      CASE WHEN hash_onprem IS NULL OR hash_cloud IS NULL OR hash_onprem <> hash_cloud THEN 'INVALID' ELSE 'VALID' END AS dq_status,
      CASE WHEN hash_onprem IS NULL THEN 'SOURCE_HASH_MISSING' WHEN hash_cloud IS NULL THEN 'CLOUD_HASH_MISSING'
        WHEN hash_onprem <> hash_cloud THEN 'HASH_MISMATCH' ELSE 'OK' END AS dq_reason,
      CASE WHEN hash_onprem IS NULL OR hash_cloud IS NULL THEN 2 WHEN hash_onprem <> hash_cloud THEN 1 ELSE 0 END AS dq_error_total
    FROM op LEFT JOIN cl ON op.pk = cl.pk""",
    ("op", "cl"),
)
def severity_score(spark, folder):
    status, reason, score = checks.hash_pair(F.col("hash_onprem"), F.col("hash_cloud"))
    return hash_pairs(spark, folder).select(
        "order_key", status.alias("dq_status"), reason.alias("dq_reason"), score.alias("dq_error_total")
    )


@query(
    """SELECT order_key, coalesce(hash_onprem = hash_cloud, FALSE) AS hash_match
    FROM op LEFT JOIN cl ON op.pk = cl.pk""",
    ("op", "cl"),
)
def hash_match_flag(spark, folder):
    flag = checks.hash_match(F.col("hash_onprem"), F.col("hash_cloud"))
    return hash_pairs(spark, folder).select("order_key", flag.alias("hash_match"))


EXPECTED = {
    "pk": inputs.CLOUD_KEY,
    "expected_amount": "CAST(CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2))",
    "expected_status": "CASE WHEN o_orderkey % 83 = 0 THEN 'X' ELSE o_orderstatus END",
}


@query(
    f"""WITH ref AS (SELECT {", ".join(f"{e} AS {n}" for n, e in EXPECTED.items())} FROM orders)
    SELECT order_key, CASE WHEN op.pk IS NULL THEN 'FAIL_PK_NULL' WHEN amount <> expected_amount THEN 'FAIL_AMOUNT_MISMATCH'
      WHEN status <> expected_status THEN 'FAIL_STATUS_MISMATCH' ELSE 'PASS' END AS dq_status
    FROM op LEFT JOIN ref ON op.pk = ref.pk""",
    ("op",),
)
def reference_compare(spark, folder):
    """Source rows against the reference row of their key: amount and status as expected."""
    reference = tables.table(spark, folder, "orders").selectExpr(*[f"{e} AS {n}" for n, e in EXPECTED.items()])
    source = inputs.onprem(spark, folder).select("order_key", "pk", "amount", "status")
    status = checks.amount_status(
        F.col("pk"), F.col("amount"), F.col("expected_amount"), F.col("status"), F.col("expected_status")
    )
    return joins.key_join(source, reference, ["pk"], "left").select("order_key", status.alias("dq_status"))
