"""Row and payload digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowwarden.functions import checks, hashing
from rowwarden.operators import reconcile
from rowwarden.plans import inputs
from rowwarden.plans.registry import query
from rowwarden.sources import tables

_VAL = "CAST(CAST(val AS DECIMAL(18,2)) AS VARCHAR)"
_CANON = f"sha256(concat_ws('|', coalesce(id, 'NULL'), coalesce({_VAL}, 'NULL'), CAST(event_ts AS VARCHAR)))"


def canonical(df):
    """Key and value stand for NULL as text, a null time is left out."""
    value = F.col("val").cast("decimal(18,2)")
    return df.withColumn(
        "row_hash", hashing.canonical_hash([(F.col("id"), "NULL"), (value, "NULL"), F.col("event_ts")])
    )


@query(f"SELECT event_id, {_CANON} AS row_hash FROM de", ("de",))
def hash_canonical(spark, folder):
    return canonical(inputs.dirty_events(spark, folder)).select("event_id", "row_hash")


@query("SELECT event_id, sha256(raw_json) AS payload_hash FROM de", ("de",))
def hash_payload(spark, folder):
    return inputs.dirty_events(spark, folder).select("event_id", hashing.digest(F.col("raw_json")).alias("payload_hash"))


def fields(algorithm, spark, folder):
    columns = {"id": F.col("id"), "val": F.col("val").cast("decimal(18,2)"), "action": F.col("action"), "email": F.col("email")}
    return inputs.dirty_events(spark, folder).select(
        "event_id", hashing.fields_hash(columns, algorithm).alias("row_hash")
    )


_FIELDS = f"concat_ws('|', coalesce(action, ''), coalesce(email, ''), coalesce(id, ''), coalesce({_VAL}, ''))"


@query(f"SELECT event_id, sha256({_FIELDS}) AS row_hash FROM de", ("de",))
def hash_fields_sha256(spark, folder):
    return fields("SHA-256", spark, folder)


@query(f"SELECT event_id, md5({_FIELDS}) AS row_hash FROM de", ("de",))
def hash_fields_md5(spark, folder):
    return fields("MD5", spark, folder)


@query(
    """SELECT event_id, sha256(raw) AS hash,
      CASE WHEN c_custkey IS NULL THEN 'null' ELSE sha256('{"c_name":"' || c_name || '","balance":"'
        || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '"}') END AS stored_hash,
      CASE WHEN c_custkey IS NULL THEN 'null' ELSE '{"c_name":"' || c_name || '","balance":"'
        || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '"}' END AS payload
    FROM raw LEFT JOIN customer ON event_id = c_custkey""",
    ("raw",),
)
def message_vs_row_hash(spark, folder):
    """Digest of the whole message next to that of the stored row of its key."""
    stored = tables.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("event_id"),
        F.to_json(
            F.struct("c_name", F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("balance"))
        ).alias("stored"),
    )
    found = tables.lookup(inputs.raw_messages(spark, folder).select("event_id", "raw"), stored, ["event_id"])
    return found.select(
        "event_id",
        hashing.digest(F.col("raw")).alias("hash"),
        F.coalesce(hashing.digest(F.col("stored")), F.lit("null")).alias("stored_hash"),
        F.coalesce("stored", F.lit("null")).alias("payload"),
    )


@query(
    """SELECT order_key, hash_onprem IS NOT NULL AND NOT regexp_matches(hash_onprem, '^[a-f0-9]{64}$') AS invalid_hash FROM op""",
    ("op",),
)
def hash_format(spark, folder):
    digest = F.col("hash_onprem")
    return inputs.onprem(spark, folder).select(
        "order_key", (digest.isNotNull() & ~hashing.is_hex_digest(digest)).alias("invalid_hash")
    )


@query(
    """SELECT o_orderkey, sha256(concat_ws('|', coalesce(CAST(o_custkey AS VARCHAR), 'NULL'),
      coalesce(CAST(o_orderkey AS VARCHAR), 'NULL'), coalesce(o_orderpriority, 'NULL'), coalesce(o_orderstatus, 'NULL'))) AS row_hash
    FROM orders"""
)
def hash_exclude_fields(spark, folder):
    """Whole row without the columns that differ by site."""
    orders = tables.table(spark, folder, "orders")
    digest = hashing.row_hash(orders.columns, exclude=["o_totalprice", "o_orderdate"])
    return orders.select("o_orderkey", digest.alias("row_hash"))


@query(
    f"""SELECT id, {_CANON} AS row_hash, 'cloud' AS source_dc, event_ts FROM de
    WHERE id IS NOT NULL AND val >= 0 AND coalesce(event_ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY, TRUE)""",
    ("de",),
)
def hash_audit(spark, folder):
    """Digests of the rows that pass, as published for the other site."""
    rows = canonical(inputs.dirty_events(spark, folder))
    status = checks.change_status(F.col("id"), F.col("val"), F.col("event_ts"), inputs.as_of())
    return rows.where(status == "PASS").select("id", "row_hash", F.lit("cloud").alias("source_dc"), "event_ts")


def copies(spark, folder):
    """Both copies of the orders with the digest of the row, and the segments to compare them by."""
    left = inputs.onprem(spark, folder).select("pk", F.col("hash_onprem").alias("row_hash"))
    right = inputs.cloud(spark, folder).select("pk", F.col("hash_cloud").alias("row_hash"))
    return left, right, reconcile.segments_for(tables.table(spark, folder, "orders").count())


_WORDS = [f"digest_{i}" for i in range(4)]
_SEGMENT_OF = "coalesce(('0x' || substr(sha256(CAST(pk AS VARCHAR)), 1, 8))::BIGINT % (SELECT n FROM segments), -1)"
_BOUND = "sha256(coalesce('+' || CAST(pk AS VARCHAR), '-') || '|' || coalesce('+' || row_hash, '-'))"
_SUMS = ", ".join(f"sum(('0x' || substr(bound, {1 + 16 * i}, 16))::UBIGINT::HUGEINT) AS {w}" for i, w in enumerate(_WORDS))
_SEGMENT_SQL = f"""WITH segments AS (SELECT greatest(1, CAST(ceil(count(*) / 32) AS BIGINT)) AS n FROM orders),
a AS (SELECT pk, row_hash, {_SEGMENT_OF} AS segment, {_BOUND} AS bound FROM (SELECT pk, hash_onprem AS row_hash FROM op)),
b AS (SELECT pk, row_hash, {_SEGMENT_OF} AS segment, {_BOUND} AS bound FROM (SELECT pk, hash_cloud AS row_hash FROM cl)),
da AS (SELECT segment, count(*) AS row_count, {_SUMS} FROM a GROUP BY 1),
db AS (SELECT segment, count(*) AS row_count, {_SUMS} FROM b GROUP BY 1)
"""
_SAME = " AND ".join(f"da.{c} IS NOT DISTINCT FROM db.{c}" for c in ["row_count", *_WORDS])


def _text_sql(side):
    return "coalesce(concat_ws(':', " + ", ".join(f"CAST({side}.{w} AS VARCHAR)" for w in _WORDS) + "), '')"


@query(
    _SEGMENT_SQL
    + f"""SELECT coalesce(da.segment, db.segment) AS segment, coalesce(da.row_count, 0) AS onprem_rows, coalesce(db.row_count, 0) AS cloud_rows,
      {_text_sql("da")} AS onprem_digest, {_text_sql("db")} AS cloud_digest, {_SAME} AS same
    FROM da FULL JOIN db ON da.segment = db.segment""",
    ("op", "cl"),
)
def segment_digest(spark, folder):
    left, right, segments = copies(spark, folder)
    bucket, key, row_hash = reconcile.segment_of(F.col("pk"), segments), F.col("pk"), F.col("row_hash")
    parts = ["row_count", *reconcile.DIGEST]
    a = reconcile.segment_digest(left, bucket, key, row_hash).select("segment", F.struct(*parts).alias("a"))
    b = reconcile.segment_digest(right, bucket, key, row_hash).select("segment", F.struct(*parts).alias("b"))
    text = lambda side: F.concat_ws(":", *[F.col(f"{side}.{w}").cast("string") for w in reconcile.DIGEST])
    return a.join(b, "segment", "full").select(
        "segment",
        F.coalesce("a.row_count", F.lit(0)).alias("onprem_rows"),
        F.coalesce("b.row_count", F.lit(0)).alias("cloud_rows"),
        text("a").alias("onprem_digest"),
        text("b").alias("cloud_digest"),
        F.col("a").eqNullSafe(F.col("b")).alias("same"),
    )


@query(
    _SEGMENT_SQL
    + f""", open_segments AS (SELECT coalesce(da.segment, db.segment) AS segment FROM da FULL JOIN db ON da.segment = db.segment
      WHERE NOT ({_SAME}))
    SELECT coalesce(CAST(coalesce(a.pk, b.pk) AS VARCHAR), '') AS id, a.row_hash AS onprem_hash, b.row_hash AS azure_hash,
      CASE WHEN a.row_hash IS NULL AND b.row_hash IS NULL THEN 'MISSING_BOTH' WHEN a.row_hash IS NULL THEN 'MISSING_IN_ONPREM'
        WHEN b.row_hash IS NULL THEN 'MISSING_IN_AZURE' WHEN a.row_hash <> b.row_hash THEN 'DRIFT' ELSE 'OK' END AS reconciliation_status
    FROM (SELECT * FROM a WHERE segment IN (SELECT segment FROM open_segments)) a
    FULL JOIN (SELECT * FROM b WHERE segment IN (SELECT segment FROM open_segments)) b ON a.pk = b.pk""",
    ("op", "cl"),
)
def segment_drilldown(spark, folder):
    left, right, segments = copies(spark, folder)
    found = reconcile.drill_down(left, right, "pk", segments, "row_hash", "row_hash")
    return found.select(
        F.coalesce(F.col("pk").cast("string"), F.lit("")).alias("id"), "onprem_hash", "azure_hash", "reconciliation_status"
    )
