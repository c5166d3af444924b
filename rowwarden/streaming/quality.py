"""The quality flow on a stream: parse, schema, rules, anomaly state, three outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowwarden.operators.ordered import Ewma
from rowwarden.operators.routing import dead_letter
from rowwarden.streaming import sinks, stateful


def outputs():
    """dead_letter: invalid; anomalies: valid and anomalous; table: valid and usual."""
    valid = F.col("errors") == ""
    letter = dead_letter(F.split("errors", "; "), F.col("raw"), F.col("key")).alias("letter")
    return {
        "dead_letter": (~valid, lambda df: df.select("event_id", letter)),
        "anomalies": (valid & F.col("is_anomaly"), None),
        "table": (valid & ~F.col("is_anomaly"), None),
    }


def run(checked: DataFrame, root: str, checkpoint: str, fold: Ewma, interval: str | None = None):
    """`checked` is a stream of (event_id, ts, key, value, errors, raw).

    Rows without a key keep no state; they get a key of their own kind so that
    none is lost, and are never anomalous as they lack a valid id.
    """
    keyless = F.concat(F.lit("\u0000"), F.pmod("event_id", F.lit(64)).cast("string"))
    keyed = checked.withColumn("state_key", F.coalesce("key", keyless)).withColumn(
        "number", F.when(F.col("key").isNotNull(), F.col("value"))
    )
    scanned = stateful.fold_stream(keyed, "state_key", ["ts", "event_id"], "number", fold)
    return sinks.start(scanned, sinks.fan_out(outputs(), root), checkpoint, interval)
