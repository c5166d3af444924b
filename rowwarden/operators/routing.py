"""Splitting checked rows over outputs, and the payloads those outputs carry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

OUTPUTS = ("validated", "invalid", "quarantine")


def split_by_status(df: DataFrame, status: str = "dq_status", good: str = "VALID") -> tuple[DataFrame, DataFrame]:
    """(good rows, all others); a null status goes with the others, so no row is lost."""
    ok = F.col(status).eqNullSafe(F.lit(good))
    return df.where(ok), df.where(~ok)


def fan_out(df: DataFrame, failures: str = "failures") -> DataFrame:
    """One row per (row, route) over the routes its failures name; no failure means `validated`."""
    routes = F.array_distinct(F.transform(F.col(failures), lambda f: f["route"]))
    return df.withColumn(
        "route", F.explode(F.when(F.size(failures) == 0, F.array(F.lit("validated"))).otherwise(routes))
    )


def invalid_payload(df: DataFrame, columns: Sequence[str], failures: str = "failures") -> Column:
    """The row as JSON with its failures as `_dq_reasons`."""
    return F.to_json(F.struct(*columns, F.col(failures).alias("_dq_reasons")))


def dead_letter(errors: Column, payload: Column, key: Column) -> Column:
    return F.to_json(
        F.struct(errors.alias("errors"), payload.alias("payload"), key.alias("key")), {"ignoreNullFields": "false"}
    )


def error_letter(error: Column, original: Column, moment: Column) -> Column:
    return F.to_json(
        F.struct(error.alias("error"), original.alias("originalMessage"), moment.alias("timestamp")),
        {"ignoreNullFields": "false"},
    )


def keyed_message(df: DataFrame, key: str) -> DataFrame:
    """(key, value) as a topic takes them: the key as text, the other columns as JSON."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[c for c in df.columns if c != key]), {"ignoreNullFields": "false"}).alias("value"),
    )


def topic_name(source: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(source, pattern, replacement)
