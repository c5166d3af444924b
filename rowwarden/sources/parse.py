"""JSON text to typed rows, with or without a dead letter for broken text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MALFORMED = "no JSON object"
_CORRUPT = "_corrupt"


def _parsed_once(df: DataFrame, parsed: Column, keep: Sequence[str]) -> DataFrame:
    """`j`, the parsed struct, evaluated once per row.

    As a plain column Spark would copy the parse into every filter pushed below it; a
    generated row is where such copying ends.
    """
    return df.select(*keep, F.explode(F.array(parsed)).alias("j"))


def typed(df: DataFrame, raw: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns of the JSON text; a field of another type comes out null."""
    return _parsed_once(df, F.from_json(F.col(raw), schema, {"mode": "PERMISSIVE"}), keep).select(*keep, "j.*")


def messages(df: DataFrame, raw: str, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """`keep`, `malformed`, and of each named field its variant in `j` and its kind `k_<name>`.

    Only the named fields are built, and text that is no JSON object is malformed.
    """
    schema = ", ".join([*[f"`{n}` variant" for n in names], f"{_CORRUPT} string"])
    parsed = F.from_json(F.col(raw), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return _parsed_once(df, parsed, keep).select(
        *keep,
        "j",
        (F.col("j").isNull() | F.col(f"j.{_CORRUPT}").isNotNull()).alias("malformed"),
        *[F.schema_of_variant(F.col(f"j.{n}")).alias(f"k_{n}") for n in names],
    )


def well_formed(df: DataFrame, raw: str, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows whose text is JSON; the others are dropped."""
    return messages(df, raw, names, keep).where(~F.col("malformed"))


def with_errors(df: DataFrame, raw: str, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """All rows; malformed text gets `errors = [no JSON object]` and a null payload."""
    kept = [raw, *[c for c in keep if c != raw]]
    return messages(df, raw, names, kept).withColumns(
        {
            "errors": F.when(F.col("malformed"), F.array(F.lit(MALFORMED))).otherwise(F.array().cast("array<string>")),
            "payload": F.when(~F.col("malformed"), F.col(raw)),
        }
    )
