"""Schema conformance of JSON records and evolution between schema versions."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowwarden.functions import jsontext

# The kinds of JSON value a declared type takes (a boolean is no integer),
# and type changes that keep old readers working.
WHOLE, NUMERIC = ("int", "long"), ("float", "double")
FAULT_NAME = {"int": "int", "long": "int", "float": "float", "double": "float", "string": "string", "boolean": "boolean"}
PROMOTABLE = {
    ("int", "long"), ("int", "float"), ("int", "double"), ("long", "double"), ("float", "double"),
}


def _has_type(name: str, declared: str) -> Column:
    if declared in WHOLE:
        return jsontext.kind(name) == jsontext.INTEGER
    if declared in NUMERIC:
        return jsontext.is_number(name)
    return jsontext.kind(name) == {"string": jsontext.TEXT, "boolean": jsontext.BOOLEAN}[declared]


def fault(name: str, declared: str, types: bool = True) -> Column:
    """What is wrong with one field of a parsed message, null when nothing is.

    Types that are not simple (unions, records) are checked for presence only.
    """
    test = F.when(~jsontext.present(name), F.lit(f"{name}: absent"))
    if types and declared in FAULT_NAME:
        test = test.when(~_has_type(name, declared), F.lit(f"{name}: not {FAULT_NAME[declared]}"))
    return test


def conformance_faults(declared: Mapping[str, str], types: bool = True) -> Column:
    """Faults of a parsed message in field order, empty when it conforms."""
    return F.array_compact(F.array(*[fault(n, t, types) for n, t in declared.items()]))


def fault_text(declared: Mapping[str, str], types: bool = True) -> Column:
    """The same faults as one text; stays within generated code."""
    return F.concat_ws("; ", *[fault(n, t, types) for n, t in declared.items()])


def required_present(names: Sequence[str]) -> Column:
    return reduce(operator.and_, [jsontext.present(n) for n in names], F.lit(True))


def version_rows(registry: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """The registry rows of an old and a new version per subject, with both numbers.

    Without `pairs` (subject, old_version, new_version) these are the last two versions:
    ranked, so that earlier ones are cut before the shuffle.
    """
    if pairs is not None:
        return registry.join(pairs, "subject").where("version in (old_version, new_version)")
    subject = Window.partitionBy("subject")
    return (
        registry.withColumn("_rank", F.dense_rank().over(subject.orderBy(F.desc("version"))))
        .where("_rank <= 2")
        .withColumns({"old_version": F.min("version").over(subject), "new_version": F.max("version").over(subject)})
        .where("old_version < new_version")
        .drop("_rank")
    )


def evolution(registry: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Breaks and warnings between two versions of each subject.

    `registry` rows are (subject, version, kind, field, type, nullable, has_default, simple);
    `pairs` defaults to the last two versions. Gives (subject, old_version, new_version,
    level, change), where level is `break` or `warn`.

    All steps are keyed by subject and share one shuffle: both versions of a field meet in
    an aggregate by (subject, field), and what holds for the whole subject comes from
    windows over the few rows of its two versions.
    """
    subject = Window.partitionBy("subject")
    rows = version_rows(registry, pairs).withColumns(
        {
            "_odd": F.max(F.col("kind") != "record").over(subject),
            "_first": F.row_number().over(subject.orderBy("field", "version")) == 1,
            "_side": F.when(F.col("version") == F.col("old_version"), "old").otherwise("new"),
        }
    )

    def on(side: str, column: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(column))).alias(f"{side}_{column}")

    fields = rows.groupBy("subject", "old_version", "new_version", "_odd", "field").agg(
        F.max("_first").alias("_first"),
        *[on(side, c) for side in ("old", "new") for c in ("type", "nullable", "has_default", "simple")],
    )
    promotable = reduce(
        operator.or_,
        [(F.col("old_type") == a) & (F.col("new_type") == b) for a, b in sorted(PROMOTABLE)],
    )
    removed, added = F.col("new_type").isNull(), F.col("old_type").isNull()
    opaque = ~F.col("old_simple") | ~F.col("new_simple")
    bare = ~F.col("new_has_default") & ~F.col("new_nullable")
    changed = (F.col("old_type") != F.col("new_type")) & ~promotable

    def finding(level: str, *text) -> Column:
        parts = [F.lit(t) if t.endswith(" ") else F.col(t) for t in text]
        return F.struct(F.lit(level).alias("level"), F.concat(*parts).alias("change"))

    not_record = F.struct(
        F.lit("warn").alias("level"), F.lit("kind: no record, fields not compared").alias("change")
    )
    found = (
        F.when(F.col("_odd"), F.when(F.col("_first"), not_record))
        .when(removed, finding("break", "dropped: ", "field"))
        .when(added, F.when(bare, finding("break", "needs default: ", "field")))
        .when(opaque, finding("warn", "nested, look closer: ", "field"))
        .when(changed, finding("break", "retyped: ", "field", " ", "old_type", " -> ", "new_type"))
    )
    return (
        fields.select("subject", "old_version", "new_version", found.alias("_f"))
        .where("_f is not null")
        .select("subject", "old_version", "new_version", "_f.level", "_f.change")
    )


def drift_counts(changes: DataFrame) -> DataFrame:
    """Subjects drifted, and columns removed, over an evolution report."""
    return changes.agg(
        F.count_distinct("subject").alias("dq_schema_drift_detected"),
        F.count_if(F.col("change").startswith("dropped: ")).alias("dq_column_removed"),
        F.count_if(F.col("level") == "break").alias("breaks"),
        F.count_if(F.col("level") == "warn").alias("warns"),
    )
