"""Rule documents (YAML or dict) turned into columns.

Three document shapes are read:

* typed rules      - `id, type, severity, message, …` (a column predicate by type);
* condition rules  - `id, severity, condition, preprocess, message, route`, where the
                     condition is a Spark SQL expression that has to hold;
* emit rules       - `name, when, emit{dq_status, metric, severity}`, with optional
                     `{t1} {t2} {pk} {hash_onprem} {hash_cloud}` place-holders per table.
"""

from __future__ import annotations

import json
import re
import operator
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from rowwarden.functions import checks
from rowwarden.operators.joins import key_join

STATUS_OF_SEVERITY = {"fail": "INVALID", "warn": "QUARANTINE"}
SEVERITIES = ("ERROR", "WARN", "INFO")
FAILURE_TYPE = "array<struct<id:string,severity:string,message:string,route:string>>"


def read_document(source: str | Path | Mapping) -> dict:
    """A rule document from a dict, a file, or text (YAML where PyYAML is there, else JSON)."""
    if isinstance(source, Mapping):
        return dict(source)
    if isinstance(source, Path) or "\n" not in source:
        source = Path(source).read_text()
    try:
        import yaml
    except ImportError:
        return json.loads(source)
    return yaml.safe_load(source)


# ---------------------------------------------------------------- typed rules

@dataclass(frozen=True)
class Rule:
    id: str
    kind: str
    severity: str = "fail"
    message: str = ""
    route: str = "invalid"
    options: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def parse(cls, raw: Mapping[str, Any]) -> Rule:
        rule_id = raw.get("id", "unknown")
        text = (raw.get("message") or "").strip() or f"rule_{rule_id}_failed"
        known = {"id", "type", "severity", "message", "route"}
        return cls(
            id=rule_id,
            kind=raw.get("type", ""),
            severity=raw.get("severity", "fail"),
            message=text,
            route=raw.get("route", "invalid"),
            options={k: v for k, v in raw.items() if k not in known},
        )

    def status(self, other: str = "UNKNOWN") -> str:
        return STATUS_OF_SEVERITY.get(self.severity, other)

    def violation(self, as_of: Column | None = None) -> Column:
        o = self.options
        nulls = o.get("null_handling", "default")
        match self.kind:
            case "required":
                names = o["fields"] if "fields" in o else [o["field"]]
                return checks.missing([F.col(n) for n in names], nulls)
            case "range" | "threshold":
                return checks.outside(F.col(o["field"]), o.get("min"), o.get("max"), nulls)
            case "regex":
                return checks.not_like(F.col(o["field"]), o["pattern"], o.get("match", "find"), nulls)
            case "timestamp_freshness" | "timestamp_fresh":
                moment = F.current_timestamp() if as_of is None else as_of
                return checks.stale(F.col(o["field"]), o["max_age_seconds"], moment)
            case "cross_field":
                return checks.disagrees(F.expr(str(o["left"])), o["op"], F.expr(str(o["right"])))
            case "lookup_in":
                return _lookup(o, checks.not_listed, hit_violates=False)
            case "lookup_not_in":
                return _lookup(o, checks.listed, hit_violates=True)
            case "custom_sql":
                return F.expr(o["sql"])
            case "schema_registry":
                # the conformance column is attached upstream (see operators.schema)
                return F.size(F.col(o.get("faults_column", "schema_faults"))) > 0
            case _:
                warnings.warn(f"rule {self.id!r}: unknown type {self.kind!r}, never violated", stacklevel=2)
                return F.lit(False)


def _lookup(options: Mapping, by_values, hit_violates: bool) -> Column:
    value = F.col(options["field"])
    if "table" in options:
        found = F.col(lookup_flag(options["field"], options["table"]))
        return found if hit_violates else value.isNotNull() & ~found
    return by_values(value, options.get("values") or [])


def lookup_flag(field_name: str, table: str) -> str:
    return f"_{field_name}_in_{table}"


def attach_lookups(df: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One boolean column per list kept in a table, for `lookup_in` / `lookup_not_in`.

    The list is reduced to its distinct values; whether it is broadcast is left to
    Spark's own size check, and a skewed field is split by AQE otherwise.
    """
    seen = set()
    for rule in rules:
        name = rule.options.get("table")
        if not name or rule.kind not in ("lookup_in", "lookup_not_in"):
            continue
        flag = lookup_flag(rule.options["field"], name)
        if flag in seen:
            continue
        seen.add(flag)
        value, listed = rule.options["field"], tables[name]
        keys = listed.select(F.col(listed.columns[0]).alias(value)).dropna().distinct()
        df = key_join(df, keys, [value], "left").withColumn(flag, F.col(f"_r_{value}").isNotNull()).drop(f"_r_{value}")
    return df


def typed_rules(source) -> list[Rule]:
    return [Rule.parse(r) for r in read_document(source).get("rules", [])]


def first_violation(rules: Sequence[Rule], as_of: Column | None = None, other: str = "UNKNOWN") -> Column:
    """struct(dq_status, dq_reason) of the first violated rule in file order."""
    def verdict(status: str, reason: str) -> Column:
        return F.struct(F.lit(status).alias("dq_status"), F.lit(reason).alias("dq_reason"))

    return checks.first_match(
        [(r.violation(as_of), verdict(r.status(other), r.message)) for r in rules],
        verdict("VALID", "OK"),
    )


def with_status(df: DataFrame, rules: Sequence[Rule], as_of: Column | None = None, other: str = "UNKNOWN") -> DataFrame:
    return df.select("*", first_violation(rules, as_of, other).alias("_v")).select(
        *df.columns, F.col("_v.dq_status"), F.col("_v.dq_reason")
    )


def _failure(rule_id: str, severity: str, message: str, route: str) -> Column:
    return F.struct(
        F.lit(rule_id).alias("id"),
        F.lit(severity).alias("severity"),
        F.lit(message).alias("message"),
        F.lit(route).alias("route"),
    )


def failures(rules: Sequence[Rule], as_of: Column | None = None) -> Column:
    """Every violated rule of a row as array<struct(id, severity, message, route)>."""
    hits = [F.when(r.violation(as_of), _failure(r.id, r.severity, r.message, r.route)) for r in rules]
    if not hits:
        return F.array().cast(FAILURE_TYPE)
    return F.array_compact(F.array(*hits))


def has_fail(failed: Column) -> Column:
    return F.exists(failed, lambda f: f["severity"] == "fail")


def verdict_route(failed: Column) -> Column:
    """`validated` without failures, `invalid` with any fail, else `quarantine`."""
    return checks.first_match([(F.size(failed) == 0, "validated"), (has_fail(failed), "invalid")], "quarantine")


# ------------------------------------------------------------ condition rules

@dataclass(frozen=True)
class Condition:
    id: str
    holds: str
    severity: str = "fail"
    message: str = ""
    route: str = "invalid"
    preprocess: tuple[tuple[str, str], ...] = ()

    @classmethod
    def parse(cls, raw: Mapping[str, Any]) -> Condition:
        steps = tuple((p["name"], p["expression"]) for p in raw.get("preprocess") or ())
        return cls(
            raw["id"], raw["condition"], raw.get("severity", "fail"), raw.get("message", ""),
            raw.get("route", "invalid"), steps,
        )


def condition_rules(source) -> list[Condition]:
    return [Condition.parse(r) for r in read_document(source).get("rules", [])]


def with_preprocess(df: DataFrame, rules: Sequence[Condition]) -> DataFrame:
    """Derived values the conditions refer to, in file order."""
    for rule in rules:
        for name, expression in rule.preprocess:
            df = df.withColumn(name, F.expr(expression))
    return df


def condition_failures(rules: Sequence[Condition]) -> Column:
    """Failures of condition rules; a condition that cannot be computed (null) fails the row.

    Such an error ends the list when the rule itself is a `fail` rule.
    """
    entries = []
    for rule in rules:
        for name, _ in rule.preprocess:
            entries.append((F.col(name).isNull(), _failure(rule.id, "fail", "preprocess error", rule.route), rule))
        outcome = F.expr(rule.holds)
        broken = outcome.isNull()
        entries.append((broken, _failure(rule.id, "fail", "condition error", rule.route), rule))
        entries.append((~outcome, _failure(rule.id, rule.severity, rule.message, rule.route), None))
    items, stopped = [], F.lit(False)
    for fires, failure, stopper in entries:
        items.append(F.when(~stopped & fires, failure))
        if stopper is not None and stopper.severity == "fail":
            stopped = stopped | fires
    return F.array_compact(F.array(*items)) if items else F.array().cast(FAILURE_TYPE)


# ----------------------------------------------------------------- emit rules

@dataclass(frozen=True)
class Emit:
    name: str
    when: str
    status: str
    reason: str
    metric: str | None
    severity: str | None

    def fires(self) -> Column:
        return F.expr(self.when)


@dataclass(frozen=True)
class TablePair:
    """One table kept on two sites, as a rule document names it."""

    name: str
    pk: str
    onprem: Mapping[str, str]
    cloud: Mapping[str, str]
    hash_onprem: str
    hash_cloud: str

    @classmethod
    def parse(cls, raw: Mapping[str, Any]) -> TablePair:
        return cls(
            raw["name"], raw["pk"], raw["sources"]["onprem"], raw["sources"]["cloud"],
            raw["hash"]["onprem_field"], raw["hash"]["cloud_field"],
        )

    def fill(self, condition: str) -> str:
        """The condition with its placeholders filled in; one that isn't known is refused."""
        known = dict(
            t1=self.onprem["alias"], t2=self.cloud["alias"], pk=self.pk,
            hash_onprem=self.hash_onprem, hash_cloud=self.hash_cloud,
        )

        def value(match: re.Match) -> str:
            if match[1] not in known:
                raise ValueError(f"table {self.name!r}: unknown placeholder {match[0]} in {condition!r}")
            return known[match[1]]

        return re.sub(r"\{([A-Za-z_]\w*)\}", value, condition)


def emit_rules(source, table: TablePair | None = None) -> list[Emit]:
    """Rules with a `when`; the others carry no condition and are passed over.

    The reason is `emit.dq_reason`, else the description, else (for a table's rules) the rule's
    name or (otherwise) OK. A rule without `emit.metric` is not counted.
    """
    rules = []
    for raw in read_document(source).get("rules", []):
        if "when" not in raw:
            continue
        emit = raw.get("emit", {})
        text = " ".join(raw["when"].split())
        reason = emit.get("dq_reason") or raw.get("description") or (raw["name"] if table else "OK")
        rules.append(
            Emit(raw["name"], table.fill(text) if table else text, emit["dq_status"], reason, emit.get("metric"), emit.get("severity"))
        )
    return rules


def table_pairs(source) -> list[TablePair]:
    return [TablePair.parse(t) for t in read_document(source).get("tables", [])]


def emitted(rules: Sequence[Emit]) -> Column:
    """struct(dq_status, dq_reason) over a joined frame whose sides are aliased as in the rules."""
    verdict = lambda status, reason: F.struct(F.lit(status).alias("dq_status"), F.lit(reason).alias("dq_reason"))
    return checks.first_match([(r.fires(), verdict(r.status, r.reason)) for r in rules], verdict("VALID", "OK"))


def emit_metrics(rules: Sequence[Emit], namespace: str = "") -> list[Column]:
    """One count per rule that names a metric: a row can count for several rules."""
    prefix = f"{namespace}." if namespace else ""
    return [F.count_if(r.fires()).alias(f"{prefix}{r.metric}") for r in rules if r.metric]


def severity_totals(rules: Sequence[Emit]) -> list[Column]:
    """Rows that hit at least one rule of a severity, a column for each severity that has rules."""
    grouped: dict[str, list[Column]] = {}
    for rule in rules:
        if rule.severity in SEVERITIES:
            grouped.setdefault(rule.severity, []).append(rule.fires())
    return [F.count_if(checks.any_of(grouped[s])).alias(f"dq_{s.lower()}_total") for s in SEVERITIES if s in grouped]
