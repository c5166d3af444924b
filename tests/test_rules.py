import json
import warnings

import pytest
from pyspark.sql import functions as F

from rowwarden.functions import checks, jsontext
from rowwarden.operators import rules, schema
from rowwarden.sources import parse

CUSTOMER = {"customer_id": "string", "email": "string", "age": "int"}


def messages(spark, *records):
    texts = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(texts, "n int, raw string")
    return parse.messages(df, "raw", list(CUSTOMER), ["n"]).orderBy("n")


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "record, faults",
    [
        ({"customer_id": "C1", "email": "test@domain.com", "age": 40}, []),
        ({"customer_id": "C1", "age": 40}, ["email: absent"]),
        ({"customer_id": "C1", "email": "test@domain.com", "age": "40"}, ["age: not int"]),
        ({"customer_id": "C1", "email": "test@domain.com", "age": True}, ["age: not int"]),
        ({"customer_id": "C1", "email": None, "age": 1.5}, ["email: not string", "age: not int"]),
    ],
)
def test_schema_cases(spark, record, faults):
    assert values(messages(spark, record), schema.conformance_faults(CUSTOMER)) == [faults]


@pytest.mark.parametrize("age, passes", [(29, True), ("29", False)])
def test_datatype_cases(spark, age, passes):
    faults = schema.conformance_faults({"age": "int"})
    assert values(messages(spark, {"age": age}), F.size(faults) == 0) == [passes]


@pytest.mark.parametrize("email, age, passes", [("t@t.com", 30, True), ("t@t.com", -4, False), ("not-an-email", 30, False)])
def test_business_cases(spark, email, age, passes):
    df = messages(spark, {"email": email, "age": age})
    bad = checks.outside(jsontext.number("age"), 0) | checks.not_like(jsontext.text("email"), checks.EMAIL_PREFIX, "prefix")
    assert values(df, ~bad) == [passes]


def test_parse_tells_absent_null_and_malformed_apart(spark):
    df = messages(spark, {"age": None}, {}, "{bad", "[1]", {"age": 3})
    got = [(r.malformed, r.k_age) for r in df.collect()]
    assert got == [(False, "VOID"), (False, None), (True, None), (True, None), (False, "BIGINT")]


def test_parse_runs_once_below_a_filter(spark):
    df = spark.createDataFrame([(1, "{}")], "n int, raw string")
    plan = parse.well_formed(df, "raw", ["age"], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("nulls, expected", [("default", [False, True, False]), ("skip", [False, True, False]), ("fail", [False, True, True])])
def test_regex_null_handling(spark, nulls, expected):
    df = spark.createDataFrame([(1, "ab"), (2, "zz"), (3, None)], "n int, v string").orderBy("n")
    rule = rules.Rule.parse({"id": "r", "type": "regex", "field": "v", "pattern": "a", "null_handling": nulls})
    assert values(df, F.coalesce(rule.violation(), F.lit(False))) == expected


@pytest.mark.parametrize("match, expected", [("find", [False, False, False]), ("prefix", [True, False, False]), ("full", [True, True, False])])
def test_regex_modes(spark, match, expected):
    df = spark.createDataFrame([(1, "xab"), (2, "abx"), (3, "ab")], "n int, v string").orderBy("n")
    rule = rules.Rule.parse({"id": "r", "type": "regex", "field": "v", "pattern": "ab", "match": match})
    assert values(df, rule.violation()) == expected


def test_bounds_are_valid(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 100.0), (3, 100.5), (4, -0.5), (5, None)], "n int, v double").orderBy("n")
    rule = {"id": "r", "type": "range", "field": "v", "min": 0, "max": 100}
    assert values(df, F.coalesce(rules.Rule.parse(rule).violation(), F.lit(False))) == [False, False, True, True, False]
    strict = rules.Rule.parse({**rule, "null_handling": "fail"})
    assert values(df, strict.violation()) == [False, False, True, True, True]


def test_first_match_follows_file_order_and_null_does_not_fire(spark):
    document = {
        "rules": [
            {"id": "a", "type": "custom_sql", "sql": "v != 'x'", "severity": "warn", "message": "not x"},
            {"id": "b", "type": "required", "fields": ["v"], "severity": "fail", "message": ""},
            {"id": "c", "type": "lookup_in", "field": "v", "values": ["x"], "severity": "note"},
        ]
    }
    df = spark.createDataFrame([(1, "y"), (2, None), (3, "x")], "n int, v string").orderBy("n")
    out = rules.with_status(df, rules.typed_rules(document)).orderBy("n").collect()
    assert [(r.dq_status, r.dq_reason) for r in out] == [
        ("QUARANTINE", "not x"), ("INVALID", "rule_b_failed"), ("VALID", "OK"),
    ]


def test_quotes_in_messages_are_data(spark):
    rule = {"id": "q", "type": "required", "fields": ["v"], "message": "it's; DROP"}
    df = spark.createDataFrame([(None,)], "v string")
    assert rules.with_status(df, rules.typed_rules({"rules": [rule]})).first().dq_reason == "it's; DROP"


def test_unknown_type_warns_and_never_fires(spark):
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        column = rules.Rule.parse({"id": "u", "type": "telepathy"}).violation()
    assert caught and values(spark.range(1), column) == [False]


def test_cross_field_refuses_other_operators(spark):
    with pytest.raises(ValueError):
        checks.disagrees(F.lit(1), "; drop", F.lit(2))


def test_condition_error_stops_after_fail_rule(spark):
    document = {
        "rules": [
            {"id": "w", "severity": "warn", "condition": "v > 0", "message": "low"},
            {"id": "f", "severity": "fail", "condition": "v > 1", "message": "lower"},
            {"id": "g", "severity": "fail", "condition": "false", "message": "never holds"},
        ]
    }
    df = spark.createDataFrame([(1, None), (2, 1)], "n int, v int").orderBy("n")
    failed = rules.condition_failures(rules.condition_rules(document))
    got = [[(f.id, f.severity, f.message) for f in r[0]] for r in df.select(failed).collect()]
    assert got == [
        [("w", "fail", "condition error"), ("f", "fail", "condition error")],
        [("f", "fail", "lower"), ("g", "fail", "never holds")],
    ]


def test_routes_by_severity(spark):
    document = {
        "rules": [
            {"id": "f", "type": "range", "field": "v", "min": 0},
            {"id": "w", "type": "range", "field": "v", "max": 10, "severity": "warn", "route": "quarantine"},
        ]
    }
    df = spark.createDataFrame([(1, 5), (2, -1), (3, 11)], "n int, v int").orderBy("n")
    failed = rules.failures(rules.typed_rules(document))
    assert values(df, rules.verdict_route(failed)) == ["validated", "invalid", "quarantine"]


def test_documents_from_yaml_json_and_file(tmp_path):
    document = {"rules": [{"id": "a", "type": "required", "fields": ["x"]}]}
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(document))
    assert rules.read_document(path) == rules.read_document(str(path)) == rules.read_document(document)
    assert rules.read_document("rules:\n  - id: a\n    type: required\n    fields: [x]\n") == document


def test_severity_without_rules_gives_no_column(spark):
    emits = rules.emit_rules(
        {"rules": [{"name": "a", "when": "id > 1", "emit": {"dq_status": "X", "severity": "WARN"}}, {"name": "b"}]}
    )
    out = spark.range(4).agg(*rules.severity_totals(emits))
    assert out.columns == ["dq_warn_total"] and out.first()[0] == 2


def test_evolution_branches(spark):
    base = ("s", "record")
    old = [("kept", "int", False, False, True), ("gone", "int", False, False, True), ("up", "int", False, False, True),
           ("down", "long", False, False, True), ("odd", "record", False, False, False)]
    new = [("kept", "int", False, False, True), ("up", "double", False, False, True), ("down", "int", False, False, True),
           ("odd", "record", False, False, False), ("bare", "int", False, False, True), ("nul", "int", True, False, True),
           ("dft", "int", False, True, True)]
    rows = [(base[0], v, base[1], *f) for v, fs in ((1, old), (2, new)) for f in fs] + [("s", 0, "record", "x", "int", False, False, True)]
    registry = spark.createDataFrame(
        rows, "subject string, version int, kind string, field string, type string, nullable boolean, has_default boolean, simple boolean"
    )
    got = {(r.level, r.change) for r in schema.evolution(registry).collect()}
    assert got == {
        ("break", "dropped: gone"),
        ("break", "needs default: bare"),
        ("break", "retyped: down long -> int"),
        ("warn", "nested, look closer: odd"),
    }


def test_full_match_refuses_a_trailing_newline(spark):
    df = spark.createDataFrame([("abc",), ("abc\n",), ("xabc",)], "t string")
    full = [r[0] for r in df.select(checks.not_like(F.col("t"), "abc", "full")).collect()]
    assert full == [False, True, True]
    lines = spark.createDataFrame([("x\nabc",)], "t string").select(checks.not_like(F.col("t"), "(?m)abc", "prefix")).first()[0]
    assert lines is True


def test_bounds_pass_over_broken_numbers(spark):
    df = spark.createDataFrame([("5",), ("abc",), ("-1",), (None,)], "t string")
    assert [r[0] for r in df.select(F.coalesce(checks.outside(F.col("t"), 0, 10), F.lit(False))).collect()] == [False, False, True, False]


def test_emit_reason_metric_and_placeholders(tmp_path):
    path = tmp_path / "r.yaml"
    path.write_text(
        "tables: [{name: t, pk: k, sources: {onprem: {alias: a}, cloud: {alias: b}}, hash: {onprem_field: h, cloud_field: c}}]\n"
        "rules:\n- {name: one, when: '{t1}.x = 1', emit: {dq_status: S, dq_reason: why, metric: m}}\n"
        "- {name: two, when: '{t2}.{pk} is null', emit: {dq_status: S}}\n- {name: three, when: '{t3}.x = 1', emit: {dq_status: S}}\n"
    )
    pair = rules.table_pairs(path)[0]
    with pytest.raises(ValueError, match="t3"):
        rules.emit_rules(path, pair)
    path.write_text(path.read_text().replace("{t3}", "{t1}"))
    got = rules.emit_rules(path, pair)
    assert [(r.when, r.reason, r.metric) for r in got] == [("a.x = 1", "why", "m"), ("b.k is null", "two", None), ("a.x = 1", "three", None)]
    assert [r.reason for r in rules.emit_rules(path)] == ["why", "OK", "OK"]
    assert len(rules.emit_metrics(got)) == 1


def test_quoted_field_takes_the_last(spark):
    df = spark.createDataFrame([('{"t":"first",\n"t" : "last"}',), ("{}",)], "raw string")
    assert [r[0] for r in df.select(jsontext.quoted_field(F.col("raw"), "t")).collect()] == ["last", None]
