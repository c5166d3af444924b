"""Nested conformance against a plain validator that walks parsed messages."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from rowwarden.operators import nested
from rowwarden.plans.registry import CONFIG

AVRO = json.loads((CONFIG / "order_message.avsc").read_text())
TREE = {"type": "record", "name": "Tree", "fields": [{"name": "v", "type": "int"}, {"name": "kids", "type": {"type": "array", "items": "Tree"}, "default": []}]}
SCHEMA = {
    "$schema": "http://json-schema.org/draft-07/schema#",
    "title": "thing",
    "type": "object",
    "required": ["id", "kind"],
    "properties": {
        "id": {"type": ["integer", "string"], "minimum": 1, "exclusiveMaximum": 100, "maxLength": 3},
        "kind": {"enum": ["a", 2, None, [1, "x"], {"p": 1, "q": True}]},
        "name's": {"type": "string", "pattern": "^[a-z]+$", "minLength": 2},
        "sizes": {"type": "array", "items": {"type": "number", "multipleOf": 0.5}, "minItems": 1, "maxItems": 3, "uniqueItems": True},
        "place": {"$ref": "#/definitions/place"},
        "choice": {"oneOf": [{"type": "integer"}, {"type": "number", "minimum": 5}]},
        "any": {"anyOf": [{"type": "string", "maxLength": 2}, {"type": "array", "items": {"type": "boolean"}}, {"$ref": "#/definitions/place"}]},
        "both": {"allOf": [{"type": "number"}, {"not": {"const": 7}}]},
    },
    "additionalProperties": False,
    "definitions": {
        "place": {
            "type": "object",
            "properties": {"x": {"type": "number"}, "in": {"$ref": "#/definitions/place"}},
            "required": ["x"],
            "additionalProperties": {"type": "boolean"},
            "minProperties": 1,
            "maxProperties": 3,
        }
    },
}


def is_kind(v, kind):
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    return {
        "object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool),
        "null": v is None, "number": number, "integer": number and v == int(v),
    }[kind]


def below(path, name):
    return name if path == "$" else f"{path}.{name}"


def same(a, b):
    return json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True) or (is_kind(a, "number") and is_kind(b, "number") and a == b)


def plain_schema(schema, v, path="$", root=SCHEMA):
    """Faults in the order of the keywords."""
    if isinstance(schema, bool):
        return [] if schema else [f"{path}: not allowed"]
    out = []
    sized = {"Length": (str, len), "Items": (list, len), "Properties": (dict, len)}
    for word, given in schema.items():
        if word == "$ref":
            target = root
            for step in given.split("/")[1:]:
                target = target[step]
            out += plain_schema(target, v, path, root)
        elif word == "type":
            kinds = [given] if isinstance(given, str) else given
            if not any(is_kind(v, k) for k in kinds):
                out.append(f"{path}: not {'|'.join(kinds)}")
        elif word == "enum" and not any(same(v, g) for g in given):
            out.append(f"{path}: none of {len(given)} values")
        elif word == "const" and not same(v, given):
            out.append(f"{path}: not the constant")
        elif word in ("minimum", "exclusiveMaximum") and is_kind(v, "number"):
            if (v < given) if word == "minimum" else (v >= given):
                out.append(f"{path}: {word} {given}")
        elif word == "multipleOf" and is_kind(v, "number") and v % given:
            out.append(f"{path}: {word} {given}")
        elif word == "pattern" and isinstance(v, str):
            import re

            if not re.search(given, v):
                out.append(f"{path}: {word} {given}")
        elif word[:3] in ("min", "max") and word[3:] in sized and isinstance(v, sized[word[3:]][0]):
            n = len(v)
            if (n < given) if word[:3] == "min" else (n > given):
                out.append(f"{path}: {word} {given}")
        elif word == "uniqueItems" and isinstance(v, list):
            if len({json.dumps(x, sort_keys=True) for x in v}) < len(v):
                out.append(f"{path}: repeated items")
        elif word == "items" and isinstance(v, list):
            for i, x in enumerate(v):
                out += plain_schema(given, x, f"{path}[{i}]", root)
        elif word == "required" and isinstance(v, dict):
            out += [f"{below(path, n)}: absent" for n in given if n not in v]
        elif word == "properties" and isinstance(v, dict):
            for n, s in given.items():
                if n in v:
                    out += plain_schema(s, v[n], below(path, n), root)
        elif word == "additionalProperties" and isinstance(v, dict):
            for n in sorted(v):
                if n not in schema.get("properties", {}):
                    out += plain_schema(given, v[n], below(path, n), root)
        elif word == "oneOf":
            n = sum(not plain_schema(s, v, path, root) for s in given)
            if n != 1:
                out.append(f"{path}: fits {n} of {len(given)}")
        elif word == "allOf":
            for s in given:
                out += plain_schema(s, v, path, root)
        elif word == "not" and not plain_schema(given, v, path, root):
            out.append(f"{path}: of the excluded kind")
        elif word == "anyOf":
            tried = [plain_schema(s, v, path, root) for s in given]
            if all(tried):
                near = [t for s, t in zip(given, tried) if is_kind(v, "object" if "$ref" in s else s["type"])]
                names = [s["$ref"].split("/")[-1] if "$ref" in s else s["type"] for s in given]
                out += near[0] if len(near) == 1 else [f"{path}: none of {'|'.join(names)}"]
    return out


def thing(rng, level=0):
    """A random message, about half of its parts as the schema asks."""
    anything = lambda: rng.choice([None, True, 0, 3, 7, 2.5, -1, 1e3, "", "ab", "ABC", "long text", [], {}, [True, "x"], {"x": 1}, [[1]]])

    def place(n=0):
        out = {"x": rng.choice([1, 2.5, "x"])} if rng.random() < 0.8 else {}
        if rng.random() < 0.5 and n < 3:
            out["in"] = place(n + 1)
        if rng.random() < 0.3:
            out[rng.choice(["open", "far"])] = rng.choice([True, False, 1])
        return out

    good = {
        "id": lambda: rng.choice([1, 50, 100, 0, "abc", "abcd", 2.0, 2.5]),
        "kind": lambda: rng.choice(["a", 2, 2.0, None, [1, "x"], ["x", 1], {"q": True, "p": 1}, {"p": 1}, "b"]),
        "name's": lambda: rng.choice(["ab", "a", "AB"]),
        "sizes": lambda: [rng.choice([1, 1.5, 0.25, "x"]) for _ in range(rng.randrange(5))],
        "place": place,
        "choice": lambda: rng.choice([1, 5, 5.5, 2.5, "x", 6.0]),
        "any": lambda: rng.choice(["ab", "abc", [True], [True, 1], place(), 3, None]),
        "both": lambda: rng.choice([7, 8, 7.0, "x"]),
    }
    out = {n: (make() if rng.random() < 0.8 else anything()) for n, make in good.items() if rng.random() < 0.8}
    if rng.random() < 0.2:
        out[rng.choice(["zzz", "Extra one", "a.b"])] = anything()
    return out if rng.random() < 0.95 else anything()


def found(spark, messages, check):
    rows = spark.createDataFrame(list(enumerate(messages)), "i int, raw string").repartition(3)
    return {r.i: r.f for r in rows.select("i", nested.faults(F.col("raw"), check).alias("f")).collect()}


def test_json_schema_equals_the_plain_validator(spark):
    rng = random.Random(4)
    values = [thing(rng) for _ in range(1200)]
    got = found(spark, [json.dumps(v) for v in values], nested.json_schema(SCHEMA))
    for i, v in enumerate(values):
        assert got[i] == plain_schema(SCHEMA, v), v
    assert sum(not f for f in got.values()) > 1 and len({f for fs in got.values() for f in fs}) > 40


def test_malformed_messages(spark):
    got = found(spark, ["", "{", None, '{"id":1,"id":2}', "nonsense", "null", "3"], nested.json_schema({"type": "object"}))
    assert got == {0: ["$: malformed"], 1: ["$: malformed"], 2: ["$: malformed"], 3: ["$: malformed"], 4: ["$: malformed"], 5: ["$: not object"], 6: ["$: not object"]}


def plain_avro(kind, v, path, named):
    own = kind if isinstance(kind, dict) else {}
    form = own.get("type", kind) if own else kind
    if isinstance(kind, list):
        tried = [plain_avro(b, v, path, named) for b in kind]
        if not all(tried):
            return []
        form_of = lambda b: named.get(b, {}).get("type", b) if isinstance(b, str) else b["type"]
        kinds = {"record": "object", "map": "object", "enum": "string", "int": "number", "long": "number", "double": "number"}
        near = [t for b, t in zip(kind, tried) if is_kind(v, kinds.get(form_of(b), form_of(b)))]
        return near[0] if len(near) == 1 else [f"{path}: none of {'|'.join(b if isinstance(b, str) else b['name'] for b in kind)}"]
    if isinstance(form, dict):
        return plain_avro(form, v, path, named)
    if form in named and not own:
        own, form = named[form], named[form]["type"]
    whole = isinstance(v, int) and not isinstance(v, bool)
    if form == "record":
        if not isinstance(v, dict):
            return [f"{path}: not record"]
        out = []
        for f in own["fields"]:
            if f["name"] in v:
                out += plain_avro(f["type"], v[f["name"]], below(path, f["name"]), named)
            elif "default" not in f:
                out.append(f"{below(path, f['name'])}: absent")
        return out
    if form == "array":
        return [x for i, e in enumerate(v) for x in plain_avro(own["items"], e, f"{path}[{i}]", named)] if isinstance(v, list) else [f"{path}: not array"]
    if form == "map":
        return [x for k in sorted(v) for x in plain_avro(own["values"], v[k], below(path, k), named)] if isinstance(v, dict) else [f"{path}: not map"]
    if form == "enum":
        return [] if v in own["symbols"] else [f"{path}: not one of {'|'.join(own['symbols'])}"]
    ok = {
        "int": whole and -(2**31) <= v < 2**31 if whole else False, "long": whole, "double": is_kind(v, "number"), "string": isinstance(v, str), "null": v is None,
    }[form]
    return [] if ok else [f"{path}: not {form}"]


def order(rng):
    line = lambda: rng.choice([{"part": 1, "price": 2.5}, {"part": 1.5, "price": 1}, {"price": "x", "remark": 3}, {"part": 1, "price": None, "more": 1}, 4, None])

    def note(n=0):
        out = {"code": rng.choice([1, 2**31, "x"])}
        if n < 4 and rng.random() < 0.7:
            out["about"] = rng.choice([None, note(n + 1), note(n + 1), 5])
        return out

    parts = {
        "id": [1, 2**40, "1", 1.0, None],
        "buyer": [None, {"key": 1, "tier": "gold"}, {"key": 2**31, "tier": "tin"}, {"tier": 4}, [], "x"],
        "lines": [[line() for _ in range(rng.randrange(4))], {}, None],
        "labels": [{"a": "x"}, {"b": 1, "a": None}, {}, [], None],
        "note": [None, "text", note(), note(), True, [1]],
    }
    return {k: rng.choice(v) for k, v in parts.items() if rng.random() < 0.9}


def test_avro_equals_the_plain_validator(spark):
    rng = random.Random(9)
    values = [order(rng) for _ in range(800)] + [3, None, [], "x"]
    named = {"Note": AVRO["fields"][4]["type"][2]}
    got = found(spark, [json.dumps(v) for v in values], nested.avro(AVRO))
    for i, v in enumerate(values):
        assert got[i] == plain_avro(AVRO, v, "$", named), v


def test_recursion_is_cut_with_a_fault(spark):
    deep = {"v": 0, "kids": []}
    for n in range(1, 6):
        deep = {"v": n, "kids": [deep]}
    got = found(spark, [json.dumps(deep), json.dumps(deep["kids"][0])], nested.avro(TREE, depth=4))
    assert got == {0: ["kids[0].kids[0].kids[0].kids[0].kids[0]: deeper than 4 levels"], 1: []}


def test_unknown_parts_of_a_document_are_refused():
    with pytest.raises(ValueError, match="unknown keyword: dependencies"):
        nested.json_schema({"dependencies": {}})
    with pytest.raises(ValueError, match="inside the document"):
        nested.json_schema({"properties": {"a": {"$ref": "http://elsewhere/x"}}})
    with pytest.raises(ValueError, match="unknown Avro type"):
        nested.avro("decimal128")


@pytest.mark.parametrize(
    "kind, good, bad",
    [
        ("boolean", ["true"], ["1", '"true"', "null"]),
        ("bytes", ['"\\u00ff"'], ["1"]),
        ("float", ["1", "1.5", "1e3"], ['"1"']),
        ({"type": "fixed", "name": "F", "size": 3}, ['"abc"'], ['"ab"', "123"]),
        ({"type": "string", "logicalType": "uuid"}, ['"123e4567-e89b-12d3-a456-426614174000"'], ['"x"', "5"]),
        ({"type": "long", "logicalType": "timestamp-millis"}, ["1700000000000"], ["1.5", "9223372036854775808"]),
        ({"type": "map", "values": {"type": "array", "items": "int"}}, ['{"a":[1,2],"b":[]}'], ['{"a":[1,"x"]}', "[]"]),
        ([{"type": "map", "values": "int"}, {"type": "array", "items": "int"}], ['{"a":1}', "[1]"], ["3", '{"a":"x"}']),
    ],
)
def test_avro_types(spark, kind, good, bad):
    got = found(spark, [*good, *bad], nested.avro(kind))
    assert [bool(got[i]) for i in range(len(got))] == [False] * len(good) + [True] * len(bad)


def test_fault_counts_take_positions_together(spark):
    messages = [json.dumps({"id": 1, "buyer": None, "lines": [{"part": "x", "price": 1}] * n}) for n in (2, 3, 0)]
    rows = spark.createDataFrame(list(enumerate(messages)), "i int, raw string")
    counted = nested.fault_counts(nested.conforming(rows, "raw", nested.avro(AVRO)))
    assert [tuple(r) for r in counted.collect()] == [("lines[].part: not long", 2, 5)]
