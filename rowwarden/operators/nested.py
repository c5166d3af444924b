"""Conformance of nested JSON messages to a schema document, Avro or JSON Schema.

A document is compiled once, on the driver, into one column: the faults of a message as `path: what`, in the
order of the document. Records, arrays, maps, enums, unions with a trial of each branch and references
inside the document are followed; recursive types are unrolled to `depth` levels, and a value
below that is a fault, not a pass. The message is parsed once, and every value is taken out of its parent
once: each level is a lambda over the value, so the column grows with the document and not with its paths.

    conforming(messages, "raw", avro(document))          # the rows with their faults
    messages.where(F.size(faults(F.col("raw"), json_schema(document))) > 0)

Paths read `lines[2].price`, the message itself is `$`. A text that is no JSON object or value (or has a name twice in
one object), and null, are `$: malformed`.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Check = Callable[[Column, Column, int], Column]  # (value, path, levels left) -> faults
DEPTH = 8

# What the documents call things, and the annotations that say nothing about a value.
ANNOTATIONS = {"title", "description", "$schema", "$id", "$comment", "default", "examples", "format", "definitions", "$defs", "deprecated"}
AVRO_INT = (-(2**31), 2**31 - 1)
UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


# ------------------------------------------------------------------ values


def _none() -> Column:
    return F.array().cast("array<string>")


def _fault(bad: Column, path: Column, what: str) -> Column:
    return F.when(bad, F.array(F.concat(path, F.lit(f": {what}")))).otherwise(_none())


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _join(parts: Sequence[Column]) -> Column:
    return F.concat(*parts) if parts else _none()


def _part(value: Column, name: str, path: Column, inner: Check, left: int, absent: Column) -> Column:
    """Faults of one field of an object; `absent` if the object lacks it."""
    at = _below(path, name)
    return _bound(_field(value, name), lambda v: F.when(v.isNull(), absent).otherwise(inner(v, at, left)))


def _field(value: Column, name: str) -> Column:
    """A field of an object, null if it is absent."""
    if "'" not in name and "\\" not in name:
        return F.try_variant_get(value, f"$['{name}']", "variant")
    return F.try_element_at(_entries(value), F.lit(name))


def _entries(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _number(value: Column) -> Column:
    return _bound(_kind(value), lambda k: k.isin("BIGINT", "DOUBLE") | k.startswith("DECIMAL"))


def _whole(value: Column) -> Column:
    """A number without a fraction, however it is written."""
    return _number(value) & (_double(value) == F.floor(_double(value)))


IS: dict[str, Callable[[Column], Column]] = {
    "object": lambda v: _entries(v).isNotNull(),
    "array": lambda v: _elements(v).isNotNull(),
    "string": lambda v: _kind(v) == "STRING",
    "boolean": lambda v: _kind(v) == "BOOLEAN",
    "null": lambda v: F.is_variant_null(v),
    "number": _number,
    "integer": _whole,
}


def _below(path: Column, name: str) -> Column:
    return F.when(path == "$", F.lit(name)).otherwise(F.concat(path, F.lit(f".{name}")))


def _below_key(path: Column, key: Column) -> Column:
    return F.when(path == "$", key).otherwise(F.concat_ws(".", path, key))


def _each_element(check: Check, value: Column, path: Column, left: int) -> Column:
    at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
    return F.flatten(F.transform(_elements(value), lambda x, i: check(x, at(i), left)))


def _each_entry(check: Check, value: Column, path: Column, left: int, skip: Sequence[str] = ()) -> Column:
    entries = F.map_entries(_entries(value))
    if skip:
        entries = F.filter(entries, lambda e: ~e["key"].isin(*skip))
    return F.flatten(F.transform(entries, lambda e: check(e["value"], _below_key(path, e["key"]), left)))


def _branches(checks: Sequence[Check], shapes: Sequence[Callable[[Column], Column] | None], names: Sequence[str]) -> Check:
    """No fault if one branch has none; else those of the branch that has the value's shape, if only one has."""

    def check(value: Column, path: Column, left: int) -> Column:
        def judged(tried: Column) -> Column:
            fits = [shape(value).cast("int") if shape else F.lit(0) for shape in shapes]
            near = reduce(operator.add, fits)
            own = F.coalesce(*[F.when(f == 1, F.get(tried, F.lit(i))) for i, f in enumerate(fits)])
            nowhere = F.array(F.concat(path, F.lit(f": none of {'|'.join(names)}")))
            return F.when(F.exists(tried, lambda t: F.size(t) == 0), _none()).otherwise(F.when(near == 1, own).otherwise(nowhere))

        return _bound(F.array(*[c(value, path, left) for c in checks]), judged)

    return check


# ------------------------------------------------------------------ Avro


def avro(document: Mapping | Sequence | str, depth: int = DEPTH) -> Check:
    """The check of an Avro document on messages in plain JSON.

    A field with a default may be absent, other fields may not; fields the document lacks are let
    pass. Union branches are not wrapped in their names.
    """
    named: dict[str, Mapping] = {}

    def note(kind) -> None:
        if isinstance(kind, list):
            for branch in kind:
                note(branch)
        elif isinstance(kind, Mapping):
            if "name" in kind and kind.get("type") in ("record", "enum", "fixed"):
                named[kind["name"]] = kind
                if kind.get("namespace"):
                    named[f"{kind['namespace']}.{kind['name']}"] = kind
            for field in kind.get("fields", ()):
                note(field["type"])
            for part in ("items", "values"):
                if part in kind:
                    note(kind[part])
            if not isinstance(kind.get("type", ""), str):
                note(kind["type"])

    def label(kind) -> str:
        if isinstance(kind, Mapping):
            return kind.get("name") or label(kind["type"])
        return "union" if isinstance(kind, list) else kind

    def shape(kind) -> Callable[[Column], Column] | None:
        plain = kind.get("type") if isinstance(kind, Mapping) else kind
        if plain in named:
            return shape(named[plain])
        return {
            "record": IS["object"], "map": IS["object"], "array": IS["array"], "enum": IS["string"], "string": IS["string"], "bytes": IS["string"],
            "fixed": IS["string"], "null": IS["null"], "boolean": IS["boolean"], "int": IS["number"], "long": IS["number"], "float": IS["number"],
            "double": IS["number"],
        }.get(plain if isinstance(plain, str) else "")

    def scalar(is_one: Callable[[Column], Column], what: str) -> Check:
        return lambda value, path, left: _fault(~is_one(value), path, f"not {what}")

    def build(kind) -> Check:
        if isinstance(kind, list):
            return _branches([build(b) for b in kind], [shape(b) for b in kind], [label(b) for b in kind])
        if isinstance(kind, Mapping) and not isinstance(kind["type"], str):
            return build(kind["type"])
        form = kind["type"] if isinstance(kind, Mapping) else kind
        own = kind if isinstance(kind, Mapping) else {}
        if form in named and form not in ("record", "enum", "fixed"):
            return follow(named[form])
        if form == "record":
            return record(own)
        if form == "enum":
            return scalar(lambda v: (_kind(v) == "STRING") & _text(v).isin(*own["symbols"]), f"one of {'|'.join(own['symbols'])}")
        if form == "array":
            return container("array", build(own["items"]), _each_element)
        if form == "map":
            return container("object", build(own["values"]), _each_entry, "map")
        if form == "fixed":
            return scalar(lambda v: (_kind(v) == "STRING") & (F.char_length(_text(v)) == own["size"]), f"text of {own['size']}")
        if form == "string" and own.get("logicalType") == "uuid":
            return scalar(lambda v: (_kind(v) == "STRING") & _text(v).rlike(UUID), "uuid")
        if form == "int":
            return scalar(lambda v: (_kind(v) == "BIGINT") & F.try_variant_get(v, "$", "bigint").between(*AVRO_INT), "int")
        simple = {"long": lambda v: _kind(v) == "BIGINT", "float": _number, "double": _number, "bytes": IS["string"]}
        if form in simple:
            return scalar(simple[form], form)
        if form in ("string", "boolean", "null"):
            return scalar(IS[form], form)
        raise ValueError(f"unknown Avro type: {form}")

    def follow(target: Mapping) -> Check:
        def check(value: Column, path: Column, left: int) -> Column:
            if left == 0:
                return F.array(F.concat(path, F.lit(f": deeper than {depth} levels")))
            return build(target)(value, path, left - 1)

        return check

    def container(kind: str, inner: Check, each: Callable, name: str | None = None) -> Check:
        return lambda value, path, left: F.coalesce(each(inner, value, path, left), F.array(F.concat(path, F.lit(f": not {name or kind}"))))

    def record(own: Mapping) -> Check:
        def check(value: Column, path: Column, left: int) -> Column:
            parts = []
            for field in own["fields"]:
                absent = _none() if "default" in field else F.array(F.concat(_below(path, field["name"]), F.lit(": absent")))
                parts.append(_part(value, field["name"], path, build(field["type"]), left, absent))
            return F.when(IS["object"](value), _join(parts)).otherwise(F.array(F.concat(path, F.lit(": not record"))))

        return check

    if isinstance(document, str):
        document = {"type": document}
    note(document)
    return _start(build(document), depth)


# ------------------------------------------------------------------ JSON Schema


def json_schema(document: Mapping | bool, depth: int = DEPTH) -> Check:
    """The check of a JSON Schema document; a keyword that is not understood is refused, not passed over."""

    def target(reference: str):
        if not reference.startswith("#"):
            raise ValueError(f"only references inside the document are followed: {reference}")
        found = document
        for step in [s for s in reference[1:].split("/") if s]:
            found = found[step.replace("~1", "/").replace("~0", "~")]
        return found

    def shape(schema) -> Callable[[Column], Column] | None:
        if isinstance(schema, Mapping) and "$ref" in schema:
            schema = target(schema["$ref"])
        kinds = schema.get("type") if isinstance(schema, Mapping) else None
        if kinds is None:
            return None
        kinds = [kinds] if isinstance(kinds, str) else kinds
        return lambda v: reduce(operator.or_, [IS["number" if k == "integer" else k](v) for k in kinds])

    def only(kind: str, test: Callable[[Column], Column], what: str) -> Check:
        """A fault where a value of the kind fails the test; other values are not concerned."""
        return lambda value, path, left: _fault(IS[kind](value) & ~test(value), path, what)

    def build(schema) -> Check:
        if schema is True:
            return lambda value, path, left: _none()
        if schema is False:
            return lambda value, path, left: F.array(F.concat(path, F.lit(": not allowed")))
        checks = [keyword(name, given, schema) for name, given in schema.items() if name not in ANNOTATIONS]
        return lambda value, path, left: _join([c(value, path, left) for c in checks])

    def keyword(name: str, given, schema: Mapping) -> Check:
        if name == "$ref":
            return follow(given)
        if name == "type":
            kinds = [given] if isinstance(given, str) else given
            return lambda value, path, left: _fault(~reduce(operator.or_, [IS[k](value) for k in kinds]), path, f"not {'|'.join(kinds)}")
        if name in ("enum", "const"):
            values = given if name == "enum" else [given]
            return lambda value, path, left: _fault(~_among(value, values), path, f"none of {len(values)} values" if name == "enum" else "not the constant")
        bounds = {
            "minimum": operator.ge, "maximum": operator.le, "exclusiveMinimum": operator.gt, "exclusiveMaximum": operator.lt,
        }
        if name in bounds:
            return only("number", lambda v: bounds[name](_double(v), F.lit(float(given))), f"{name} {given}")
        if name == "multipleOf":
            return only("number", lambda v: F.pmod(_double(v), F.lit(float(given))) == 0, f"multipleOf {given}")
        sizes = {
            "minLength": ("string", lambda v: F.char_length(_text(v)) >= given), "maxLength": ("string", lambda v: F.char_length(_text(v)) <= given),
            "pattern": ("string", lambda v: _text(v).rlike(given)),
            "minItems": ("array", lambda v: F.size(_elements(v)) >= given), "maxItems": ("array", lambda v: F.size(_elements(v)) <= given),
            "minProperties": ("object", lambda v: F.size(_entries(v)) >= given), "maxProperties": ("object", lambda v: F.size(_entries(v)) <= given),
        }
        if name in sizes:
            return only(sizes[name][0], sizes[name][1], f"{name} {given}")
        if name == "uniqueItems":
            texts = lambda v: F.transform(_elements(v), lambda x: F.to_json(x))
            return only("array", lambda v: F.size(F.array_distinct(texts(v))) == F.size(texts(v)) if given else F.lit(True), "repeated items")
        if name == "items":
            inner = build(given)
            return lambda value, path, left: F.coalesce(_each_element(inner, value, path, left), _none())
        if name == "required":
            return lambda value, path, left: F.when(
                IS["object"](value), _join([_fault(_field(value, n).isNull(), _below(path, n), "absent") for n in given])
            ).otherwise(_none())
        if name == "properties":
            return properties({n: build(s) for n, s in given.items()})
        if name == "additionalProperties":
            inner, declared = build(given), list(schema.get("properties", {}))
            return lambda value, path, left: F.coalesce(_each_entry(inner, value, path, left, declared), _none())
        if name == "anyOf":
            return _branches([build(s) for s in given], [shape(s) for s in given], [label(s) for s in given])
        if name == "oneOf":
            return one_of([build(s) for s in given])
        if name == "allOf":
            checks = [build(s) for s in given]
            return lambda value, path, left: _join([c(value, path, left) for c in checks])
        if name == "not":
            inner = build(given)
            return lambda value, path, left: _fault(F.size(inner(value, path, left)) == 0, path, "of the excluded kind")
        raise ValueError(f"unknown keyword: {name}")

    def label(schema) -> str:
        if isinstance(schema, Mapping):
            return schema.get("title") or schema.get("$ref", "").rpartition("/")[2] or str(schema.get("type", "schema"))
        return str(schema)

    def properties(checks: Mapping[str, Check]) -> Check:
        return lambda value, path, left: _join([_part(value, name, path, inner, left, _none()) for name, inner in checks.items()])

    def one_of(checks: Sequence[Check]) -> Check:
        def check(value: Column, path: Column, left: int) -> Column:
            passed = reduce(operator.add, [(F.size(c(value, path, left)) == 0).cast("int") for c in checks])
            return _bound(passed, lambda n: F.when(n == 1, _none()).otherwise(F.array(F.concat(path, F.lit(": fits "), n.cast("string"), F.lit(f" of {len(checks)}")))))

        return check

    def follow(reference: str) -> Check:
        found = target(reference)

        def check(value: Column, path: Column, left: int) -> Column:
            if left == 0:
                return F.array(F.concat(path, F.lit(f": deeper than {depth} levels")))
            return build(found)(value, path, left - 1)

        return check

    return _start(build(document), depth)


def _among(value: Column, values: Sequence) -> Column:
    """Whether a value equals one of the given JSON values."""
    import json

    tests = []
    for v in values:
        if isinstance(v, bool) or v is None or isinstance(v, (list, dict)):
            tests.append(F.to_json(value) == F.to_json(F.parse_json(F.lit(json.dumps(v)))))
        elif isinstance(v, str):
            tests.append((_kind(value) == "STRING") & (_text(value) == v))
        else:
            tests.append(_number(value) & (_double(value) == float(v)))
    return reduce(operator.or_, tests, F.lit(False))


# ------------------------------------------------------------------ messages


def _start(check: Check, depth: int) -> Check:
    return lambda value, path, left: check(value, path, depth if left < 0 else left)


def faults(raw: Column, check: Check) -> Column:
    """The faults of a message text, empty when it conforms."""
    malformed = F.array(F.lit("$: malformed"))
    return _bound(F.try_parse_json(raw), lambda v: F.when(v.isNull(), malformed).otherwise(check(v, F.lit("$"), -1)))


def conforming(df: DataFrame, raw: str, check: Check, name: str = "schema_faults") -> DataFrame:
    return df.withColumn(name, faults(F.col(raw), check))


def fault_counts(checked: DataFrame, name: str = "schema_faults") -> DataFrame:
    """Messages by fault, array positions taken together: (fault, messages, occurrences)."""
    plain = checked.select(F.transform(name, lambda f: F.regexp_replace(f, r"\[\d+\]", "[]")).alias("_all"))
    each = plain.select("_all", F.explode(F.array_distinct("_all")).alias("fault"))
    own = each.select("fault", F.size(F.filter("_all", lambda f: f == F.col("fault"))).alias("_n"))
    return own.groupBy("fault").agg(F.count(F.lit(1)).alias("messages"), F.sum("_n").alias("occurrences"))
