"""Fields of JSON messages: presence, kind and typed value.

`sources.parse.messages` parses a text once into the struct `j` of variants and the
columns `k_<field>` with the kind of each; the functions here work on those. The kind is
null for an absent field and VOID for a JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TEXT, INTEGER, DOUBLE, BOOLEAN, NULL = "STRING", "BIGINT", "DOUBLE", "BOOLEAN", "VOID"


def kind(name: str) -> Column:
    return F.col(f"k_{name}")


def is_number(name: str) -> Column:
    return (kind(name) == INTEGER) | (kind(name) == DOUBLE) | kind(name).startswith("DECIMAL")


def present(name: str) -> Column:
    return kind(name).isNotNull()


def given(name: str) -> Column:
    """Present and not a JSON null."""
    return present(name) & (kind(name) != NULL)


def value(name: str, as_type: str) -> Column:
    """The field cast to a type, null where it cannot be."""
    return F.try_variant_get(F.col(f"j.{name}"), "$", as_type)


def number(name: str) -> Column:
    """The field as a double when it is a JSON number, else null."""
    return F.when(is_number(name), value(name, "double"))


def text(name: str) -> Column:
    """The field when it is a JSON string, else null."""
    return F.when(kind(name) == TEXT, value(name, "string"))


def element_by_role(elements: Column, role: str, wanted: str = "value") -> Column:
    """`wanted` of the first array element whose `type` is `role`."""
    return F.get(F.filter(elements, lambda e: e["type"] == role), F.lit(0))[wanted]


def quoted_field(raw: Column, name: str) -> Column:
    """Last `"name":"…"` in the text, null when there is none; works on broken JSON too."""
    pattern = f'(?s).*"{name}"\\s*:\\s*"(.*?)"'
    return F.when(raw.rlike(pattern), F.regexp_extract(raw, pattern, 1))
