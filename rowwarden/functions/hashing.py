"""Row and payload digests as columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

SEPARATOR = "|"
HEX64 = "^[a-f0-9]{64}$"

_DIGESTS = {
    "sha256": lambda text: F.sha2(text, 256),
    "sha512": lambda text: F.sha2(text, 512),
    "md5": F.md5,
}


def digest(text: Column, algorithm: str = "SHA-256") -> Column:
    name = algorithm.lower().replace("-", "")
    if name not in _DIGESTS:
        raise ValueError(f"unknown hash algorithm {algorithm!r}; use one of {sorted(_DIGESTS)}")
    return _DIGESTS[name](text)


def canonical_hash(parts: Sequence[Column | tuple[Column, str]], algorithm: str = "SHA-256") -> Column:
    """Digest of parts joined by `|` in the given order.

    A bare column that is null is left out of the text; a `(column, text)` pair
    stands for `text` when null.
    """
    texts = []
    for part in parts:
        if isinstance(part, tuple):
            column, null_text = part
            texts.append(F.coalesce(column.cast("string"), F.lit(null_text)))
        else:
            texts.append(part.cast("string"))
    return digest(F.concat_ws(SEPARATOR, *texts), algorithm)


def fields_hash(
    fields: Mapping[str, Column] | Iterable[str],
    algorithm: str = "SHA-256",
    null_as: str = "",
    ordered: bool = True,
) -> Column:
    """Digest of named fields, sorted by name unless `ordered` is off, null as `null_as`."""
    columns = dict(fields) if isinstance(fields, Mapping) else {name: F.col(name) for name in fields}
    names = sorted(columns) if ordered else list(columns)
    return canonical_hash([(columns[n], null_as) for n in names], algorithm)


def row_hash(
    columns: Sequence[str],
    exclude: Iterable[str] = (),
    null_as: str = "NULL",
    algorithm: str = "SHA-256",
) -> Column:
    """Digest of a whole row without the columns that differ by site."""
    skipped = set(exclude)
    return fields_hash([c for c in columns if c not in skipped], algorithm, null_as)


def leading_bits(hex_digest: Column) -> Column:
    """First 32 bits of a hex digest as a bigint."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("bigint")


def key_bucket(key: Column, buckets: int) -> Column:
    """Stable bucket of a key, the same on every engine and every site."""
    return F.pmod(leading_bits(F.sha2(key.cast("string"), 256)), F.lit(buckets)).cast("bigint")


def bound_digest(key: Column, row_hash: Column) -> Column:
    """Digest of a key together with its row digest; a null of either is told apart from any text."""
    part = lambda c: F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(part(key), F.lit("|"), part(row_hash)), 256)


def words(hex_digest: Column) -> list[Column]:
    """The four unsigned 64-bit words of a 256-bit hex digest, as decimals that can be summed."""
    return [F.conv(F.substring(hex_digest, 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]


def signed_words(hex_digest: Column) -> list[Column]:
    """The bits of those words as bigints."""
    return [F.conv(F.substring(hex_digest, 1 + 16 * i, 16), 16, -10).cast("bigint") for i in range(4)]


def is_hex_digest(column: Column) -> Column:
    return column.rlike(HEX64)
