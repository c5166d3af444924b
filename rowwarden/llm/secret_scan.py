"""Secret scan with structural confirmation.

Base kinds (fixed patterns): `assign`, `access`, `hex`. Confirmed kinds, added by decoding:

* `token`: three base64url segments whose first decodes to a JSON object with a text `alg` and
  whose second decodes to a JSON object (an encrypted form has five segments and an `enc`);
* `key`: a base64 or hex candidate, plain, wrapped in lines or in key armour, that decodes to a
  private key: a DER sequence whose nested lengths all add up and whose members are those of a
  PKCS#1, PKCS#8 (encrypted or not), SEC 1 or DSA private key, or the OpenSSH private key container
  with all its length fields; or that decodes to text with such a key in armour. Armour may hold
  header lines; where they name a cipher, the body is whole blocks of it. Line ends may be escaped.

Where a coded key starts and ends in a run of characters is read from its structure: a run may begin with part of
a path or a name, go on behind the key, be wrapped in lines of any width, or have an odd number of hex digits in
front. Every place that spells a DER sequence or the OpenSSH container is tried with the length stated there.

A block of texts is first scanned as bytes, array-wise: only texts that hold a long run of the
right alphabet (over lines too), one that a dot joins to another, armour, `AKIA`, or a `:` or `=` can match, and only
those are looked at one by one. Every long enough candidate is decoded; its structure decides.

Null or empty text: no spans. Offsets are code points, ends exclusive. Spans of different kinds may
overlap; spans of one kind never do. Repeated rows: one result each. Empty table: empty result.
Whole texts are scanned; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowwarden.llm.textblocks import WHITE, Block, beside, blocks, runs

KINDS = ("assign", "access", "hex", "token", "key")
# fixed values: the base patterns
ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 24
HEX_RUN = re.compile(r"[0-9a-f]{24,}")  # a maximal run of 24 or more is what HEX finds and keeps

CODED_LEAST = 40  # shortest coded candidate: an Ed25519 private key is 48 DER bytes
HEADER_LEAST = 12  # characters of the shortest token header
# looked ahead, as any segment may be the first one of a token
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{12,}(?:\.[A-Za-z0-9_-]*(?:\.[A-Za-z0-9_-]+){3}|(?:\.[A-Za-z0-9_-]+){2}))(?![A-Za-z0-9_-]))")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----([^-]*(?:-(?!----)[^-]*)*)-----END \1PRIVATE KEY-----")
ARMOUR_HEADER = re.compile(r"^[ \t]*([A-Za-z][A-Za-z0-9-]*):[ \t]*([^\n]*(?:\n[ \t]+[^\n:]*,[^\n:]*)*)$", re.MULTILINE)
CIPHER = re.compile(r"[A-Z0-9-]+,\s*([0-9A-Fa-f]{16}|[0-9A-Fa-f]{32})\s*")
ESCAPED_END = re.compile(r"(?<!\\)\\+(?:[nrt]|u000[9aAdD]|(?=\r?\n))")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}(?:[ \t\r]*\n\s*[A-Za-z0-9+/_-]+={0,2})+(?![A-Za-z0-9+/_-])")
LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{2,}(?:[ \t\r]*\n[ \t]*[A-Za-z0-9+/_-]{2,}={0,2})+")
RUN = re.compile(r"[A-Za-z0-9+/_-]{40,}")
HEX_RUNS = re.compile(r"[0-9A-Fa-f]{40,}")
# how a DER sequence, the OpenSSH magic and armour begin in base64, and a sequence in hex
DER_64 = re.compile(r"M(?=[A-P])")
SSH_64 = re.compile("b3BlbnNzaC1rZXktdjEA")
ARMOUR_64 = re.compile("LS0tLS1CRUdJTi")
DER_HEX = re.compile(r"3(?=0(?:[2-7]|8[1-4]))")
LINE = re.compile(r"[A-Za-z0-9+/_=-]+")
CODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
CODED_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){20,}(?![0-9A-Fa-f])")

_HEX, _CODED = np.zeros(256, bool), np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True
_CODED[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True

INTEGER, OCTETS, NULL, OBJECT, SEQUENCE = 0x02, 0x04, 0x05, 0x06, 0x30

Span = tuple[int, int, str]


def decode64(text: str) -> bytes | None:
    """Plain or URL-safe base64, padded or not; None if it isn't."""
    body = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def members(der: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) members that fill `der` exactly, with definite minimal lengths."""
    out, at = [], 0
    while at < len(der):
        if at + 2 > len(der):
            return None
        tag, size, at = der[at], der[at + 1], at + 2
        if size & 0x80:
            wide = size & 0x7F
            if not 1 <= wide <= 4 or at + wide > len(der) or der[at] == 0:
                return None
            size, at = int.from_bytes(der[at : at + wide], "big"), at + wide
            if size < 0x80:
                return None
        if at + size > len(der):
            return None
        out.append((tag, der[at : at + size]))
        at += size
    return out


def _sequence(der: bytes) -> list[tuple[int, bytes]] | None:
    top = members(der)
    return members(top[0][1]) if top and len(top) == 1 and top[0][0] == SEQUENCE else None


def is_der_key(der: bytes) -> bool:
    """Whether `der` is one private key by its nested structure."""
    inside = _sequence(der)
    if not inside or inside[0][0] != INTEGER or len(inside[0][1]) != 1:
        return False
    version, tags = inside[0][1][0], [tag for tag, _ in inside]
    if tags[1:3] == [SEQUENCE, OCTETS] and version in (0, 1):  # PKCS#8: algorithm, then the wrapped key
        algorithm = members(inside[1][1])
        return bool(algorithm) and algorithm[0][0] == OBJECT and bool(members(inside[2][1]))
    if tags[1:2] == [OCTETS] and version == 1:  # SEC 1: the scalar, then tagged parameters
        return len(inside[1][1]) >= 16 and all(tag in (0xA0, 0xA1) for tag in tags[2:])
    if version in (0, 1) and all(tag == INTEGER for tag in tags[:9]) and len(tags) in (9, 10):  # PKCS#1
        return len(inside[1][1]) >= 32
    return version == 0 and tags == [INTEGER] * 6 and len(inside[1][1]) >= 32  # DSA


# PKCS#5 and PKCS#12 password-based encryption
PASSWORD_BASED = bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01")


def is_encrypted_key(der: bytes) -> bool:
    """Whether `der` is one encrypted PKCS#8 key: how it is encrypted, then the encrypted octets."""
    inside = _sequence(der)
    if not inside or [tag for tag, _ in inside] != [SEQUENCE, OCTETS] or len(inside[1][1]) < 16:
        return False
    algorithm = members(inside[0][1])
    return bool(algorithm) and [tag for tag, _ in algorithm] == [OBJECT, SEQUENCE] and algorithm[0][1].startswith(PASSWORD_BASED) and bool(members(algorithm[1][1]))


def is_ssh_key(raw: bytes) -> bool:
    """Whether `raw` is an OpenSSH private key container whose length fields all hold."""
    return ssh_size(raw) == len(raw)


def ssh_size(raw: bytes) -> int | None:
    """Bytes of the OpenSSH private key container that `raw` begins with."""
    magic = b"openssh-key-v1\0"
    if not raw.startswith(magic):
        return None
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(raw[at : at + 4], "big")
        if at + 4 > len(raw) or at + 4 + size > len(raw):
            return None
        at += 4 + size
        return raw[at - size : at]

    if any(field() is None for _ in range(3)):  # cipher, key derivation, its options
        return None
    keys, at = int.from_bytes(raw[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 64 or any(field() is None for _ in range(keys)):
        return None
    return at if field() is not None else None


def der_size(head: bytes) -> int | None:
    """Bytes of the sequence that begins with `head`, if its first member can be that of a key."""
    if len(head) < 9 or head[0] != SEQUENCE:
        return None
    wide = head[1] & 0x7F if head[1] & 0x80 else 0
    if wide > 4 or (head[1] & 0x80 and not wide):
        return None
    size = int.from_bytes(head[2 : 2 + wide], "big") if wide else head[1]
    first = head[2 + wide : 5 + wide]
    return size + 2 + wide if first in (b"\2\1\0", b"\2\1\1") or first[:1] == b"\x30" else None


def keys_within(run: str) -> list[tuple[int, int]]:
    """Keys anywhere in a run of base64 characters (either alphabet), by the length that each states."""
    found, end = [], 0
    places = [m.start() for start in (DER_64, SSH_64, ARMOUR_64) for m in start.finditer(run)]
    for i in sorted(places):
        if i < end:
            continue
        rest = run[i : len(run) - ((len(run) - i) % 4 == 1)]
        if run[i] == "L":
            raw = decode64(rest) or b""
            m = ARMOUR.match(unescaped(raw.decode("latin-1")))
            if m and is_armoured(m[2]):
                end = i + -(-4 * (m.end() + (raw[m.end() : m.end() + 1] == b"\n")) // 3)
                found.append((i, end))
            continue
        if run[i] == "M":
            size = der_size(decode64(run[i : i + 12]) or b"")
        else:
            size = ssh_size(decode64(rest) or b"")
        if size is None or i + (last := -(-4 * size // 3)) > len(run):
            continue
        if is_key((decode64(run[i : i + last]) or b"")[:size]):
            found.append((i, i + last))
            end = i + last
    return found


def hex_keys_within(run: str) -> list[tuple[int, int]]:
    """Keys anywhere in a run of hex digits, at even and odd places."""
    found, end = [], 0
    for m in DER_HEX.finditer(run):
        i = m.start()
        if i < end or i + 18 > len(run):
            continue
        size = der_size(bytes.fromhex(run[i : i + 18]))
        if size is not None and i + 2 * size <= len(run) and is_key(bytes.fromhex(run[i : i + 2 * size])):
            found.append((i, i + 2 * size))
            end = i + 2 * size
    return found


def keys_over_lines(text: str, lines: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Keys in the characters of several lines, put end to end, as places in the text."""
    whole = "".join(text[a:b].rstrip("=") for a, b in lines)
    if len(whole) < CODED_LEAST:
        return []
    places = np.concatenate([np.arange(a, a + len(text[a:b].rstrip("="))) for a, b in lines])
    return [(int(places[i]), int(places[j - 1]) + 1) for i, j in keys_within(whole)]


def _with_padding(text: str, span: tuple[int, int]) -> tuple[int, int]:
    end = span[1]
    while end < len(text) and end < span[1] + 2 and text[end] == "=":
        end += 1
    return span[0], end


def is_key(raw: bytes | None) -> bool:
    return bool(raw) and (is_der_key(raw) or is_encrypted_key(raw) or is_ssh_key(raw))


def is_armoured(body: str) -> bool:
    """Whether the text between the lines of key armour is a key."""
    headers = {m[1].lower(): m[2] for m in ARMOUR_HEADER.finditer(body)}
    raw = decode64(ARMOUR_HEADER.sub("", body).replace("\\/", "/"))
    if raw and "ENCRYPTED" in headers.get("proc-type", "") and (cipher := CIPHER.fullmatch(headers.get("dek-info", ""))):
        return len(raw) >= 32 and len(raw) % (len(cipher[1]) // 2) == 0
    return is_key(raw)


def unescaped(text: str) -> str:
    """text with escaped line ends as line ends, every character at its place."""
    return ESCAPED_END.sub(lambda m: " " * (len(m[0]) - 1) + "\n", text) if "\\" in text else text


def holds_key(raw: bytes | None) -> bool:
    """Whether decoded bytes are a key, or text with a key in armour."""
    if not raw:
        return False
    return is_key(raw) or b"PRIVATE KEY-----" in raw and any(is_armoured(m[2]) for m in ARMOUR.finditer(unescaped(raw.decode("latin-1"))))


def _object(segment: str) -> dict | None:
    try:
        found = json.loads(decode64(segment) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed(token: str) -> bool:
    parts = token.split(".")
    head = _object(parts[0])
    if head is None or not isinstance(head.get("alg"), str):
        return False
    if len(parts) == 5:
        return isinstance(head.get("enc"), str) and all(decode64(p) is not None for p in parts)
    return len(parts) == 3 and _object(parts[1]) is not None and decode64(parts[2]) is not None


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [(m.start(), m.end(), "hex") for m in HEX_RUN.finditer(text)]


def wrapped_keys(text: str, lines: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Keys in lines of base64: lines of one width, and mostly a shorter last one."""
    keys, i = [], 0
    while i < len(lines):
        width, j = lines[i][1] - lines[i][0], i + 1
        while j < len(lines) and lines[j][1] - lines[j][0] == width:
            j += 1
        tail = j < len(lines) and lines[j][1] - lines[j][0] < width
        for last in (j + 1, j) if tail else (j,):
            if width >= CODED_LEAST and last - i > 1 and holds_key(decode64("".join(text[a:b] for a, b in lines[i:last]))):
                keys.append((lines[i][0], lines[last - 1][1]))
                j = last
                break
        i = j
    return keys


def confirmed_spans(text: str) -> list[Span]:
    text = unescaped(text)
    found, end = [], 0
    for m in SIGNED.finditer(text):
        parts = m[1].split(".")
        token = next((t for t in (m[1], ".".join(parts[:3])) if is_signed(t)), None) if m.start() >= end else None
        if token:
            end = m.start() + len(token)
            found.append((m.start(), end, "token"))
    keys = [(m.start(), m.end()) for m in ARMOUR.finditer(text) if is_armoured(m[2])]
    keys += [m.span() for m in CODED.finditer(text) if holds_key(decode64(m[0]))]
    keys += [m.span() for m in CODED_HEX.finditer(text) if holds_key(bytes.fromhex(m[0]))]
    for m in WRAPPED.finditer(text):
        keys += wrapped_keys(text, [x.span() for x in LINE.finditer(text, m.start(), m.end())])
    for m in RUN.finditer(text):
        keys += [_with_padding(text, (m.start() + a, m.start() + b)) for a, b in keys_within(m[0])]
    for m in HEX_RUNS.finditer(text):
        keys += [(m.start() + a, m.start() + b) for a, b in hex_keys_within(m[0])]
    for m in LINES.finditer(text):
        keys += [_with_padding(text, k) for k in keys_over_lines(text, [x.span() for x in LINE.finditer(text, m.start(), m.end())])]
    keys.sort(key=lambda s: (s[0], -s[1]))
    end = 0
    for s in keys:
        if s[0] >= end:
            found.append((*s, "key"))
            end = s[1]
    return found


def _suspects(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may hold a base match, and rows that may hold a coded candidate."""
    data, base, coded = block.data, np.zeros(len(block), bool), np.zeros(len(block), bool)
    row = lambda at: np.searchsorted(block.offsets, at, "right") - 1
    base[row(np.flatnonzero((data == 0x3A) | (data == 0x3D)))] = True
    at = np.flatnonzero(data[:-3] == 0x41) if len(data) > 3 else np.zeros(0, np.int64)
    base[row(at[(data[at + 1] == 0x4B) & (data[at + 2] == 0x49) & (data[at + 3] == 0x41)])] = True

    def mark(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Flag all rows that the runs touch: texts lie end to end, so a run can begin in the row before."""
        step = np.zeros(len(block) + 1, np.int64)
        np.add.at(step, row(start), 1)
        np.add.at(step, row(end - 1) + 1, -1)
        flags |= np.cumsum(step[:-1]) > 0

    start, end = runs(_HEX[data])
    long = end - start >= HEX_LEAST
    mark(base, start[long], end[long])
    start, end = runs(_CODED[data])
    if len(start):  # runs that only white space with a line end parts count as one
        solid, lines = np.concatenate(([0], np.cumsum(~WHITE[data]))), np.concatenate(([0], np.cumsum(data == 0x0A)))
        gap = (solid[start[1:]] == solid[end[:-1]]) & (lines[start[1:]] > lines[end[:-1]])
        chain = np.concatenate(([0], np.cumsum(~gap)))
        long = np.bincount(chain, end - start)[chain] >= CODED_LEAST
        mark(coded, start[long], end[long])
    dot = (end - start >= HEADER_LEAST) & (end < len(data) - 1)
    dot[dot] = data[end[dot]] == 0x2E
    mark(coded, start[dot], end[dot])
    at = np.flatnonzero(data[:-4] == 0x2D) if len(data) > 4 else np.zeros(0, np.int64)
    coded[row(at[(data[at + 1] == 0x2D) & (data[at + 2] == 0x2D) & (data[at + 3] == 0x2D) & (data[at + 4] == 0x2D)])] = True
    return base, coded


def found_in(block: Block) -> Iterator[tuple[int, str, list[Span]]]:
    """Row, text and sorted spans of the rows of a block that have any."""
    base, coded = _suspects(block)
    for i in np.flatnonzero(base | coded).tolist():
        whole = block.text(i)
        spans = (base_spans(whole) if base[i] else []) + (confirmed_spans(whole) if coded[i] else [])
        if spans:
            yield i, whole, sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def mask(text: str, spans: list[Span], marks: dict[str, str]) -> str:
    """text with every stretch of overlapping spans replaced by the mark of its first span."""
    out, at, k = [], 0, 0
    while k < len(spans):
        start, end, kind = spans[k]
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][1])
            k += 1
        out += [text[at:start], marks[kind]]
        at = end
    return "".join(out) + text[at:]


def masked(docs: DataFrame, marks: dict[str, str], n_chars: str | None = None, text: str = "text") -> DataFrame:
    """docs, same columns, with all spans masked; `n_chars` names a column of text lengths to correct."""

    def judge(block: Block) -> dict[str, pa.Array]:
        texts = block.column(text).to_pylist()
        sizes = block.column(n_chars).to_pylist() if n_chars else []
        for i, whole, spans in found_in(block):
            texts[i] = mask(whole, spans, marks)
            if n_chars:
                sizes[i] = len(texts[i])
        return {text: pa.array(texts, pa.string())} | ({n_chars: pa.array(sizes, pa.int64())} if n_chars else {})

    added = f"`{text}` string" + (f", `{n_chars}` long" if n_chars else "")
    return beside(docs, text, judge, added).select(*[f"`{c}`" for c in docs.columns])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: `doc_id` and `spans`, an array of (start_at, end_at, kind, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start_at", pa.int64()), ("end_at", pa.int64()), ("kind", pa.string()), ("value", pa.string())])
        for block in blocks(batches, text):
            found: list[list[dict]] = [[] for _ in range(len(block))]
            for i, whole, spans in found_in(block):
                found[i] = [{"start_at": s, "end_at": e, "kind": k, "value": whole[s:e]} for s, e, k in spans]
            yield pa.RecordBatch.from_arrays([block.column(key), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    return docs.select(docs[key].cast("long").alias(key), docs[text]).mapInArrow(
        run, "doc_id long, spans array<struct<start_at: long, end_at: long, kind: string, value: string>>"
    )

