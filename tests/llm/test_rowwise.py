"""Operators that judge a text by itself, against the plain definition."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from rowwarden.llm import decontaminate, line_frequency, packing, queries, secret_scan, token_counts

from .conftest import frame

EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def pieces_path():
    return queries.tokenizer("piece_bpe_32k.model")


def test_token_counts_equal_the_library(docs, rows, pieces_path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, pieces_path, 500).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        n = len(library.encode(text or ""))
        assert (got[doc_id].n_bytes, got[doc_id].n_tokens, got[doc_id].over_limit) == (len((text or "").encode()), n, n > 500)


@pytest.mark.parametrize("text", ["<s> </s> <unk> <0x0A>", "▁▁ a▁b  c", "😀é́﻿", "ab" * 300, "\x00\x01", "é ﬁ Ａ", " "])
def test_token_counts_odd_strings(text, pieces_path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
    assert token_counts.model(pieces_path).count(text) == len(library.encode(text))


def plain_base(text: str) -> list[tuple[int, int, str]]:
    word = re.compile("(" + "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in k) for k in ["password", "passwd", "secret", "token", "api_?key"]).replace("_?", "_?") + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = [(m.start(), m.end(), "assign") for m in word.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return out + [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]


def der(tag: int, body: bytes) -> bytes:
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def rsa_like() -> bytes:
    number = lambda n: der(2, bytes([1 + i % 100 for i in range(n)]))
    return der(0x30, der(2, b"\0") + number(64) + der(2, b"\x01\0\x01") + b"".join(number(n) for n in (64, 32, 32, 32, 32, 32)))


def ssh_like() -> bytes:
    field = lambda b: len(b).to_bytes(4, "big") + b
    return b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"k" * 51) + field(b"p" * 136)


def url64(value) -> str:
    raw = value if isinstance(value, bytes) else json.dumps(value).encode()
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def secret_texts() -> dict[str, list[str]]:
    key = base64.b64encode(rsa_like()).decode()
    token = f"{url64({'alg': 'HS256', 'typ': 'JWT'})}.{url64({'sub': 'x'})}.{url64(b'0123456789abcdef')}"
    lines = "\n".join(key[i : i + 64] for i in range(0, len(key), 64))
    return {
        f"see {token} end": ["token"],
        f"é bearer {token}.": ["token"],
        f"{url64({'typ': 'JWT'})}.{url64({'a': 1})}.zzzz": [],
        f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----": ["key"],
        f"raw {key} raw": ["key"],
        f"raw {base64.b64encode(ssh_like()).decode()} raw": ["key"],
        f"hex {rsa_like().hex()} hex": ["hex", "key"],
        f"broken {base64.b64encode(rsa_like()[:-1]).decode()} raw": [],
        "M" * 80: [],
        "-----BEGIN RSA PRIVATE KEY-----\nnot a key\n-----END RSA PRIVATE KEY-----": [],
        'API_KEY: "abcdef" and apikey=12345 then PassWord=xyz.+/=_-1': ["assign", "assign"],
        "ſecret=abcdefgh toKen=abcdefgh": [],
        "password=short token == tokens:abcdef secret='a'b": [],
        "AKIA" + "A" * 15 + " AKIA" + "0" * 16: ["access"],
        "f" * 23 + " " + "0" * 24 + "G" + "a" * 30: ["hex", "hex"],
        "token" + "=" * 9 + "abcdefg": ["assign"],
    }


def test_secret_scan(spark, docs, rows):
    cases = secret_texts()
    extra = [(5000 + i, t, None, None) for i, t in enumerate(cases)]
    got = {r.doc_id: r.spans for r in secret_scan.scan(frame(spark, rows + extra)).collect()}
    assert len(got) == len(rows) + len(extra)
    for doc_id, text, *_ in rows + extra:
        base = [(s.start_at, s.end_at, s.kind) for s in got[doc_id] if s.kind in ("assign", "access", "hex")]
        assert sorted(base) == sorted(plain_base(text or "")), text
        assert all(s.value == text[s.start_at : s.end_at] for s in got[doc_id])
    for i, kinds in enumerate(cases.values()):
        assert sorted(s.kind for s in got[5000 + i]) == sorted(kinds), list(cases)[i]


def hidden_secrets() -> dict[str, tuple[str, str]]:
    """Texts with a secret in a form that only decoding shows: the kind and the value."""
    key = base64.b64encode(rsa_like()).decode()
    wrapped = [key[i : i + 64] for i in range(0, len(key), 64)]
    pem = "\n".join(["-----BEGIN RSA PRIVATE KEY-----", *wrapped, "-----END RSA PRIVATE KEY-----", ""])
    escaped = pem.strip().replace("\n", "\\n")
    pbes2 = bytes.fromhex("2a864886f70d01050d")
    locked = der(0x30, der(0x30, der(6, pbes2) + der(0x30, der(4, b"salt"))) + der(4, bytes(range(64))))
    locked = f"-----BEGIN ENCRYPTED PRIVATE KEY-----\n{base64.b64encode(locked).decode()}\n-----END ENCRYPTED PRIVATE KEY-----"
    cipher = base64.b64encode(bytes(range(64))).decode()
    old = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{cipher}\n-----END RSA PRIVATE KEY-----"
    coded = base64.b64encode(pem.encode()).decode()
    lines = "\n  ".join(coded[i : i + 76] for i in range(0, len(coded), 76))
    signed = lambda head: f"{url64(head)}.{url64({'sub': 'x'})}.{url64(b'0123456789abcdef')}"
    out = {f"client-key-data: {coded}": ("key", coded), f"client-key-data: |\n  {lines}\nnext": ("key", lines)}
    out |= {f'{{"private": "{escaped}\\n"}}': ("key", escaped), f"x {locked} x": ("key", locked), f"x {old} x": ("key", old), f'"{old}"': ("key", old)}
    out[f'"{old}"'.replace("\n", "\\r\\n")] = ("key", old.replace("\n", "\\r\\n"))
    out[f"hex {pem.encode().hex()} hex"] = ("key", pem.encode().hex())
    for head in (b'{ "alg": "HS256" }', b'{\n "alg": "HS256"\n}', b' {"alg":"HS256"}', b'{"alg":"HS256"}'):
        out[f"documentation.{signed(head)}.Then more"] = ("token", signed(head))
    return out


def ed25519_like() -> bytes:
    """A PKCS#8 key of 48 bytes."""
    return der(0x30, der(2, b"\0") + der(0x30, der(6, bytes.fromhex("2b6570"))) + der(4, der(4, bytes(range(200, 232)))))


def keys_in_odd_places() -> dict[str, str]:
    """Texts in which a key is part of a longer run, or of narrow lines, and the key's text."""
    short, long = ed25519_like(), rsa_like()
    assert len(short) == 48
    one, other = base64.b64encode(short).decode(), base64.b64encode(long).decode()
    url = base64.urlsafe_b64encode(long).decode().rstrip("=")
    ssh = base64.b64encode(ssh_like()).decode()
    pem = "\n".join(["-----BEGIN PRIVATE KEY-----", one, "-----END PRIVATE KEY-----", ""])
    coded = base64.b64encode(pem.encode()).decode()
    narrow = lambda t, n, glue="\n": glue.join(t[i : i + n] for i in range(0, len(t), n))
    bare = one.rstrip("=")
    out = {f"{before}{one} x": one for before in ("/etc/keys/", "pem-", "id_", "a+b/", "MAM")}
    out |= {f"id_{url}.x": url, f"/etc/{other}": other, f"keys/{ssh}": ssh, f"x_{bare}": bare, f"{one}tail/of/it": one, f"pr/{coded}": coded}
    out |= {f"key:\n{narrow(t, n)}\nend": narrow(t, n) for t in (one, other) for n in (4, 16, 32, 39, 64)}
    out |= {f"key: |\n    {narrow(other, 20, chr(10) + '    ')}\nnext: 1": narrow(other, 20, "\n    "), f"a {narrow(other, 25, chr(13) + chr(10))} b": narrow(other, 25, "\r\n")}
    out |= {f"{before}{raw.hex()}{after}": raw.hex() for before in ("a", "0f3", "") for raw in (short, long) for after in ("", "b", " x")}
    out[f"A{short.hex().upper()}"] = short.hex().upper()
    return out


def test_keys_in_odd_places(spark):
    cases = keys_in_odd_places()
    got = {r.doc_id: r.spans for r in secret_scan.scan(frame(spark, [(i, t, None, None) for i, t in enumerate(cases)])).collect()}
    for i, (text, want) in enumerate(cases.items()):
        assert [s.value for s in got[i] if s.kind == "key"] == [want], text
        assert [(s.start_at, s.end_at, s.kind) for s in got[i] if s.kind in ("assign", "access", "hex")] == sorted(plain_base(text)), text
    masked = secret_scan.masked(frame(spark, [(i, t, None, None) for i, t in enumerate(cases)]), {k: "#" for k in secret_scan.KINDS}, "n_chars")
    left = {r.doc_id: r.text for r in masked.collect()}
    assert all(want not in left[i] and len(left[i]) < len(text) for i, (text, want) in enumerate(cases.items()))


def test_runs_without_a_key_have_no_key_span():
    rng = random.Random(2)
    for _ in range(300):
        raw = bytes(rng.randrange(256) for _ in range(rng.randrange(60, 400)))
        cut = ed25519_like()[: rng.randrange(30, 48)]
        for text in (base64.b64encode(raw).decode(), "M" + base64.b64encode(raw).decode(), raw.hex(), base64.b64encode(cut).decode(), "\n".join(base64.b64encode(raw).decode()[i : i + 24] for i in range(0, 80, 24))):
            assert not [s for s in secret_scan.confirmed_spans(text) if s[2] == "key"], text
    words = "\n".join(rng.choice(["May", "MAP", "MIGHT", "some", "words", "in-lines"]) for _ in range(500))
    assert secret_scan.confirmed_spans(words) == []


def test_secrets_that_only_decoding_shows(spark):
    cases = hidden_secrets()
    given = frame(spark, [(i, t, None, None) for i, t in enumerate(cases)])
    got = {r.doc_id: r.spans for r in secret_scan.scan(given).collect()}
    for i, (text, want) in enumerate(cases.items()):
        assert want in [(s.kind, s.value) for s in got[i]], text


def test_what_decodes_to_no_key_stays():
    digest = der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")) + der(5, b"")) + der(4, bytes(32)))
    armour = lambda body: f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    public = "-----BEGIN PUBLIC KEY-----\n" + base64.b64encode(rsa_like()[:-1]).decode() + "\n-----END PUBLIC KEY-----\n"
    short = armour(f"Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{base64.b64encode(bytes(65)).decode()}")
    for text in (base64.b64encode(digest).decode(), base64.b64encode(public.encode()).decode(), short, armour("Comment: nothing\n\nnot a key"), "extraordinarily.named.package", "L" * 400):
        assert not secret_scan.confirmed_spans(text), text


def plain_words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_measures(text: str | None) -> tuple:
    text = text or ""
    w = plain_words(text)
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {i + k for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if plain_words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def test_line_frequency(docs, rows):
    got = {r.doc_id: r for r in line_frequency.quality(docs, most_docs=2).collect()}
    assert len(got) == len(rows)
    held = defaultdict(Counter)
    norm = lambda line: " ".join(plain_words(line.lower()))
    for _, text, _, source in rows:
        held[source].update({norm(x) for x in (text or "").split("\n") if norm(x)})
    for doc_id, text, _, source in rows:
        m = plain_measures(text)
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m, text
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        lost = sum(len(plain_words(x)) for x in (text or "").split("\n") if held[source][norm(x)] > 2)
        assert (r.base_failed, r.n_frequent_words, r.kept) == (failed, lost, not failed and 2 * (m[0] - lost) >= m[0]), text


def test_line_limit_does_not_grow_with_the_host(spark):
    """A notice in eleven documents goes, on a host of fifteen documents and on one of three thousand."""
    body = "these are twelve words of a document that stands on its {} own"
    notice = "accept all cookies to go on reading this page and the others too please"
    rows = [(i, f"{body.format(i)}\n{notice}" if i < 11 else body.format(i), "en", "large") for i in range(3000)]
    rows += [(9000 + i, f"{body.format(i)}\n{notice}" if i < 11 else body.format(i), "en", "small") for i in range(15)]
    rows += [(9500 + i, f"{body.format(i)}\n{notice}" if i < 10 else body.format(i), "en", "rare") for i in range(15)]
    got = {r.doc_id: r for r in line_frequency.quality(frame(spark, rows, 4)).collect()}
    assert {d for d, r in got.items() if r.n_frequent_words} == {*range(11), *range(9000, 9011)}
    assert all(not r.kept for r in got.values() if r.n_frequent_words)  # 14 of 26 words are the notice's


def bench_words(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def test_decontamination(spark, docs, rows, monkeypatch):
    words = plain_words(rows[9][1])
    items = [("1", " ".join(words[:30]).upper()), ("2", "under, NEVER"), ("2", "house rivers"), ("3", None), ("4", "..."), (None, "the of"), ("5", " ".join(words[5:18]))]
    bench = spark.createDataFrame(items, "item_id string, text string")
    sets = [(i, bench_words(t)) for i, t in items if i is not None]
    grams = defaultdict(set)
    for i, w in sets:
        for k in range(max(len(w) - 12, 1) if w else 0):
            grams[tuple(w[k : k + 13])].add(i)

    def check(found):
        got = {r.doc_id: r for r in found.collect()}
        assert len(got) == len(rows)
        for doc_id, text, *_ in rows:
            w, hit, ids = bench_words(text), set(), set()
            for n in {len(g) for g in grams}:
                for k in range(len(w) - n + 1):
                    if (own := grams.get(tuple(w[k : k + n]))) is not None:
                        hit.update(range(k, k + n))
                        ids |= own
            r = got[doc_id]
            assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(ids)), text
            assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
            assert hit == {p for s in r.spans for p in range(s.start, s.start + s.length)}

    check(decontaminate.contamination(docs, bench))
    monkeypatch.setattr(decontaminate, "PHRASE_BYTES", 150)  # several sets
    check(decontaminate.contamination(docs, bench))


def test_stored_index_and_proximity(spark, tmp_path):
    docs = frame(spark, [(1, "alpha one beta gamma", None, None), (2, "alpha beta gamma", None, None), (3, "gamma x x x x alpha beta", None, None)], 1)
    decontaminate.build_index(docs).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    bench = spark.createDataFrame([("q", "alpha beta gamma")], "item_id string, text string")
    phrases = spark.sparkContext.broadcast(next(decontaminate.phrase_sets(bench)))
    hits = lambda slack: sorted(r.doc_id for r in decontaminate.search(index, phrases, slack).collect() if r["items"])
    assert hits(0) == [2]
    assert hits(1) == [1, 2]


@pytest.mark.parametrize("parts", [1, 4])
def test_packing(spark, rows, parts):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    special = [(7000, "a<|endoftext|>b <|endoftext|>", None, None), (None, "no id", None, None), (7001, "tok  \n\n  x's I'LL　y \x1c z  ", None, None)]
    given = rows + special
    out = packing.pack(frame(spark, given, parts), path).collect()
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t, *_ in given}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[d])
            raw = b"".join(i.to_bytes(4, "little") for i in ids[d][at : at + p.length])
            assert p.ids_crc32 == zlib.crc32(raw)
            at += p.length
        assert at == len(ids[d])
    padding = 0
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 2048 - at
    total = sum(map(len, ids.values()))
    assert padding <= 0.02 * total + 2048


def test_packing_repeated_documents(spark):
    path = queries.tokenizer("byte_bpe_50k.json")
    out = packing.pack(frame(spark, [(1, "same text", None, None)] * 3, 2), path).collect()
    assert len(out) == 3 and len({(r.sequence_id, r.offset) for r in out}) == 3


def test_empty_tables(spark, no_docs, pieces_path):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert token_counts.count_tokens(no_docs, pieces_path).count() == 0
    assert secret_scan.scan(no_docs).count() == 0
    assert line_frequency.quality(no_docs).count() == 0
    assert packing.pack(no_docs, queries.tokenizer("byte_bpe_50k.json")).count() == 0
    assert decontaminate.contamination(no_docs, bench).count() == 0


def test_no_benchmark(spark, docs, rows):
    found = decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(found) == len(rows) and not any(r.contaminated or r.n_hit for r in found)
