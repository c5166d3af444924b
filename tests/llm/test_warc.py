"""WARC archives: round trips, damaged archives, and which records are revisits."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import defaultdict

import pytest
import zstandard

from rowwarden.llm import queries, warc_zstd
from rowwarden.llm.staging import Staging

SCHEMA = "page_id long, url string, html string, digest string, payload string, best string, key string"


def pages(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(parts)


def awkward() -> list[tuple]:
    body = "<p>" + "words of a page " * 80 + "é漢</p>"
    rows = [(i, f"http://host.example/{i}?q=a b\r\né", f"<html>{i} {body}</html>") for i in range(40)]
    rows += [(100 + i, None, body) for i in range(30)]  # copies
    rows += [(200 + i, "http://x/", "short") for i in range(5)]  # equal, but small
    rows += [(300, "http://x/", None), (301, None, ""), (302, "", None), (None, "http://null/", body), (None, None, None)]
    rows += [(400, "http://twice/", body + "!"), (400, "http://twice/", body + "!"), (399, "http://less/", body + "!")]
    rows += [(500, "http://long/", "x" * 3_000_000), (501, "http://long/", "x" * 3_000_000)]
    rows += [(600, "http://edge/", "e" * 999), (601, "http://edge/", "e" * 999), (602, "http://edge/", "f" * 1000), (603, "http://edge/", "f" * 1000)]
    rows += [(700, "http://odd/", "\x00\r\n\r\nWARC/1.1\r\n\x28"), (-5, "http://minus/", "negative id")]
    return rows


def plain(rows) -> list[tuple]:
    top = defaultdict(list)
    for page, _, html in rows:
        top[html or ""].append(page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        ids = [p for p in top[html or ""] if p is not None]
        best = max(ids) if ids else None
        again = len(raw) >= 1000 and page != best
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    rows = awkward()
    warc_zstd.write(pages(spark, rows), str(tmp_path / "a"), archive_bytes=2_000)
    read = warc_zstd.read(spark, str(tmp_path / "a"))
    assert read.where("fault is not null").count() == 0
    got = warc_zstd.pages_in(read).collect()
    seen = [(r.key and int(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_key and int(r.refers_key)) for r in got]
    assert sorted(seen, key=repr) == plain(rows)
    payloads = sorted((r.key or "", bytes(r.payload).decode()) for r in got if r.record_type == "response")
    first = {}
    for (page, _, html), kind in zip(rows, [None] * len(rows)):
        first.setdefault(page, html or "")
    assert all(k == "" or first[int(k)] == p for k, p in payloads)
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    archives = {r.archive for r in read.select("archive").collect()}
    assert len(archives) > 3
    assert read.where("record_type = 'warcinfo'").count() == len(archives)


def test_archives_are_plain_zstandard(spark, tmp_path):
    """Frames can be decoded one by one with nothing but the dictionary in front."""
    warc_zstd.write(pages(spark, [(i, f"http://h/{i}", f"<p>page {i} " + "common text " * 50) for i in range(200)], 1), str(tmp_path / "a"))
    (file,) = [f for f in (tmp_path / "a").iterdir() if f.name.startswith("part-")]
    data = file.read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    raw = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    assert raw[:4] == b"\x37\xa4\x30\xec"
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    at, records = 8 + size, 0
    while at < len(data) - 8:
        part = decoder.decompressobj()
        assert part.decompress(data[at:]).startswith(b"WARC/1.1\r\n")
        at, records = len(data) - len(part.unused_data), records + 1
    assert records == 201 and data[at:] == b"\x50\x2a\x4d\x18\0\0\0\0"


def archive(*records: bytes, dictionary: bytes = b"") -> bytes:
    encoder = zstandard.ZstdCompressor(write_checksum=True)
    return dictionary + b"".join(encoder.compress(r) for r in records)


def faults(data: bytes) -> list:
    out = []
    for _, _, raw, fault in warc_zstd.frames(memoryview(data)):
        out.append(fault or warc_zstd.parse(raw).get("fault"))
    return out


GOOD = warc_zstd.page_record("1", "http://a/", b"payload", hashlib.sha1(b"payload").hexdigest(), None, "2020-01-01T00:00:00Z")


def test_good_record():
    row = warc_zstd.parse(GOOD)
    assert row["payload"] == b"payload" and row["payload_digest"] == hashlib.sha1(b"payload").hexdigest() and "fault" not in row


@pytest.mark.parametrize(
    "change, fault",
    [
        ((b"WARC/1.1", b"WARC/9.9"), "version"),
        ((b"WARC-Type: response\r\n", b""), "header"),
        ((b"WARC-Date: ", b"WARC-Date "), "header"),
        ((b"WARC-Type: response\r\n", b"WARC-Type: response\r\nWARC-Type: revisit\r\n"), "header"),
        ((b"\r\nContent-Length: 85", b"\r\nContent-Length: x85"), "header"),
        ((b"\r\nContent-Length: 85", b"\r\nContent-Length: 95"), "length"),
        ((b"payload\r\n\r\n", b"payload\r\n"), "length"),
        ((b"HTTP/1.1", b"XTTP/1.1"), "http"),
        ((b"Content-Length: 7", b"Content-Length: 8"), "http"),
        ((b"payload\r\n\r\n", b"payl0ad\r\n\r\n"), "digest"),
    ],
)
def test_faults_are_named(change, fault):
    assert change[0] in GOOD
    bad = GOOD.replace(*change)
    assert faults(archive(GOOD, bad, GOOD)) == [None, fault, None]


def test_damaged_frames():
    data = archive(GOOD, GOOD, GOOD)
    one = len(archive(GOOD))
    assert faults(data[:-3]) == [None, None, "frame"]
    assert faults(data[:one] + b"junk" + data[one:]) == [None, "frame"]
    flipped = bytearray(data)
    flipped[one - 1] ^= 1  # a checksum byte
    assert faults(bytes(flipped)) == ["decode", None, None]
    assert faults(b"") == []
    assert faults(struct.pack("<II", 0x184D2A5D, 4) + b"nope" + data) == ["decode"]
    trained = zstandard.train_dictionary(2000, [b"%d some sample text %d" % (i, i * 7) * 5 for i in range(200)])
    needing = zstandard.ZstdCompressor(dict_data=trained).compress(GOOD)
    assert faults(needing + archive(GOOD)) == ["decode", None]  # its dictionary is missing, the next frame needs none
    raw = struct.pack("<II", 0x184D2A5D, len(trained.as_bytes())) + trained.as_bytes()  # a dictionary that is not compressed
    assert faults(raw + needing) == [None]


def test_other_writings_are_read():
    hexed = GOOD.replace(b"sha1:" + base64.b32encode(hashlib.sha1(b"payload").digest()), b"SHA1:" + hashlib.sha1(b"payload").hexdigest().encode())
    assert hexed != GOOD
    assert warc_zstd.parse(hexed)["payload_digest"] == hashlib.sha1(b"payload").hexdigest()
    folded = GOOD.replace(b"WARC-Type: response", b"warc-type:\r\n response").replace(b"WARC/1.1", b"WARC/1.0")
    assert warc_zstd.parse(folded)["record_type"].strip() == "response"
    other = warc_zstd.record([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Date", "d"), ("Content-Type", "text/plain")], b"any block")
    assert warc_zstd.parse(other)["payload"] == b"any block"
    # a frame without its size and with a repeated-byte block
    stream = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    long = warc_zstd.page_record("1", "u", b"z" * 400_000, hashlib.sha1(b"z" * 400_000).hexdigest(), None, "d")
    assert faults(stream.compress(long) + stream.flush() + archive(GOOD)) == [None, None]


def test_empty_table(spark):
    at = Staging(spark, "warc-test").path("none")
    warc_zstd.write(pages(spark, [], 1), at)
    assert warc_zstd.read(spark, at).collect() == []


def test_hot_payload(spark, tmp_path):
    """A third of all pages share one payload: each is one record, no task gets them all."""
    body = "<p>" + "same words " * 120
    rows = [(i, "http://h/", body if i % 3 == 0 else f"{body}{i}") for i in range(600)]
    warc_zstd.write(pages(spark, rows, 6), str(tmp_path / "a"))
    read = warc_zstd.pages_in(warc_zstd.read(spark, str(tmp_path / "a")))
    got = sorted(((int(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_key and int(r.refers_key)) for r in read.collect()), key=repr)
    assert got == plain(rows)
    shares = [r["count"] for r in read.where("record_type = 'revisit'").groupBy("archive").count().collect()]
    assert len(shares) >= 4 and max(shares) < 100


def test_query_keeps_every_page(spark):
    small = "/root/testdata/sf0.001"
    got = queries.op12_warc_zstd(spark, small)
    assert got.where("fault is not null").count() == 0
    assert got.count() == spark.read.parquet(f"{small}/pages.parquet").count()
