"""WARC archives as Zstandard files: one frame per record, the dictionary in a leading skippable frame.

An archive begins with a skippable frame that holds the dictionary (as it is, or itself compressed); then every
record is a frame of its own, with its checksum, so that a record can be read without those before it.
Tasks fill archives of about ARCHIVE_BYTES and Spark's writer puts them into the folder, one file each:
a file ends with an empty skippable frame, which readers pass over. The dictionary of a task's archives is trained on its
first SAMPLE records; it changes sizes only, and a task with fewer than LEAST_SAMPLE records has none.

Writing: the payload is the page's text in UTF-8, null being empty. Of the pages with equal payloads of at least
`least` bytes the one with the largest id is a `response`; the others are `revisit` records, which keep
the HTTP header of the response but no payload and name the record they refer to. Smaller payloads are all
responses. Which payloads occur twice is an aggregate over (digest, id), which combines on the map side; the
pages are joined with those digests only, so Spark broadcasts them where they are few and splits a hot one
where they are not.

Ties: pages that share the largest id are all responses. A null id is never the largest beside others, and a
null id or address leaves its place empty. Repeated rows are records of their own with equal record ids.
Control characters, blanks and what is not ASCII in an address are percent-encoded. Extra columns are not
looked at. An empty table leaves a folder without archives, which reads as no records.

Reading: every frame of every archive is a row; what is wrong with it is named in `fault` (null if nothing is):
`frame` (no frame, or a cut one: the rest of that archive is one row), `decode` (damaged, or its dictionary
is missing), `version`, `header` (malformed lines, a needed field missing or twice), `length` (Content-Length is
not the block's), `http` (no HTTP header, or its length is not the payload's), `digest` (payload and digest
differ). Nothing is skipped silently.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowwarden.llm.textblocks import release

ARCHIVE_BYTES = 16 << 20
LEAST = 1000
DICTIONARY_BYTES = 64 << 10
SAMPLE, LEAST_SAMPLE, SAMPLE_BYTES = 256, 16, 16 << 10
LEVEL = 3

# fixed values of the formats
FRAME, DICTIONARY, SKIPPABLE, DICTIONARY_HEAD = 0xFD2FB528, 0x184D2A5D, 0x184D2A50, 0xEC30A437
EMPTY_FRAME = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")

RECORD = (
    "archive string, at long, length long, record_type string, record_id string, target_uri string, record_date string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary, fault string"
)


def record_id(key: str | None, digest: str) -> str:
    return f"<urn:x-page:{quote(key or '', safe='')}:{digest}>"


def key_of(identifier: Column) -> Column:
    """The page's id in a record id; null where there is none."""
    return F.nullif(F.regexp_extract(identifier, "^<urn:x-page:([^:]*):", 1), F.lit(""))


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def page_record(key: str | None, url: str | None, payload: bytes, digest: str, refers: tuple[str | None, str | None] | None, date: str) -> bytes:
    """A response, or with `refers` (id and address of the response) a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    address = lambda u: quote(u or "", safe="%!#$&'()*+,/:;=?@[]~")
    fields = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", record_id(key, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", address(url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if not refers:
        return record(fields, http + payload)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers[0], digest)), ("WARC-Refers-To-Target-URI", address(refers[1]))]
    return record(fields, http)


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    samples = [r[:SAMPLE_BYTES] for r in records]
    if len(samples) < LEAST_SAMPLE:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples, k=256, d=8)
    except zstandard.ZstdError:  # records too short or too alike
        return None


def archives(records: Iterator[bytes], size: int, date: str) -> Iterator[bytes]:
    """The records as archives of about `size` bytes, each complete in itself."""
    held, size_held = [], 0
    for r in records:
        held.append(r)
        size_held += len(r)
        if len(held) == SAMPLE or size_held >= SAMPLE * SAMPLE_BYTES:
            break
    trained = _dictionary(held)
    head = b""
    if trained:
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        head = struct.pack("<II", DICTIONARY, len(packed)) + packed
    encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
    about = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x-archive:info>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    frames, total = [], 0

    def following() -> Iterator[bytes]:
        while held:
            yield held.pop(0)
        yield from records

    for r in following():
        if not frames:
            frames = [head, encoder.compress(about)]
            total = sum(map(len, frames))
        frames.append(encoder.compress(r))
        total += len(frames[-1])
        if total >= size:
            yield b"".join(frames)
            frames = []
    if frames:
        yield b"".join(frames)


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "2020-01-01T00:00:00Z",
) -> None:
    """Write every page as a record into archives in `folder`, which must not exist."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    page = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest")
    )
    found = page.groupBy("digest").agg(F.count("*").alias("copies"), F.max(F.struct("key", "url")).alias("best"), F.max(F.octet_length("payload")).alias("size"))
    shared = found.where((F.col("copies") > 1) & (F.col("size") >= least)).select(F.col("digest").alias("its_digest"), "best")
    marked = page.join(shared, F.col("digest") == F.col("its_digest"), "left")
    revisit = F.col("best").isNotNull() & ~F.col("key").eqNullSafe(F.col("best.key"))
    rows = marked.select(
        F.col("key").cast("string").alias("key"), "url", "payload", "digest", revisit.alias("revisit"),
        F.col("best.key").cast("string").alias("best_key"), F.col("best.url").alias("best_url"),
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    k, u, p, d, again, bk, bu = (c[i].as_py() for c in batch.columns)
                    yield page_record(k, u, p, d, (bk, bu) if again else None, date)

        for archive in archives(records(), archive_bytes, date):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], names=["archive"])
        release()

    # the text writer puts the bytes of a row as they are; its line end is an empty skippable frame
    lines = rows.mapInArrow(fill, "archive binary").select(F.col("archive").cast("string"))
    lines.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


def frame_end(data: memoryview, at: int) -> int:
    """Where the compressed frame at `at` ends, from its block headers; past the data if it is cut."""
    end = at + zstandard.frame_header_size(data[at : at + 18])
    while True:
        if end + 3 > len(data):
            return len(data) + 1
        head = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        end += 3 + (1 if kind == 1 else size)  # a repeated byte is stored once
        if last:
            return end + (4 if zstandard.get_frame_parameters(data[at : at + 18]).has_checksum else 0)


def _skippable(data: memoryview, at: int) -> tuple[int, int] | None:
    """(magic, end) if a skippable frame starts at `at`."""
    if at + 8 > len(data):
        return None
    magic, size = struct.unpack_from("<II", data, at)
    return (magic, at + 8 + size) if magic & ~0xF == SKIPPABLE else None


def dictionary_of(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary in a leading skippable frame, and where the records begin; (None, 0) without one."""
    found = _skippable(data, 0)
    if found is None or found[0] != DICTIONARY:
        return None, 0
    raw = bytes(data[8 : found[1]])
    if raw[:4] == struct.pack("<I", FRAME):
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    if raw[:4] != struct.pack("<I", DICTIONARY_HEAD):
        raise ValueError("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT), found[1]


def frames(data: memoryview) -> Iterator[tuple[int, int, bytes | None, str | None]]:
    """(start, end, decoded record, fault) of each frame of an archive."""
    at = 0
    try:
        dictionary, at = dictionary_of(data)
    except (ValueError, zstandard.ZstdError):
        yield 0, len(data), None, "decode"
        return
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        skip = _skippable(data, at)
        if skip and skip[1] <= len(data):
            at = skip[1]
            continue
        try:
            end = frame_end(data, at) if bytes(data[at : at + 4]) == struct.pack("<I", FRAME) else len(data) + 1
        except zstandard.ZstdError:
            end = len(data) + 1
        if end > len(data):
            yield at, len(data), None, "frame"
            return
        try:
            yield at, end, decoder.decompressobj().decompress(data[at:end]), None
        except zstandard.ZstdError:
            yield at, end, None, "decode"
        at = end


def _fields(lines: list[bytes]) -> dict[str, str] | None:
    """Named fields, continuation lines joined; None if a line is none."""
    out: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:
            out[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        head, colon, value = line.partition(b":")
        name = head.decode("utf-8", "replace").lower()
        if not colon or not name or name != name.strip() or (name in out and name in NEEDED):
            return None
        out[name] = value.strip().decode("utf-8", "replace")
    return out


def _hex(digest: str | None) -> str | None:
    """A sha1 field as lower-case hex, whether it is written in hex or in base 32."""
    if not digest or not digest.lower().startswith("sha1:"):
        return None
    value = digest[5:]
    try:
        return (bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())).hex()
    except ValueError:
        return None


def parse(raw: bytes) -> dict:
    """The columns of one decoded record; `fault` names the first thing that is wrong."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1"):
        return {"fault": "version"}
    found = _fields(lines)
    if not blank or found is None or any(n not in found for n in NEEDED) or not (found["content-length"].isascii() and found["content-length"].isdigit()):
        return {"fault": "header"}
    out = {
        "record_type": found["warc-type"], "record_id": found["warc-record-id"], "record_date": found["warc-date"],
        "target_uri": found.get("warc-target-uri"), "refers_to": found.get("warc-refers-to"), "payload_digest": _hex(found.get("warc-payload-digest")),
    }
    size = int(found["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        return out | {"fault": "length"}
    block = rest[:size]
    if not found.get("content-type", "").startswith("application/http"):
        return out | {"payload": block, "payload_bytes": size}
    http, blank, payload = block.partition(b"\r\n\r\n")
    status, *lines = http.split(b"\r\n")
    inner = _fields(lines)
    stated = (inner or {}).get("content-length", "")
    if not blank or not status.startswith(b"HTTP/") or inner is None or (stated and not (stated.isascii() and stated.isdigit())):
        return out | {"fault": "http"}
    if out["record_type"] == "revisit":  # its payload lies in the record it refers to
        return out | {"payload_bytes": int(stated) if stated else None, "fault": "http" if payload else None}
    if stated and int(stated) != len(payload):
        return out | {"fault": "http"}
    out |= {"payload": payload, "payload_bytes": len(payload)}
    if out["payload_digest"] is not None and hashlib.sha1(payload).hexdigest() != out["payload_digest"]:
        return out | {"fault": "digest"}
    return out


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """One row per frame of every archive in `folder`; without `payload`, payloads are checked but not returned."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    names = [n for n in StructType.fromDDL(RECORD).names]
    kinds = {"at": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for given in batches:
            for i in range(given.num_rows):
                data = memoryview(given.column(1)[i].as_buffer())
                for at, end, raw, fault in frames(data):
                    row = {"fault": fault} if raw is None else parse(raw)
                    if not payload:
                        row.pop("payload", None)
                    rows.append({"archive": given.column(0)[i].as_py(), "at": at, "length": end - at, **row})
                    size += len(row.get("payload") or b"")
                    if len(rows) >= 4096 or size >= ARCHIVE_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        yield batch(rows)
        release()

    return files.mapInArrow(run, RECORD)


def pages_in(records: DataFrame) -> DataFrame:
    """The page records, with the page's id and the id of the page referred to as text."""
    page = records.where(F.col("record_type").isin("response", "revisit") | F.col("fault").isNotNull())
    return page.withColumn("key", F.url_decode(key_of(F.col("record_id")))).withColumn("refers_key", F.url_decode(key_of(F.col("refers_to"))))
