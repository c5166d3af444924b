"""Quality rules with cross-document line frequency.

Base rules look at one document. The method: every line is normalised (lower case, white space
collapsed) and hashed, the distinct documents of a host that hold it are counted, lines above the
limit are removed, and a document left with too few of its words is rejected. The limit is a number of
documents of a host, the same for a host of any size: a notice is as much of a notice on a large one.

One pass over the texts gives a row per document with its base measures and its distinct lines
(hash and words). Counting, the limits and the verdict are joins and aggregates over those.

Null or empty text: no words, fails the base rules. A null host is a host of its own. Repeated
rows, null ids included, are documents of their own (a row key is made per row). Empty table:
empty result. Columns other than the three named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.textblocks import Block, blocks, covered, mix, prefix, span_hash, windows, word_hashes, words
from rowwarden.session import cut_lineage

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*b"#*$%&|<>"]] = True
LEAST_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20

MOST_DOCS = 10  # of a host; a line in more of them is boilerplate
LEAST_LEFT = 0.5  # of a document's words, after its frequent lines are gone

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(block: Block) -> dict[str, np.ndarray]:
    """Base measures of every row of a block."""
    found = words(block)
    n, data = len(found.start), block.data
    letters = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, found.start, 1)
    np.add.at(inside, found.end, -1)
    hashes = word_hashes(data, found)
    size = REPEAT_WINDOW
    at = np.flatnonzero(found.left() >= size)
    keys = mix(windows(hashes, size)[at] ^ mix(found.row[at].astype(np.uint64)))  # equal only within a row
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(keys) else np.zeros(0, bool)
    repeated = covered(n, at[order[again]], size)
    return {
        "n_words": found.counts(),
        "word_chars": block.per_row(letters & (np.cumsum(inside[:-1]) > 0)),
        "n_symbols": block.per_row(SYMBOLS[data]),
        "n_dup_lines": duplicate_lines(block, found.start),
        "n_repeat_words": np.diff(np.concatenate(([0], np.cumsum(repeated)))[found.first]),
    }


def duplicate_lines(block: Block, word_starts: np.ndarray) -> np.ndarray:
    """Lines of each row that hold a word and equal an earlier line of the row."""
    data = block.data
    feed = np.flatnonzero(data == 0x0A)
    start = np.union1d(feed + 1, block.offsets[:-1])
    start = start[start < len(data)]
    row = np.searchsorted(block.offsets, start, "right") - 1
    nxt = np.concatenate((start[1:], [len(data)]))
    end = np.where(data[nxt - 1] == 0x0A, nxt - 1, nxt)
    end = np.maximum(np.minimum(end, block.offsets[row + 1]), start)
    full = np.searchsorted(word_starts, start) < np.searchsorted(word_starts, end)
    start, end, row = start[full], end[full], row[full]
    keys = mix(span_hash(prefix(data, 1), start, end, 1) ^ mix(row.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    later = np.ones(len(keys), bool)
    later[first] = False
    return np.bincount(row[later], minlength=len(block))


def normal_lines(text: str) -> dict[int, int]:
    """Hash of each distinct normalised line with a word, and the words all its copies hold."""
    out: dict[int, int] = {}
    for line in text.lower().split("\n"):
        parts = line.encode().split()
        if parts:
            key = xxhash.xxh3_64_intdigest(b" ".join(parts)) - (1 << 63)
            out[key] = out.get(key, 0) + len(parts)
    return out


def profile(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: a row key, id, host, base measures, lines (array of hash and words)."""
    line = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for block in blocks(batches, text):
            base = measures(block)
            lines = [[{"line": k, "words": n} for k, n in normal_lines(block.text(i)).items()] for i in range(len(block))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(block))),
                    block.column(key),
                    pc.fill_null(block.column(host), "\0"),
                    *(pa.array(base[m].astype(np.int64)) for m in MEASURES),
                    pa.array(lines, line),
                ],
                names=["row_key", "doc_id", "host", *MEASURES, "lines"],
            )
            row += len(block)

    fields = ", ".join(f"{m} long" for m in MEASURES)
    picked = docs.select(docs[key].cast("long").alias(key), docs[text], docs[host].cast("string").alias(host))
    return picked.mapInArrow(
        run, f"row_key long, doc_id long, host string, {fields}, lines array<struct<line: long, words: long>>"
    )


def quality(
    docs: DataFrame,
    most_docs: int = MOST_DOCS,
    least_left: float = LEAST_LEFT,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """Base measures, frequent words, and the verdict of every document."""
    rows = cut_lineage(profile(docs, key, text, host))
    lines = rows.select("row_key", "host", F.explode("lines").alias("l")).select("row_key", "host", "l.line", "l.words")
    # one row per line and host on the map side; a hot line of the join below is split, as this side has it once
    frequent = lines.groupBy("host", "line").agg(F.count("*").alias("line_docs")).where(F.col("line_docs") > most_docs).select("host", "line")
    lost = lines.join(frequent, ["host", "line"]).groupBy("row_key").agg(F.sum("words").alias("lost_words"))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    n_lost = F.coalesce("lost_words", F.lit(0))
    return (
        rows.drop("lines")
        .join(lost, "row_key", "left")
        .select(
            "doc_id",
            *MEASURES,
            n_lost.alias("n_frequent_words"),
            base_failed.alias("base_failed"),
            (~base_failed & (F.col("n_words") - n_lost >= least_left * F.col("n_words"))).alias("kept"),
        )
    )
