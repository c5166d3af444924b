"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

The piece model is read as data: pieces, scores and types. A text becomes the model's symbols, the
adjacent pair of lowest rank (leftmost among equals) is merged until none is left, and the count is
initial symbols minus merges. A character that is no piece counts as its UTF-8 bytes.

Blanks only ever start a piece (checked when the model is read), so no merge crosses from a
non-blank to a blank. A text is therefore counted as the sum over its blank-led segments, and a
worker keeps the counts of segments it has met (cleared when `cache_size` is reached).

Null or empty text: 0 tokens. Repeated rows: one result each. Empty table: empty result.
Columns other than the two named are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowwarden.llm.textblocks import blocks

BLANK = "▁"
NORMAL, UNUSED = 1, 5
SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
COLUMNS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class PieceModel:
    """Ranks of the pieces of a byte-fallback piece model, and the merge count of a segment."""

    def __init__(self, path: str, cache_size: int = 1_000_000):
        from sentencepiece import sentencepiece_model_pb2

        self.path, self.cache_size, self.cache = path, cache_size, {}
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        merges = proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        if not merges or not proto.trainer_spec.byte_fallback:
            raise ValueError("a pair-merging model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("the model rewrites characters")
        self.lead = BLANK if spec.add_dummy_prefix else ""
        kept = [p for p in proto.pieces if p.type == NORMAL]
        if any(p.type == UNUSED or p.type == 4 for p in proto.pieces):
            raise ValueError("unused or user-defined pieces are not supported")
        if any(BLANK in p.piece.lstrip(BLANK) for p in kept):
            raise ValueError("a piece holds a blank after a letter")
        order = sorted(kept, key=lambda p: -p.score)
        self.rank, last = {}, None
        for p in order:
            if p.score != last:
                last, place = p.score, len(self.rank)
            self.rank[p.piece] = place

    def merged(self, segment: str) -> int:
        """Tokens of one segment: symbols minus merges, unknown symbols by their bytes."""
        rank, lowest = self.rank, self.rank.get
        symbols: list[str | None] = list(segment)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [a + b for a, b in zip(symbols, symbols[1:])]
        heap = [(r, i, p) for i, p in enumerate(pairs) if (r := lowest(p)) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = symbols[i]
            if left is None or (j := after[i]) >= n or left + symbols[j] != pair:
                continue  # one of the two was merged away since
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                joined = pair + symbols[k]
                if (r := lowest(joined)) is not None:
                    heapq.heappush(heap, (r, i, joined))
            if (h := before[i]) >= 0:
                joined = symbols[h] + pair
                if (r := lowest(joined)) is not None:
                    heapq.heappush(heap, (r, h, joined))
            merges += 1
        extra = sum(len(s.encode()) - 1 for s in symbols if s is not None and len(s) == 1 and s not in rank)
        return n - merges + extra

    def count(self, text: str) -> int:
        if not text:
            return 0
        cache, total = self.cache, 0
        for segment in SEGMENT.findall(self.lead + text.replace(" ", BLANK)):
            found = cache.get(segment)
            if found is None:
                found = self.merged(segment)
                if len(segment) <= 64:
                    if len(cache) >= self.cache_size:
                        cache.clear()
                    cache[segment] = found
            total += found
        return total


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, UTF-8 bytes, tokens, and whether the tokens pass `limit`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for block in blocks(batches, text):
            tokens = np.array([pieces.count(block.text(i)) for i in range(len(block))], np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.column(key), pa.array(np.diff(block.offsets)), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(docs[key].cast("long").alias(key), docs[text]).mapInArrow(run, COLUMNS)
