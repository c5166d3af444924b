"""Language identification of texts that may mix languages.

Fit: a bounded sample of labelled documents (about `PER_LANGUAGE` of each language, chosen by a hash
of the id, so alike on every run) gives smoothed log-likelihoods of hashed byte n-grams per language
and the scripts each language is written in. The model has `BUCKETS` rows whatever the input, and a
column for every label there is. Tasks hold counts of `HELD_LANGUAGES` languages and scores of
`CELLS` words times languages at a time, and the driver reads `HELD_LANGUAGES` columns at a time.

Prediction, per text: the script of a word (from the code points of its letters) narrows the
languages it can be in; the word's n-grams score those that are left; Viterbi over the words, with
a penalty for every switch of language, labels the text with spans. The predicted language is the
one whose spans hold most letters, and the score is its share of the letters.

Null text or text without a letter: `und`, score 0, no spans. No labelled row at all: every text is
`und`. Ties go to the language first in alphabetical order. Repeated rows: one result each. Empty
table: empty result. Labels, sources and ids are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.textblocks import Block, Words, beside, blocks, mix, prefix, span_hash, words
from rowwarden.session import cut_lineage

UNKNOWN = "und"
BUCKETS = 1 << 16
SIZES = (1, 2, 3, 4)  # n-gram bytes, a word's edges included
PER_LANGUAGE = 4000  # labelled documents read per language, as the sample's expected size
HELD_LANGUAGES = 64  # languages whose counts a task or the driver holds at a time
CELLS = 1 << 22  # words times languages scored at a time (or one longer text)
SWITCH_PENALTY = 12.0  # nats
LEAST_SCRIPT_SHARE = 0.001
HELD_OUT = 5

# scripts by ranges of code points; a letter outside them is of script "other", and what is no letter of "none"
SCRIPTS = (
    "none", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "syriac", "thaana", "nko",
    "south_asian", "georgian", "ethiopic", "kana", "han", "hangul", "other",
)
_RANGES = [
    (0x0000, 0x02AF, "latin"), (0x1D00, 0x1D25, "latin"), (0x1E00, 0x1EFF, "latin"), (0x2C60, 0x2C7F, "latin"), (0xA722, 0xA7FF, "latin"),
    (0xAB30, 0xAB64, "latin"), (0xFB00, 0xFB06, "latin"), (0xFF21, 0xFF5A, "latin"), (0x0370, 0x03FF, "greek"), (0x1F00, 0x1FFF, "greek"),
    (0x0400, 0x052F, "cyrillic"), (0x1C80, 0x1C8F, "cyrillic"), (0x2DE0, 0x2DFF, "cyrillic"), (0xA640, 0xA69F, "cyrillic"),
    (0x0530, 0x058F, "armenian"), (0xFB13, 0xFB17, "armenian"), (0x0590, 0x05FF, "hebrew"), (0xFB1D, 0xFB4F, "hebrew"),
    (0x0600, 0x06FF, "arabic"), (0x0750, 0x077F, "arabic"), (0x0870, 0x08FF, "arabic"), (0xFB50, 0xFDFF, "arabic"), (0xFE70, 0xFEFE, "arabic"),
    (0x0700, 0x074F, "syriac"), (0x0860, 0x086F, "syriac"), (0x0780, 0x07BF, "thaana"), (0x07C0, 0x07FF, "nko"), (0x0900, 0x0FFF, "south_asian"),
    (0x10A0, 0x10FF, "georgian"), (0x1C90, 0x1CBF, "georgian"), (0x2D00, 0x2D2F, "georgian"), (0x1200, 0x139F, "ethiopic"), (0x2D80, 0x2DDF, "ethiopic"),
    (0x3040, 0x30FF, "kana"), (0x31F0, 0x31FF, "kana"), (0xFF66, 0xFF9F, "kana"), (0x3005, 0x3007, "han"), (0x3400, 0x9FFF, "han"), (0xF900, 0xFAFF, "han"),
    (0x20000, 0x3FFFF, "han"), (0x1100, 0x11FF, "hangul"), (0x3130, 0x318F, "hangul"), (0xA960, 0xA97F, "hangul"), (0xAC00, 0xD7FF, "hangul"),
]
_POINTS = 0x40000  # no letter lies above
SCRIPT_OF = np.fromiter((chr(c).isalpha() for c in range(_POINTS)), bool, _POINTS) * np.uint8(len(SCRIPTS) - 1)
for _low, _high, _script in _RANGES:
    SCRIPT_OF[_low : _high + 1] = np.where(SCRIPT_OF[_low : _high + 1] > 0, SCRIPTS.index(_script), 0)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages, log-likelihoods
    scripts: np.ndarray  # scripts x languages, allowed or not
    known: dict = field(default_factory=dict)


def held_out(key: Column) -> Column:
    """Whether a document is kept from fitting."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the buckets of the n-grams of the given words, and the word of each."""
    size = (end - start + 2).astype(np.int32)  # one edge byte on each side
    last = np.cumsum(size, dtype=np.int32)
    word = np.repeat(np.arange(len(start), dtype=np.int32), size)
    inner = np.arange(len(word), dtype=np.int32) - (last - size)[word]
    left = size[word] - inner
    flat = np.full(len(word), 0x20, np.uint8)
    body = (inner > 0) & (left > 1)
    flat[body] = data[(start[word] + inner - 1)[body]]
    del inner
    code = np.zeros(len(flat), np.uint64)
    for n in range(1, max(SIZES) + 1):
        code *= np.uint64(257)
        code[: len(flat) - n + 1] += flat[n - 1 :].astype(np.uint64) + np.uint64(1)
        if n in SIZES:
            ok = body if n == 1 else left >= n
            yield (mix(code[ok] * np.uint64(8) + np.uint64(n)) >> np.uint64(48)).astype(np.int32), word[ok]


def letter_scripts(data: np.ndarray) -> np.ndarray:
    """The script number of the character that starts at each byte of UTF-8 text (0: no letter, or not a first byte)."""
    out = SCRIPT_OF[:256][data]
    out[data >= 0x80] = 0
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        byte = data[lead].astype(np.int32)
        point = byte & np.where(byte < 0xE0, 0x1F, np.where(byte < 0xF0, 0x0F, 0x07))
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            more = byte >= least
            point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
        out[lead] = np.where(point < _POINTS, SCRIPT_OF[np.minimum(point, _POINTS - 1)], 0)
    return out


def word_scripts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The highest script number among the letters of each of the given words, in order (0: no letter)."""
    return np.maximum.reduceat(letter_scripts(data), start) if len(start) else np.zeros(0, np.uint8)


def _distinct(block: Block, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of a block, where each first stands, and the number of every word."""
    keys = span_hash(prefix(block.data), found.start, found.end)
    return np.unique(keys, return_index=True, return_inverse=True)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Model of the labelled documents that are not held out, from a bounded sample of them."""
    labelled = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("body"), F.col(lang).cast("string").alias("label"))
    labelled = labelled.where(F.col("label").isNotNull() & F.col("body").isNotNull() & ~held_out(F.col("k")))
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one row per language
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    share = F.create_map(*[x for c in languages for x in (F.lit(c), F.lit(min(1.0, per_language / counts[c])))])
    draw = F.pmod(F.xxhash64("k", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(draw < share[F.col("label")]).select("body", F.array_position(F.array(*map(F.lit, languages)), F.col("label")).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}

        def flush():
            for c, own in sorted(total.items()):
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), c, np.int64)), pa.array(own[at])], names=["feature", "number", "n"])
            total.clear()

        for block in blocks(batches, "body", lower=True):
            found = words(block)
            number = block.column("number").to_numpy(zero_copy_only=False)[found.row].astype(np.int64) - 1
            if not len(found.start):
                continue
            _, first, which = _distinct(block, found)
            which = which.reshape(-1)
            script = word_scripts(block.data, found.start, found.end)
            order = np.argsort(number, kind="stable")
            edge = np.flatnonzero(np.diff(number[order], prepend=-1, append=-1))
            for a, b in zip(edge[:-1], edge[1:]):
                mine = order[a:b]
                c = int(number[mine[0]])
                if c not in total and len(total) >= HELD_LANGUAGES:
                    yield from flush()
                own = total.setdefault(c, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                kinds, often = np.unique(which[mine], return_counts=True)
                for bucket, word in grams(block.data, found.start[first[kinds]], found.end[first[kinds]]):
                    own[:BUCKETS] += np.bincount(bucket, often[word], BUCKETS).astype(np.int64)
                own[BUCKETS:] += np.bincount(script[mine], minlength=len(SCRIPTS))
        yield from flush()

    # at most (BUCKETS + scripts) x languages rows, read for some languages at a time
    summed = sample.mapInArrow(run, "feature long, number long, n long").groupBy("feature", "number").agg(F.sum("n").alias("n"))
    if len(languages) > HELD_LANGUAGES:
        summed = cut_lineage(summed)
    weights = np.zeros((BUCKETS, len(languages)), np.float32)
    allowed = np.zeros((len(SCRIPTS), len(languages)), bool)
    for low in range(0, len(languages), HELD_LANGUAGES):
        high = min(low + HELD_LANGUAGES, len(languages))
        part = summed.where(F.col("number").between(low, high - 1)).toArrow()
        total = np.zeros((BUCKETS + len(SCRIPTS), high - low))
        total[part.column("feature").to_numpy(), part.column("number").to_numpy() - low] = part.column("n").to_numpy()
        grammed, scripts = total[:BUCKETS] + 0.5, total[BUCKETS:]
        weights[:, low:high] = np.log(grammed / grammed.sum(0))
        allowed[:, low:high] = scripts >= LEAST_SCRIPT_SHARE * np.maximum(scripts[1:].sum(0), 1)
    allowed[~allowed.any(1)] = True
    allowed[0] = True
    return Model(languages, weights, allowed)


def word_scores(model: Model, block: Block, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words x languages: log-likelihoods, -inf-like where the script rules a language out; and the number of every word."""
    _, first, which = _distinct(block, found)
    start, end = found.start[first], found.end[first]
    script = word_scripts(block.data, found.start, found.end)[first]  # of words in order
    scores = np.zeros((len(first), len(model.languages)), np.float32)
    for s in np.unique(script[script > 0]):  # digits and signs speak for no language
        own, able = np.flatnonzero(script == s), np.flatnonzero(model.scripts[s])
        for bucket, word in grams(block.data, start[own], end[own]):
            for c in able:
                scores[own, c] += np.bincount(word, model.weights[bucket, c], len(own))
    bar = scores.min() - 1e4 if len(scores) else 0
    for s in np.unique(script[script > 0]):
        scores[np.ix_(script == s, ~model.scripts[s])] = bar
    return scores, which.reshape(-1)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float, which: np.ndarray | None = None) -> np.ndarray:
    """The best language of every word, switches costing `penalty`; all texts advance together.

    scores: a row per word, or per distinct word with `which` as the row of every word.
    """
    n, width = len(scores) if which is None else len(which), scores.shape[1]
    label = np.zeros(n, np.int32)
    if not n or width == 1:
        return label
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    heads, size = first[:-1][order], size[order]
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(longest), "left")  # texts with more than t words
    best = np.zeros((len(size), width), np.float64)
    stayed = np.zeros((n, -(-width // 8)), np.uint8)  # a bit per word and language
    source = np.zeros(n, np.int32)
    for t in range(longest):
        live = best[: active[t]]
        at = heads[: active[t]] + t
        if t:
            top = live.argmax(1)
            jump = live[np.arange(len(live)), top] - penalty
            keep = live >= jump[:, None]
            stayed[at], source[at] = np.packbits(keep, axis=1), top
            np.maximum(live, jump[:, None], out=live)
            live -= live.max(1, keepdims=True)
        live += scores[at if which is None else which[at]]
    now = best.argmax(1)
    for t in range(longest - 1, -1, -1):
        at = heads[: active[t]] + t
        live = now[: active[t]]
        label[at] = live
        if t:
            now[: active[t]] = np.where(stayed[at, live >> 3] >> (7 - (live & 7)) & 1, live, source[at])
    return label


def has_letter(block: Block) -> np.ndarray:
    data = block.data
    plain = block.per_row(((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)) > 0
    for i in np.flatnonzero(~plain & (block.per_row(data >= 0x80) > 0)):
        plain[i] = any(c.isalpha() for c in block.text(i))
    return plain


def _slices(found: Words, width: int) -> Iterator[tuple[int, int]]:
    """Rows [a, b) of a block whose words and rows times languages are at most CELLS, or one row."""
    done, docs, a = found.first + np.arange(len(found.first)), len(found.first) - 1, 0
    while a < docs:
        b = min(max(int(np.searchsorted(done, done[a] + CELLS // width, "right")) - 1, a + 1), docs)
        yield a, b
        a = b


def _labels(model: Model, penalty: float, block: Block) -> dict[str, pa.Array]:
    """Predicted language, its share of the letters, and the spans, per row of a block in lower case."""
    names, width = np.array([*model.languages, UNKNOWN], object), len(model.languages)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string())]))
    found, docs = words(block), len(block)
    letter = has_letter(block) & (width > 0)
    pred, share = np.full(docs, width), np.zeros(docs)
    spans: list[list[dict]] = [[] for _ in range(docs)]
    if len(found.start) and width:
        label = np.zeros(len(found.start), np.int32)
        weight = np.where(word_scripts(block.data, found.start, found.end) > 0, found.end - found.start, 0)
        for a, b in _slices(found, width):
            part = slice(found.first[a], found.first[b])
            low, high = block.offsets[a], block.offsets[b]
            own = Words(found.start[part] - low, found.end[part] - low, found.row[part] - a, found.first[a : b + 1] - found.first[a])
            scores, which = word_scores(model, Block(None, block.data[low:high], block.offsets[a : b + 1] - low), own)
            label[part] = viterbi(scores, own.first, penalty, which)
            del scores
            mass = np.bincount(own.row * width + label[part], weight[part], (b - a) * width).reshape(b - a, width)
            pred[a:b] = np.where(letter[a:b], mass.argmax(1), width)
            share[a:b] = np.where(letter[a:b], mass.max(1) / np.maximum(mass.sum(1), 1), 0.0)
        edge = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (found.row[1:] != found.row[:-1]))))
        last = np.concatenate((edge[1:], [len(label)])) - 1
        for a, b, d in zip(edge, last, found.row[edge]):
            if letter[d]:
                spans[d].append({"first": int(a - found.first[d]), "last": int(b - found.first[d]), "lang": names[label[a]]})
    return {
        "lang_pred": pa.array(names[pred], pa.string()),
        "lang_score": pa.array(share, pa.float64()),
        "lang_spans": pa.array(spans, kind),
    }


def labelled(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, text: str = "text") -> DataFrame:
    """docs with lang_pred, lang_score and lang_spans (in words: first, last, lang) beside all columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats
    added = "lang_pred string, lang_score double, lang_spans array<struct<first: long, last: long, lang: string>>"
    return beside(docs, text, lambda block: _labels(sent.value, penalty, block), added, lower=True)


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, and the language spans in words (first, last, lang)."""
    found = labelled(docs.select(docs[key].cast("long").alias("doc_id"), docs[text]), model, penalty, text)
    return found.select("doc_id", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_spans").alias("spans"))
