"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, row_key string"

VOCABULARY = {
    "en": "the of and that with from house river stone light under never always people water night".split(),
    "fr": "le de et que avec maison rivière pierre lumière sous jamais toujours gens eau nuit être".split(),
    "de": "der und dass mit von haus fluss stein licht unter niemals immer leute wasser nacht über".split(),
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    words = [rng.choice(VOCABULARY[lang]) + rng.choice(["", "", "s", "en", "ly"]) for _ in range(n)]
    return " ".join(words)


def corpus(seed: int = 5, n: int = 120) -> list[tuple]:
    """(doc_id, text, lang, source) with exact and near copies, shared passages and odd texts."""
    rng = random.Random(seed)
    passage = sentence(rng, "en", 70)
    rows: list[tuple] = []
    for i in range(n):
        lang = rng.choice(list(VOCABULARY))
        text = sentence(rng, lang, rng.choice([1, 5, 12, 13, 14, 40, 200, 600]))
        if i % 9 == 0:
            text = f"{text}\n{passage}\n{sentence(rng, lang, 15)}"
        if i % 11 == 0 and rows:
            text = rows[rng.randrange(len(rows))][1]
        if i % 13 == 0 and rows:
            words = rows[rng.randrange(len(rows))][1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((i, text, lang, f"src{i % 3}"))
    odd = [
        "", None, " \t\n\r\x0b\x0c ", "x", "word " * 400, "a" * 5000, " non breaking space", "1234 5678 !!", "naïve café — 漢字かな Ελλάδα мир",
        f"{passage} tail one", f"﻿{passage}", "line\nline\n\nline \nother", "Ünder\x00nul \x1f sep \x85   end",
    ]
    rows += [(1000 + k, t, None if k % 2 else "en", None if k % 3 == 0 else "src9") for k, t in enumerate(odd)]
    return rows


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return corpus()


def frame(spark: SparkSession, rows: list[tuple], parts: int = 3) -> DataFrame:
    full = [(d, t, la, s, len(t or ""), 7, "clash") for d, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


@pytest.fixture(scope="session")
def docs(spark, rows) -> DataFrame:
    return frame(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark) -> DataFrame:
    return frame(spark, [], 1)
