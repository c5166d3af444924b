"""Stages of the pipeline one by one, against what each promises."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from rowwarden.llm import queries, secret_scan
from rowwarden.llm.oracles import ORACLES

from .conftest import frame
from .test_repeats import plain_components
from .test_rowwise import bench_words, plain_base, secret_texts

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark, rows):
    extra = [(8000 + i, f"{t} {rows[0][1]} {i}", "en", "s") for i, t in enumerate(secret_texts())]
    return rows + extra + [(None, rows[2][1], "en", "s"), (3, rows[3][1], "en", "s"), (3, rows[3][1], "en", "s")]


@pytest.fixture(scope="module")
def docs(spark, given):
    return frame(spark, given, 4)


def texts(found) -> list[tuple]:
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in found.collect())


def test_language_stage(spark, docs, given):
    out = corpus_pipeline.language_stage(spark, docs, SMALL)
    assert out.columns == docs.columns
    want = sorted((d is None, d or 0, t) for d, t, *_ in given if any(c.isalpha() for c in t or ""))
    assert texts(out) == want


def test_language_stage_without_labels(spark, given):
    out = corpus_pipeline.language_stage(spark, frame(spark, [(d, t, None, s) for d, t, _, s in given], 2), SMALL)
    want = sorted((d is None, d or 0, t) for d, t, *_ in given if any(c.isalpha() for c in t or ""))
    assert texts(out) == want


def test_near_copy_stage(spark, docs, given):
    out = corpus_pipeline.near_copy_stage(spark, docs, SMALL)
    assert out.columns == docs.columns
    assert texts(out) == sorted(left_over(given))


def left_over(given) -> list[tuple]:
    """One row of each group of linked rows, that with the smallest id; rows are told apart by their place."""
    group = {i: c for _, i, _, c in plain_components([(i, *r[1:]) for i, r in enumerate(given)], 5, 80)}
    first: dict[int, tuple] = {}
    for i, (d, t, *_) in enumerate(given):
        own = (d is None, d or 0, t or "")
        first[group[i]] = min(first.get(group[i], own), own)
    return list(first.values())


def test_near_copies_keep_rows_that_share_an_id(spark, rows):
    long = [t for _, t, *_ in rows if t and len(t.split()) > 150]
    assert len(long) > 5
    given = [(1, long[0], "en", "s"), (1, long[1], "en", "s"), (1, long[0], "en", "s"), (2, long[0] + " end", "en", "s"), (None, long[2], "en", "s"),
             (None, long[2], "en", "s"), (None, long[3], "en", "s"), (5, None, "en", "s"), (5, "", "en", "s"), (6, "", "en", "s")]
    out = corpus_pipeline.near_copy_stage(spark, frame(spark, given, 3), SMALL)
    assert texts(out) == sorted(left_over(given))
    assert out.count() == 7  # two texts under id 1, two without an id, and the three without words


@pytest.mark.parametrize("names", [["_id", "_first", "n", "c"], ["hub", "rep", "node", "doc"], ["row", "group", "row_", "component"], ["n_shingles", "fp_a", "packed", "linked"]])
def test_extra_columns_pass_through_the_stages(spark, rows, names):
    given = rows[:25] + [rows[3]]
    docs = spark.createDataFrame(
        [(d, t, la, s, len(t or ""), f"x{d}", 5, True, "z") for d, t, la, s in given], f"doc_id long, text string, lang string, source string, n_chars long, {names[0]} string, {names[1]} int, {names[2]} boolean, `{names[3]}` string"
    ).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert all(tuple(r)[5:] == (f"x{r.doc_id}", 5, True, "z") for r in out.collect()), name
    assert corpus_pipeline.packing_stage(spark, docs, SMALL).count() >= 26


def test_benchmark_stage(spark, given, rows, tmp_path):
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    mixed = [(1, f"{passage} tail", "en", "s"), (2, "clean text only", "en", "s"), (1, "same id, clean", "en", "s"), (None, passage, "en", "s"), (4, None, "en", "s")]
    out = corpus_pipeline.benchmark_stage(spark, frame(spark, mixed, 2), SMALL)
    assert len(bench_words(passage)) >= 13
    assert texts(out) == sorted([(False, 2, "clean text only"), (False, 1, "same id, clean"), (False, 4, "")])


def test_secret_stage(spark, docs, given):
    out = corpus_pipeline.secret_stage(spark, docs, SMALL)
    assert out.columns == docs.columns and out.count() == len(given)
    for r in out.collect():
        assert not plain_base(r.text or "") and not secret_scan.confirmed_spans(r.text or "")
        assert r.n_chars == len(r.text or "")
    kept = {(r.doc_id, r.text) for r in out.collect()}
    assert all((d, t) in kept for d, t, *_ in given if t and not plain_base(t) and not secret_scan.confirmed_spans(t))


def test_run_over_the_table(spark):
    out = corpus_pipeline.run(spark, SMALL).collect()
    given = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert 0.6 * given < len(by_doc) < given
    assert all(sum(p.length for p in ps) == ps[0].doc_tokens for ps in by_doc.values())


def test_empty_table(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SMALL).count() == 0


@pytest.mark.parametrize("name", ORACLES)
def test_queries_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings", "conversations"):
        db.sql(f"create view {t} as from '{SMALL}/{t}.parquet'")
    want = db.sql(ORACLES[name])
    found = queries.QUERIES[name](spark, SMALL).select(*want.columns)
    assert sorted(map(tuple, found.collect())) == sorted(want.fetchall())


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_mask_joins_overlapping_spans():
    text = 'x token = "' + "ab" * 20 + '" y'
    assert secret_scan.mask(text, secret_scan.base_spans(text), corpus_pipeline.MASK) == 'x [ASSIGN]" y'
