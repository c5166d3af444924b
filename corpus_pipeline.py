"""The training-corpus pipeline: stages over `documents`, each written as Parquet and read again.

1. language: texts without a letter, and texts so mixed that no language holds LEAST_SHARE of the
   letters, go. Without any label to learn from, only texts without a letter go.
2. near_copies: of each group of documents linked by the Jaccard join (over word 5-grams, similarity
   0.8 or more) one stays, the one with the smallest id. Rows are told apart by a key of their own, so
   rows with equal ids and different texts all stay, and rows without an id go as copies like others.
3. benchmark: documents contaminated by benchmark passages go.
4. secrets: every base span and every confirmed span is masked in the text, and n_chars follows.
5. packing: what is left becomes sequences; the result is the table of pieces.

Stages 1 to 4 return the columns of documents. A null or empty text goes in stage 1. Extra columns of any
name pass through untouched. An empty table passes through all stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowwarden.llm import decontaminate, jaccard_join, language, packing, queries, secret_scan
from rowwarden.llm.exchange import settle
from rowwarden.llm.staging import Staging
from rowwarden.session import checkpoint_dir
from rowwarden.sources.tables import table

LEAST_SHARE = 0.4
NEAR_GRAM, NEAR_PERCENT = 5, 80
MASK = {kind: f"[{kind.upper()}]" for kind in secret_scan.KINDS}


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs)
    if not model.languages:  # nothing to judge by: texts with a letter stay
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.labelled(docs, model)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_SHARE))
    return kept.select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row, group = fresh(docs, "row"), fresh(docs, "group")
    keyed = steady(docs).withColumn(row, F.monotonically_increasing_id())
    linked = jaccard_join.join(keyed, NEAR_GRAM, NEAR_PERCENT, key=row).where("component_id is not null")
    linked = settle(linked.select(F.col("doc_id").alias(row), F.col("component_id").alias(group)))
    copied = linked.where(F.col(row) != F.col(group)).select(group).distinct()
    members = linked.join(copied, group, "left_semi").join(keyed.select(row, "doc_id"), row)
    stays = members.groupBy(group).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))[row].alias(row))
    goes = settle(members.select(row).join(stays.select(row), row, "left_anti"))
    return keyed.join(goes, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def steady(docs: DataFrame) -> DataFrame:
    """docs if it is a written table, whose rows have the same places in every read; else a written copy of it."""
    plan = docs._jdf.queryExecution().optimizedPlan().nodeName()
    return docs if plan == "LogicalRelation" else Staging(docs.sparkSession, "corpus").keep(docs, "docs")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name in df.columns:
        name = f"{name}_"
    return name


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.masked(docs, MASK, "n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

# a trained model and token ids are beyond SQL: tests compare each stage with brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before has written to the shared folder."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
