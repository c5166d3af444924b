"""Queries of the numbered operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowwarden.llm import (
    decontaminate, html_text, jaccard_join, language, line_frequency, packing, prefix_trie, repeated_windows, secret_scan, suffix_dedup,
    token_counts, vector_codes, warc_zstd,
)
from rowwarden.llm.oracles import ORACLES  # noqa: F401
from rowwarden.llm.staging import Staging
from rowwarden.sources.tables import table


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies on this machine; executors have the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_tag_path_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))

    def joined(spans):
        part = lambda s: F.concat_ws(":", s["kind"], s["start_at"].cast("string"), s["end_at"].cast("string"))
        return F.array_join(F.transform(spans, part), ",")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, folder, "documents")).drop("removed")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents"))


def op7_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return line_frequency.quality(table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_fixed_block_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_windows.repeats(table(spark, folder, "documents")).drop("removed")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation with the first turns of the one whose id is the next lower multiple of 20."""
    whole = prefix_trie.paths(conversations)
    turns = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    return prefix_trie.graft(whole, F.col("conv_id") - F.col("conv_id") % 20, turns, 3)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(rebuilt(table(spark, folder, "conversations")))


def op12_warc_zstd(spark: SparkSession, folder: str) -> DataFrame:
    at = Staging(spark, "warc").path("archives")
    warc_zstd.write(table(spark, folder, "pages"), at)
    found = warc_zstd.pages_in(warc_zstd.read(spark, at, payload=False))
    return found.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_key").cast("long").alias("refers_to"), "fault"
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, folder, "embeddings"))
    digest = F.sha2(F.lit(vector_codes.books_text(books)), 256)
    found = vector_codes.with_label_error(coded)
    return found.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_harmonic_packing,
        op2_tag_path_ratios,
        op3_secret_scan,
        op4_suffix_dedup,
        op5_language_id,
        op6_jaccard_join,
        op7_line_frequency,
        op8_token_counts,
        op9_fixed_block_anchors,
        op10_decontamination,
        op11_prefix_trie,
        op12_warc_zstd,
        op13_vector_codes,
    )
}
