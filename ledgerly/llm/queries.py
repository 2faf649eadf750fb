"""Registered queries of the training-data operators and their DuckDB oracles.

Each query applies one operator, with production parameters, to the whole of
its table and derives the columns its result is compared by.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.llm import (bpe_trie, conversations, decontamination, licenses, pages, quality_model,
                          quality_rules, secret_scan, sharding, simhash, substring_dedup,
                          token_counts, vector_codes)
from ledgerly.llm import oracle
from ledgerly.llm.common import documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def hex_sha256(text):
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = docs.withColumn("text_crc32", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    return sharding.shard_documents(marked, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.count_tokens(docs, VOCABULARY).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe_trie.encode_documents(docs, VOCABULARY, decoded="decoded_text").select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        hex_sha256("decoded_text").alias("decoded_sha256"))


def op4_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secret_scan.scan_documents(docs, rule_versions=secret_scan.RULE_VERSIONS)
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE_RULES]))

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        hex_sha256(line(base)).alias("base_sha256"), line("spans").alias("spans"))


def op5_ngram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontamination.find_contamination(docs, documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        hex_sha256(F.array_join("item_ids", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def held_out(doc_id="doc_id"):
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = documents(spark, sf_dir, "labels").where(~held_out()).select(
        "doc_id", F.col("quality").alias("label"))
    return quality_model.score_quality(docs, labels).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", hex_sha256("kept_text").alias("kept_sha256"))


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    stats = quality_rules.stored_statistics(docs)
    return quality_rules.judge(stats, quality_rules.fit_label_model(stats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality_probability")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return licenses.scan_licenses(docs).select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("categories", ",").alias("categories"))


def op10_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repair_conversations(conversations.damaged(rows)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")


def op12_page_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.extract_main_text(rows).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_equal_average_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return vector_codes.compress_vectors(rows).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


_ALL = (op1_histogram_sort, op2_heap_token_counts, op3_trie_bpe, op4_blob_ledger,
        op5_ngram_decontamination, op6_rule_ensemble, op7_count_min_substrings,
        op8_weak_supervision, op9_license_scan, op10_simhash_bk_trees, op11_conversation_repair,
        op12_page_wrappers, op13_equal_average_codes)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return oracle.oracles()
