"""The corpus pipeline: documents -> clean, distinct, encoded training texts.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and
works on all that its predecessor kept; ``run`` writes every stage's rows as
Parquet to the shared scratch folder and reads them back as the next one's
documents, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.llm import bpe_trie, decontamination, quality_rules, secret_scan, simhash
from ledgerly.llm.common import documents, stored
from ledgerly.llm.queries import VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules reject go."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs, shingle_words=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontamination.remove_contamination(docs, documents(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; ``n_chars`` follows the text."""
    return secret_scan.mask_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the check that they decode to it."""
    decoded = bpe_trie.encode_documents(docs, VOCABULARY, decoded="decoded_text")
    return decoded.withColumn("round_trip", F.col("decoded_text") == F.coalesce("text", F.lit(""))
                              ).drop("decoded_text")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("bpe_encoding", encode),
]

#: Fitted weights, XXH64 and byte-pair merges have no SQL form; the pipeline is
#: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
