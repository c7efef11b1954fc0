"""The corpus pipeline: quality rules, exact and near deduplication, secret redaction, packing.

Every stage reads what its predecessor kept and returns the columns of ``documents``, but for the last one, which returns
the pieces of packed sequences. ``run`` writes each stage's result and hands the reread table to the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import minhash, packing, quality_ledger, secret_scan, stream_dedup
from tallyforge.llm.common import documents, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the policy ``prose-2``; the others go."""
    return quality_ledger.kept_rows(docs, "prose-2")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (white space apart): the longest, then the smallest id."""
    return stream_dedup.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8 or more: the smallest id."""
    return minhash.kept_rows(docs, words_each=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` counted anew where one was found."""
    return secret_scan.redacted(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids with their place in sequences of 2048."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("redact_secrets", redact_secrets),
    ("pack_windows", pack_windows),
]

#: Near deduplication and packing have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
