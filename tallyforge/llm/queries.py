"""The registered queries of this subpackage: each applies one operator to the whole ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import byte_bpe, class_lm, license_scan, minhash, packing, phrases, positional_index, pu_classifier, quality_ledger, secret_scan, shards, stream_dedup, token_alignment
from tallyforge.llm.common import documents
from tallyforge.llm.oracle import oracle_sql  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return byte_bpe.round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.scored(documents(spark, sf_dir))


def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.groups(documents(spark, sf_dir))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(documents(spark, sf_dir), words_each=2)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


POLICY = "prose-2"


def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_ledger.ledger(documents(spark, sf_dir))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_ledger.passes("base-1")).alias("base_failed"), quality_ledger.passes(POLICY).alias("kept"),
        "failed", F.lit(POLICY).alias("policy"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_pu_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_classifier.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top(documents(spark, sf_dir))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slack=2)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        "contaminated", "n_near")


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in (
        op1_byte_bpe, op2_license_scan, op3_class_lm, op4_stream_dedup, op5_shards, op6_minhash, op7_secret_scan, op8_quality_ledger, op9_packing, op10_pu_classifier,
        op11_phrases, op12_token_alignment, op13_decontamination)}
