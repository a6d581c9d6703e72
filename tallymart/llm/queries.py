"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import (
    bpe,
    chat,
    decontaminate,
    embed_dedup,
    langid,
    licenses,
    merkle,
    minhash,
    mixing,
    periodic,
    quality,
    sharding,
    topk,
)
from tallymart.llm.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(read_table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(read_table(spark, sf_dir, "documents")))


def op6_shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents").select("doc_id"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.with_control_case(read_table(spark, sf_dir, "conversations")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op10_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_exact_top_k": op2_exact_top_k,
        "op3_language_id": op3_language_id,
        "op4_bpe_round_trip": op4_bpe_round_trip,
        "op5_source_mixing": op5_source_mixing,
        "op6_shard_assignment": op6_shard_assignment,
        "op7_chat_formatting": op7_chat_formatting,
        "op8_license_scan": op8_license_scan,
        "op9_embedding_near_duplicates": op9_embedding_near_duplicates,
        "op10_minhash_near_duplicates": op10_minhash_near_duplicates,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_benchmark_decontamination": op13_benchmark_decontamination,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op2_exact_top_k": topk.ORACLE,
        "op6_shard_assignment": sharding.ORACLE,
        "op7_chat_formatting": chat.ORACLE,
        "op9_embedding_near_duplicates": embed_dedup.ORACLE,
        "op10_minhash_near_duplicates": minhash.ORACLE,
        "op12_merkle_manifest": merkle.ORACLE,
        "op13_benchmark_decontamination": decontaminate.ORACLE,
    }
