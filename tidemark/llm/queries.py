"""The registered query of each operator, over its whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    conversation_repair,
    decontaminate,
    language_id,
    lm_scoring,
    packing,
    periodic_runs,
    quality,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_counts,
    topk_search,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_table(spark, sf_dir, "documents"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.topk_search(_table(spark, sf_dir, "embeddings"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_classifier(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(_table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(_table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scoring(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing(_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(_table(spark, sf_dir, "conversations"))


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_topk_search": op2_topk_search,
    "op3_url_filter": op3_url_filter,
    "op4_token_counts": op4_token_counts,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_decontaminate": op9_decontaminate,
    "op10_packing": op10_packing,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op2_topk_search": topk_search.ORACLE_SQL,
    "op3_url_filter": url_filter.ORACLE_SQL,
    "op9_decontaminate": decontaminate.ORACLE_SQL,
}
