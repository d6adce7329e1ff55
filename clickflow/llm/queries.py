"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickflow.llm import (bpe, chat, context_tree, decontaminate, filter_audit, license_scan, merkle,
                           quality_rules, simhash, suffix_dedup, toxicity, url_filter, weak_quality)
from clickflow.llm.common import table
from clickflow.llm.oracle import oracle_sql


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose texts hold control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql("""SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    return chat.digest(turns.unionByName(planted))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op8_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.scored(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scored(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_weak_quality": op8_weak_quality,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_context_tree_lm": op12_context_tree_lm,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = oracle_sql()
