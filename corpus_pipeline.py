"""The corpus pipeline: documents in, token ids out, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; ``run`` writes each
stage's rows to the shared folder and reads them back as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import bpe, decontaminate, quality_rules, simhash, suffix_dedup
from clickflow.llm.common import python_path, table, written

#: A repeated passage: some fifty short words.
PASSAGE_BYTES = 240


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filtered(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest doc_id."""
    return simhash.deduplicated(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings of PASSAGE_BYTES; n_chars follows the text."""
    return suffix_dedup.deduplicated(docs, PASSAGE_BYTES).withColumn("n_chars", F.length("text").cast("bigint"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their hash and that of the bytes they decode to."""
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids_col="ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", repeat_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("byte_bpe", token_stage),
]

#: SQL can express neither the fingerprints' hash nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_path(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
