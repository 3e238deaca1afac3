"""The corpus pipeline: quality rules, quality classifier, near-duplicates, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sondera.llm import near_dedup, packing, quality_model, quality_rules, secret_scan
from sondera.llm.common import new_path, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs).select(*COLUMNS)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


#: Similarity in percent from which the near_dedup stage drops copies.
NEAR_PERCENT = 80


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep(docs, NEAR_PERCENT).select(*COLUMNS)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.mask(docs).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secret_scan_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each result is written and read again as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
