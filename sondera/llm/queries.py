"""The registered queries of this subpackage: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondera.llm import bpe, mtree, near_dedup, packing, pii, quality_model, quality_rules, secret_scan, suffix_tree, warc
from sondera.llm.common import table


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.train_and_score(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules(table(spark, sf_dir, "documents"))


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    digest = F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, range(len(pii.KINDS))), digest, pii.listed(F.col("spans")).alias("spans"))


def op6_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.clusters(table(spark, sf_dir, "documents"))


def op7_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    digest = F.sha2(secret_scan.listed(F.col("_base")), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, secret_scan.KINDS), digest, secret_scan.listed(F.col("_all")).alias("spans"))


def op8_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


def queries() -> dict:
    named = [
        op1_suffix_tree, op2_quality_rules, op3_sum_of_squares_packing, op4_byte_bpe, op5_pii_bootstrap,
        op6_minhash_bayes, op7_secret_markov, op8_fourier_quality, op9_mtree_search, op10_warc_chain, pipeline,
    ]
    return {f.__name__: f for f in named}
