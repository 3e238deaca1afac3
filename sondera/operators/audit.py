"""Coverage audit and status histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def uncovered(records: DataFrame, questions: DataFrame) -> DataFrame:
    """record_id of records without a question."""
    return records.select("record_id").distinct().join(questions.select("record_id").distinct(), "record_id", "left_anti")


def coverage(records: DataFrame, questions: DataFrame) -> DataFrame:
    """One row: totals, the share of covered ids over records (ids of unknown records count, so it can exceed 1), and those unknown ids."""
    total = records.agg(F.count_distinct("record_id").alias("total_records"))
    seen = questions.agg(
        F.count(F.lit(1)).alias("total_questions"), F.count_if(F.col("extract_pass") == "first").alias("first_pass"),
        F.count_if(F.col("extract_pass") == "coverage").alias("coverage_pass"), F.count_distinct("record_id").alias("covered"),
    )
    ids = questions.select("record_id").distinct()
    orphans = ids.join(records.select("record_id").distinct(), "record_id", "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
    missing = uncovered(records, questions).agg(F.count(F.lit(1)).alias("failures"))
    one = lambda d: d.withColumn("_one", F.lit(1))
    met = one(total).join(one(seen), "_one").join(one(orphans), "_one").join(one(missing), "_one").drop("_one")
    rate = F.when(F.col("total_records") > 0, F.col("covered") / F.col("total_records")).otherwise(0.0)
    return met.withColumn("coverage_rate", rate)


def full(records: DataFrame, chunks: DataFrame, questions: DataFrame, canonical: DataFrame) -> DataFrame:
    """coverage with the numbers of chunks and canonical questions."""
    count = lambda d, name: d.agg(F.count(F.lit(1)).alias(name)).withColumn("_one", F.lit(1))
    met = coverage(records, questions).withColumn("_one", F.lit(1))
    return met.join(count(chunks, "total_chunks"), "_one").join(count(canonical, "canonical_questions"), "_one").drop("_one")


def uncovered_head(missing: DataFrame, most: int = 10) -> DataFrame:
    """The first ids without a question, and how many others there are (null without others)."""
    first = missing.orderBy("record_id").limit(most).select(F.col("record_id").cast("string").alias("record_id"), F.lit(None).cast("long").alias("others"))
    rest = missing.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select(F.lit(None).cast("string").alias("record_id"), (F.col("n") - most).alias("others"))
    return first.unionByName(rest)


def ingest_stats(records: DataFrame, files: int | None = None) -> DataFrame:
    """Records by source type and by company (null: unknown), and in all."""
    kinds = F.array(F.struct(F.lit("type").alias("by"), F.col("source_type").alias("value")), F.struct(F.lit("company").alias("by"), F.coalesce("company_raw", F.lit("未知")).alias("value")), F.struct(F.lit("records").alias("by"), F.lit("").alias("value")))
    out = records.select(F.inline(kinds)).groupBy("by", "value").agg(F.count(F.lit(1)).alias("n"))
    if files is None:
        return out
    return out.unionByName(records.sparkSession.createDataFrame([("files", "", files)], "by string, value string, n long"))


def extract_stats(chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """One row: chunks, and questions of the first pass, of the coverage pass and in all."""
    one = questions.agg(
        F.count_if(F.col("extract_pass") == "first").alias("first_pass_count"), F.count_if(F.col("extract_pass") == "coverage").alias("coverage_pass_count"), F.count(F.lit(1)).alias("total_questions"),
    ).withColumn("_one", F.lit(1))
    return one.join(chunks.agg(F.count(F.lit(1)).alias("total_chunks")).withColumn("_one", F.lit(1)), "_one").drop("_one")


def dedupe_stats(questions: DataFrame, verdicts: DataFrame, canonical: DataFrame) -> DataFrame:
    """One row: questions, pairs by path, canonical questions and those under review."""
    pairs = verdicts.agg(F.count(F.lit(1)).alias("candidate_pairs"), F.count_if(F.col("source").isin("exact", "normalized")).alias("fast_path_pairs"), F.count_if(~F.col("source").isin("exact", "normalized")).alias("judged_pairs"))
    made = canonical.agg(F.count_if(~F.col("in_review")).alias("canonical_count"), F.count_if(F.col("in_review")).alias("review_count"))
    one = lambda d: d.withColumn("_one", F.lit(1))
    return one(questions.agg(F.count(F.lit(1)).alias("total_questions"))).join(one(pairs), "_one").join(one(made), "_one").drop("_one")


def histogram(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(F.coalesce(status, F.lit("ok")).alias("status")).agg(F.count(F.lit(1)).alias("n"))
