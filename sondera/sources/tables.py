"""Tables: driver tables, staged tables, JSON lines with explicit schemas."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = (
    "struct<parser:string,original_title:string,question_index:int,difficulty:string,tags:array<string>,file_type:string,"
    "row_index:bigint,round:string,result:string,columns:array<string>,section:string,frequency:string>"
)
SCHEMAS = {
    "records": "record_id string, source_type string, source_path string, source_url string, source_title string, company_raw string, company_norm string, role_raw string, role_norm string, interview_date_raw string, interview_date_norm timestamp_ntz, candidate_level_raw string, location_raw string, text_raw string, text_clean string, ingest_meta " + META,
    "chunks": "chunk_id string, record_id string, chunk_index int, char_start int, char_end int, chunk_text string",
    "questions": "atomic_question_id string, record_id string, chunk_id string, question_text_raw string, question_text_norm string, question_type string, round_hint string, topic_hint array<string>, evidence_text string, char_start int, char_end int, extract_pass string, llm_model string, prompt_version string, confidence_extract double",
    "pairs": "pair_id string, qid_a string, qid_b string, candidate_source string, llm_is_duplicate boolean, llm_confidence double, llm_reason string, canonical_question_candidate string, knowledge_tags array<string>, review_flag boolean",
    "canonical": "canonical_question_id string, canonical_question_text string, member_count int, member_ids array<string>, company_count int, companies array<string>, variants array<string>, source_refs array<string>, primary_tag string, secondary_tags array<string>, avg_confidence double, merge_confidence_stats map<string,double>",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMAS[name]))


def read_lines(spark: SparkSession, path: str, name: str, missing_ok: bool = False) -> DataFrame:
    """JSON lines of a stage, with its schema; a malformed row fails the read. An absent file can stand for no rows."""
    if missing_ok:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return empty(spark, name)
    return spark.read.schema(SCHEMAS[name]).option("mode", "FAILFAST").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def derived_id(*parts) -> Column:
    """A stable id from its parts, in place of random ones."""
    return F.sha2(F.concat_ws("\u0001", *parts), 256).substr(1, 32)


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back, which ends the lineage."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sondera-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/sondera/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
