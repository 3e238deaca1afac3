"""The staged question-bank pipeline and its command line.

Stages read and write JSON lines under one folder: records, chunks, atomic questions,
normalised questions, canonical questions with a review queue, classified questions,
reports, workbooks and an audit. Every stage is also a command of its own that reads
what the stage before it has written. Providers of models are given by Providers; without
one a stage uses its rule.
"""

from __future__ import annotations

import argparse
import json
import os
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondera.functions import text
from sondera.functions.chunk import OVERLAP, SIZE, chunks
from sondera.operators import audit, dedupe, notes, providers, reports, rollup
from sondera.sources import dimensions, files
from sondera.sources.tables import derived_id, staged

# Chunks and questions of a sample run, for each of its files and in all.
SAMPLE_FILES, SAMPLE_CHUNKS_PER_FILE, SAMPLE_QUESTIONS = 30, 2, 100


@dataclass
class Config:
    """Settings; environment variables of the same name with the prefix SONDERA_ override the defaults.

    The model settings are for providers that call a remote model; the engine itself
    passes them on and uses retries, delay and the breaker.
    """

    folder: str = "data"
    input: str = ""
    company_alias: str = ""
    taxonomy: str = ""
    terms: str = ""
    high: float = dedupe.HIGH
    low: float = dedupe.LOW
    top_k: int = dedupe.EMBEDDING_TOP_K
    threshold: float = dedupe.EMBEDDING_THRESHOLD
    fast_path: bool = True
    embedding: bool = True
    coverage: bool = True
    chunk_size: int = SIZE
    chunk_overlap: int = OVERLAP
    max_retries: int = providers.PARSE_ATTEMPTS
    retry_delay: float = 0.0
    request_timeout: int = 600
    extract_max_tokens: int = 2048
    coverage_max_tokens: int = 2048
    model_key: str = ""
    model_url: str = ""
    model_name: str = ""
    reasoner_name: str = ""
    fallback_enabled: bool = False
    fallback_key: str = ""
    fallback_url: str = ""
    fallback_name: str = ""
    fallback_reasoner_name: str = ""
    primary_refusals: int = providers.BREAKER_REFUSALS
    embedding_model: str = ""
    embedding_device: str = "cpu"

    @classmethod
    def from_environment(cls) -> Config:
        own = cls()
        for name, value in vars(own).items():
            if (given := os.environ.get(f"SONDERA_{name.upper()}")) is not None:
                setattr(own, name, given.lower() in ("1", "true", "yes") if isinstance(value, bool) else type(value)(given))
        return own

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.jsonl"

    def dimension(self, name: str) -> dict:
        return dimensions.load(getattr(self, name)) if getattr(self, name) else {}


@dataclass
class Providers:
    """Factories, called once per task: extraction, coverage (text and known questions), judge of two texts, classifier, embedder of a batch."""

    extract: Callable = providers.RuleExtractor
    coverage: Callable | None = providers.CueExtractor
    fallback: Callable | None = None
    judge: Callable | None = None
    classify: Callable | None = None
    embed: Callable | None = None

    def resilient(self, make: Callable, config: Config) -> Callable:
        other = self.fallback if config.fallback_enabled else None
        return lambda: providers.Resilient(make(), other() if other else None, config.max_retries, config.primary_refusals, config.retry_delay)


def ingest(spark: SparkSession, config: Config, source: str, limit: int | None = None) -> DataFrame:
    """Records of all eligible files: parsers by format, company by directory, alias join."""
    names = config.dimension("company_alias")
    found = staged(files.scan(spark, source, limit), "files")
    md = files.notes(found)
    md = notes.with_directory_company(md, dimensions.directories(spark, names))
    records = notes.parse_notes(md)
    for suffixes, parser, synonyms in ((["csv"], "csv", notes.SYNONYMS), (["xlsx", "xls"], "excel", notes.EXCEL_SYNONYMS)):
        rows = files.table_rows(found.filter(F.col("suffix").isin(suffixes)), synonyms)
        records = records.unionByName(notes.parse_table(rows, parser, synonyms), allowMissingColumns=True)
    records = notes.with_company_norm(records, dimensions.aliases(spark, names))
    kind = F.when(F.col("parser").isin("csv", "excel"), F.col("parser")).otherwise("markdown")
    records = records.withColumn("source_type", kind).withColumn("record_id", derived_id("path", F.col("ordinal").cast("string")))
    return records.withColumnRenamed("path", "source_path")


def chunk(records: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    body = F.coalesce(F.when(F.col("text_clean") != "", F.col("text_clean")), F.col("text_raw"))
    out = chunks(records.select("record_id", body.alias("text")), size, overlap)
    return out.withColumn("chunk_id", derived_id("record_id", F.col("chunk_index").cast("string")))


def extract(cut: DataFrame, coverage=None, make=lambda: providers.Resilient(providers.RuleExtractor())) -> DataFrame:
    """First pass, and a second one by ``coverage`` (a factory like ``make``) over chunks where the first found something."""
    own = cut.select("chunk_id", "record_id", "chunk_text")
    first = staged(providers.run_provider(cut, "chunk_id", "chunk_text", make), "extracted")
    out = providers.atomic(first.join(own, "chunk_id"), "first")
    if coverage is not None:
        again = providers.coverage_input(cut, out)
        second = providers.run_provider(again, "chunk_id", "chunk_text", coverage, splits=1, known="known")
        out = out.unionByName(providers.atomic(second.join(own, "chunk_id"), "coverage"))
    return out.withColumn("atomic_question_id", derived_id("chunk_id", "extract_pass", F.col("pos").cast("string")))


def normalize(questions: DataFrame, terms: list[tuple[str, str]] | None = None) -> DataFrame:
    return questions.withColumn("question_text_norm", text.normalize("question_text_raw", terms))


def question_rows(questions: DataFrame) -> DataFrame:
    """qid (a long that orders questions by id), record_id, raw, norm and hint."""
    hint = F.col("round_hint") if "round_hint" in questions.columns else F.lit(None).cast("string")
    return questions.select(F.xxhash64("atomic_question_id").alias("qid"), "record_id", F.col("question_text_raw").alias("raw"), F.col("question_text_norm").alias("norm"), hint.alias("hint"))


def verdicts_of(q: DataFrame, config: Config, judge: Callable | None = None, embed: Callable | None = None) -> DataFrame:
    """Verdicts on all candidate pairs of staged questions: equal keys by rule, the others by the judge or their score.

    Equal-key layers contribute star links. Without an embedder the last layer compares
    term-frequency vectors.
    """
    best = F.coalesce(F.when(F.col("norm") != "", F.col("norm")), F.col("raw"))
    pairs = dedupe.layered(dedupe.equal_stars(q, text.exact_key("raw")), dedupe.equal_stars(q, dedupe.comparison(q)))
    scored = dedupe.fuzzy_pairs(q).withColumn("score", F.col("score") / 100).withColumn("source", F.lit("fuzzy"))
    if config.embedding:
        texts = q.select("qid", best.alias("text"))
        if embed is None:
            near = dedupe.term_pairs(texts.withColumnRenamed("qid", "id"), config.top_k, config.threshold)
        else:
            near = dedupe.embedding_pairs(staged(providers.embedded(texts, embed, "qid", "text"), "vectors"), config.top_k, config.threshold)
        scored = scored.unionByName(near.withColumn("source", F.lit("embedding")))
    first = F.min_by(F.struct("score", "source"), F.when(F.col("source") == "fuzzy", 0).otherwise(1))
    scored = scored.groupBy("a", "b").agg(first.alias("x")).select("a", "b", "x.*")
    fast = dedupe.fast_verdicts(pairs, q)
    scored = scored.join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    if not config.fast_path and judge is not None:
        scored, fast = scored.unionByName(pairs.select("a", "b", F.lit(None).cast("double").alias("score"), "source")), fast.limit(0)
    if judge is None:
        judged = dedupe.score_verdicts(scored, config.high, config.low).withColumn("hint", F.lit(None).cast("string"))
    else:
        sides = q.select("qid", best.alias("t"))
        asked = scored.join(sides.toDF("a", "text_a"), "a").join(sides.toDF("b", "text_b"), "b")
        judged = providers.judge_pairs(asked, judge)
        judged = judged.withColumn("review", dedupe.review_needed(F.col("duplicate"), F.col("confidence"), config.high, config.low))
    return staged(fast.unionByName(judged.select(fast.columns)), "verdicts")


def deduplicate(questions: DataFrame, config: Config, judge: Callable | None = None, embed: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """Canonical questions with in_review, and the verdicts."""
    q = staged(question_rows(questions), "questions")
    verdicts = verdicts_of(q, config, judge, embed)
    return dedupe.canonical_questions(q, verdicts, dedupe.cluster_labels(q, verdicts, config.high), config.high), verdicts


def classify(canonical: DataFrame, spark: SparkSession, config: Config, make: Callable | None = None) -> DataFrame:
    if make is not None:
        return canonical.join(providers.classify_with(canonical, make, "label", "text"), "label")
    words = dimensions.taxonomy(spark, config.dimension("taxonomy")).select("category", "keyword").unionByName(dimensions.shortcuts(spark, config.dimension("taxonomy")).select("category", "keyword"))
    return canonical.join(providers.classify_keywords(canonical, words, "label", "text"), "label")


def workbook(spark: SparkSession, sheet: DataFrame, group: str, order: list, path: str) -> None:
    """All rows, the frequent ones, and a sheet for each of the first groups. A workbook is one file, so its rows meet on the driver."""
    firsts = reports.group_sheets(sheet, group, order).orderBy("place").collect()  # MOST_SHEETS rows at most
    rows = sheet.toPandas()
    sheets = {"汇总": rows}
    if len(high := rows[rows["出现次数"] >= rollup.HIGH_FREQUENCY]):
        sheets["高频问题"] = high
    for r in firsts:
        name = text.sheet_name(r["sheet"], sheets)
        sheets[name] = rows[rows[group] == r[group]]
    files.write_workbook(sheets, own := os.path.join(tempfile.mkdtemp(), "book.xlsx"))
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(True, True, jvm.org.apache.hadoop.fs.Path(f"file://{own}"), target)


class Run:
    """The stages over one folder; each reads the files of the stage before and writes its own."""

    def __init__(self, spark: SparkSession, config: Config, models: Providers | None = None):
        self.spark, self.config, self.models = spark, config, models or Providers()
        self.began, self.id = datetime.now(), uuid.uuid4().hex

    def path(self, name: str) -> str:
        return self.config.path(name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").json(self.path(name))
        self.spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(self.path(name).removesuffix(".jsonl") + ".schema")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """A stage's lines with the schema it wrote."""
        from pyspark.sql.types import StructType

        schema = self.spark.read.text(self.path(name).removesuffix(".jsonl") + ".schema").first()[0]
        return self.spark.read.schema(StructType.fromJson(json.loads(schema))).option("mode", "FAILFAST").json(self.path(name))

    def ingest(self, source: str, limit: int | None = None) -> DataFrame:
        out = self.write(ingest(self.spark, self.config, source, limit), "interviews_raw")
        found = files.scan(self.spark, source, limit).select("path").count()
        audit.ingest_stats(out, found).write.mode("overwrite").json(self.path("ingest_stats"))
        return out

    def chunk(self) -> DataFrame:
        return self.write(chunk(self.read("interviews_raw"), self.config.chunk_size, self.config.chunk_overlap), "chunks")

    def extract(self, limit: int | None = None) -> DataFrame:
        cut = self.read("chunks")
        cut = cut.orderBy("record_id", "chunk_index").limit(limit) if limit else cut
        second = self.models.coverage if self.config.coverage else None
        again = self.models.resilient(second, self.config) if second else None
        out = self.write(extract(cut, again, self.models.resilient(self.models.extract, self.config)), "atomic_questions")
        audit.extract_stats(cut, out).write.mode("overwrite").json(self.path("extract_stats"))
        return out

    def normalize(self) -> DataFrame:
        return self.write(normalize(self.read("atomic_questions"), dimensions.terms(self.config.dimension("terms")) or None), "normalized_questions")

    def dedupe(self, limit: int | None = None) -> DataFrame:
        q = self.read("normalized_questions")
        q = q.orderBy("chunk_id", "extract_pass", "pos").limit(limit) if limit else q
        found, verdicts = deduplicate(q, self.config, self.models.judge, self.models.embed)
        both = staged(found, "canonical")
        audit.dedupe_stats(q, verdicts, both).write.mode("overwrite").json(self.path("dedupe_stats"))
        self.write(both.filter("in_review"), "review_queue")
        return self.write(both.filter("not in_review"), "canonical_questions")

    def classify(self) -> DataFrame:
        return self.write(classify(self.read("canonical_questions"), self.spark, self.config, self.models.classify), "classified_questions")

    def named(self) -> DataFrame:
        return staged(rollup.with_companies(self.read("classified_questions"), self.read("interviews_raw")), "classified")

    def aggregate(self, company_output: str = "", knowledge_output: str = "") -> DataFrame:
        named = self.named()
        company, topic = company_output or f"{self.config.folder}/company_summary", knowledge_output or f"{self.config.folder}/knowledge_summary"
        exploded = rollup.by_company(named)
        names = dimensions.taxonomy(self.spark, self.config.dimension("taxonomy")).select(F.col("category").alias("tag"), F.col("category_name").alias("name")).distinct()
        by_topic = rollup.with_category(named, names)
        reports.write_report(reports.company_report(exploded), f"{company}.md")
        reports.write_report(reports.knowledge_report(by_topic), f"{topic}.md")
        workbook(self.spark, rollup.company_sheet(exploded), "公司", rollup.by_company_and_tier(), f"{company}.xlsx")
        workbook(self.spark, rollup.knowledge_sheet(by_topic), "知识点", rollup.by_tier(), f"{topic}.xlsx")
        return named

    def audit(self) -> DataFrame:
        records, questions = self.read("interviews_raw"), self.read("atomic_questions")
        found = staged(audit.full(records, self.read("chunks"), questions, self.read("canonical_questions")), "audit")
        run = self.id, str(self.began), str(datetime.now())
        stamped = found.withColumns(dict(zip(("run_id", "started_at", "finished_at"), map(F.lit, run), strict=True)))
        stamped.write.mode("overwrite").json(f"{self.config.folder}/coverage_audit")
        missing = audit.uncovered(records, questions)
        missing.write.mode("overwrite").json(f"{self.config.folder}/uncovered_records")
        reports.write_report(reports.run_report(found, missing, reports.empty_errors(self.spark), run), f"{self.config.folder}/run_report.md")
        return found

    def all(self, source: str, files_limit: int | None = None, chunks_limit: int | None = None, questions_limit: int | None = None) -> dict[str, DataFrame]:
        out = {"records": self.ingest(source, files_limit), "chunks": self.chunk()}
        self.extract(chunks_limit)
        out["questions"] = self.normalize()
        out["canonical"] = self.dedupe(questions_limit)
        out["review"] = self.read("review_queue")
        self.classify()
        out["classified"] = self.aggregate()
        out["audit"] = self.audit()
        return out


def run_all(spark: SparkSession, config: Config, source: str, limit: int | None = None, models: Providers | None = None) -> dict[str, DataFrame]:
    """All stages; each is written to the folder and read back by the next."""
    return Run(spark, config, models).all(source, limit)


def run_sample(spark: SparkSession, config: Config, source: str, n: int = SAMPLE_FILES, models: Providers | None = None) -> dict[str, DataFrame]:
    """All stages over the first n files, at most 2n chunks and 100 questions."""
    return Run(spark, config, models).all(source, n, SAMPLE_CHUNKS_PER_FILE * n, SAMPLE_QUESTIONS)


COMMANDS = ["ingest", "chunk", "extract", "normalize", "dedupe", "classify", "aggregate", "audit", "run-sample", "run-all"]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sondera", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("-i", "--input", default="", help="folder of notes, for ingest and the runs")
    parser.add_argument("-o", "--output", default="", help="folder of all stages")
    parser.add_argument("-n", "--limit", type=int, default=0, help="files (ingest, runs), chunks (extract) or questions (dedupe)")
    parser.add_argument("--chunk-size", type=int)
    parser.add_argument("--overlap", type=int)
    parser.add_argument("--coverage", action=argparse.BooleanOptionalAction)
    parser.add_argument("--embedding", action=argparse.BooleanOptionalAction)
    parser.add_argument("--company-output", default="")
    parser.add_argument("--knowledge-output", default="")
    given = parser.parse_args(arguments)
    config = Config.from_environment()
    for name, value in (("folder", given.output), ("chunk_size", given.chunk_size), ("chunk_overlap", given.overlap), ("coverage", given.coverage), ("embedding", given.embedding)):
        if value not in (None, ""):
            setattr(config, name, value)
    source = given.input or config.input
    spark = SparkSession.builder.appName("sondera").getOrCreate()
    run, limit = Run(spark, config), given.limit or None
    if given.command in ("ingest", "run-all", "run-sample") and not source:
        parser.error("an input folder is needed")
    if given.command == "ingest":
        run.ingest(source, limit)
    elif given.command == "run-all":
        run.all(source, limit)
    elif given.command == "run-sample":
        run_sample(spark, config, source, limit or SAMPLE_FILES)
    elif given.command in ("extract", "dedupe"):
        getattr(run, given.command)(limit)
    elif given.command == "aggregate":
        run.aggregate(given.company_output, given.knowledge_output)
    else:
        getattr(run, given.command)()


if __name__ == "__main__":
    main()
