"""The registered queries of the question-bank operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondera.functions import chunk, similarity, text
from sondera.functions.json_repair import recovered
from sondera.operators import audit, dedupe, notes, providers, reports, rollup
from sondera.operators.graph import components
from sondera.plans import bank, literals
from sondera.sources.tables import staged, table

Q = DataFrame


def _rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def flagship_frequency(spark: SparkSession, sf_dir: str) -> Q:
    g = bank.groups(spark, sf_dir).select("label", "text", "member_count", F.size("companies").cast("long").alias("source_count"), text.tier("member_count").cast("long").alias("tier"))
    return rollup.overview(g)


def normalize_text(spark: SparkSession, sf_dir: str) -> Q:
    own = _rows(spark, literals.TEXTS, "qid long, raw string")
    return bank.lines(spark, sf_dir).select("qid", "raw").unionByName(own).select("qid", text.normalize("raw").alias("norm"))


def compare_key(spark: SparkSession, sf_dir: str) -> Q:
    return bank.lines(spark, sf_dir).select("qid", text.compare_key("raw").alias("key"), text.exact_key("raw").alias("exact"))


def clean_html(spark: SparkSession, sf_dir: str) -> Q:
    return table(spark, sf_dir, "pages").select("page_id", text.clean_text("html").alias("clean"))


def csv_text_split(spark: SparkSession, sf_dir: str) -> Q:
    return _rows(spark, literals.CELLS, "id long, cell string").select("id", text.clean_csv_text("cell").alias("listed"))


def detect_format(spark: SparkSession, sf_dir: str) -> Q:
    own = _rows(spark, literals.FILES, "id long, path string, content string").select("id", "content")
    pages = table(spark, sf_dir, "pages").select((1000 + F.col("page_id")).alias("id"), F.col("html").alias("content"))
    return own.unionByName(pages).select("id", notes.detect_format(F.col("content")).alias("format"))


def dispatch_parser(spark: SparkSession, sf_dir: str) -> Q:
    files = _rows(spark, literals.FILES, "id long, path string, content string")
    return files.select("id", notes.parser_of(F.col("path"), F.col("content")).alias("parser"))


def company_from_dir(spark: SparkSession, sf_dir: str) -> Q:
    files = _rows(spark, literals.DIRECTORIES, "id long, dir_name string")
    return notes.with_directory_company(files, _rows(spark, literals.DIRECTORY_MAP, "dir_key string, company string")).select("id", "company_hint")


def alias_join(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("company_raw"))
    return notes.with_company_norm(docs, _rows(spark, literals.ALIASES, "company_raw string, canonical string")).select("doc_id", "company_raw", "company_norm")


def company_from_content(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(_rows(spark, literals.COMPANY_TEXTS, "doc_id long, text string"))
    return docs.select("doc_id", notes.company_of_content(F.col("text")).alias("company"))


def parse_notes(spark: SparkSession, sf_dir: str) -> Q:
    files = _rows(spark, literals.FILES, "id long, path string, content string").withColumn("company_hint", F.lit(None).cast("string"))
    return notes.parse_notes(files).select("path", "parser", "source_title", "company_raw", "text_clean", F.col("ordinal").cast("long").alias("ordinal"))


def header_synonyms(spark: SparkSession, sf_dir: str) -> Q:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("公司"), F.col("o_orderstatus").alias("company"), F.col("o_custkey").alias("问题"))
    return notes.bind_headers(orders).select("o_orderkey", F.col("_company").alias("company"), F.col("_questions").alias("questions"), F.col("_role").alias("role"))


def sentence_split(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(text.sentences("text")).alias("pos", "sentence")).select("doc_id", F.col("pos").cast("long").alias("pos"), "sentence")


def paragraph_split(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("t"))
    return docs.select("doc_id", F.posexplode(text.paragraphs("t")).alias("pos", "paragraph")).select("doc_id", F.col("pos").cast("long").alias("pos"), "paragraph")


def chunk_fold(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return chunk.chunks(docs)


def chunk_stats(spark: SparkSession, sf_dir: str) -> Q:
    c = chunk_fold(spark, sf_dir)
    return c.agg(F.count_distinct("record_id").alias("records"), F.count(F.lit(1)).alias("chunks"), F.max("chunk_index").cast("long").alias("last_index"))


def rule_extract(spark: SparkSession, sf_dir: str) -> Q:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    kind = F.when(F.col("turn") == 0, "main").otherwise("followup")
    asked = rows.withColumn("q", text.strip("line")).filter("q != ''").withColumn("is_question", providers.looks_like_question(F.col("line")))
    return asked.select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), kind.alias("question_type"), "is_question")


def provider_extract(spark: SparkSession, sf_dir: str) -> Q:
    rows = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), "text")
    found = providers.run_provider(rows, "chunk_id", "text", lambda: providers.Resilient(providers.RuleExtractor()))
    return found.select("chunk_id", F.size("values").cast("long").alias("questions"), "model", "status")


def status_histogram(spark: SparkSession, sf_dir: str) -> Q:
    return audit.histogram(provider_extract(spark, sf_dir), "status")


def keep_first_dedupe(spark: SparkSession, sf_dir: str) -> Q:
    return dedupe.keep_first(bank.lines(spark, sf_dir), ["record_id"], "raw", "qid").select("qid", "raw")


def exact_pairs(spark: SparkSession, sf_dir: str) -> Q:
    return dedupe.exact_pairs(bank.lines(spark, sf_dir).select("qid", "raw"))


def normalized_pairs(spark: SparkSession, sf_dir: str) -> Q:
    return dedupe.normalized_pairs(bank.lines(spark, sf_dir).select("qid", "raw", "norm"))


def exact_pair_count(spark: SparkSession, sf_dir: str) -> Q:
    return dedupe.equal_pair_count(bank.lines(spark, sf_dir), text.exact_key("raw"))


def fuzzy_pairs(spark: SparkSession, sf_dir: str) -> Q:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("raw"), F.lit("").alias("norm"))
    names = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100_000).cast("long").alias("qid"), F.col("n_name").alias("raw"), F.lit("").alias("norm"))
    own = _rows(spark, literals.NEAR_TEXTS, "qid long, raw string, norm string")
    return dedupe.fuzzy_pairs(items.unionByName(names).unionByName(own)).select("a", "b", F.round("score", 6).alias("score"))


def tf_cosine_pairs(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return similarity.term_cosine_pairs(docs, 0.95, digits=6).select("a", "b", "cosine")


def _vectors(spark: SparkSession, sf_dir: str) -> Q:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def vector_topk(spark: SparkSession, sf_dir: str) -> Q:
    return dedupe.embedding_pairs(_vectors(spark, sf_dir), 8, 0.30).select("a", "b", F.round("score", 6).alias("score"))


def candidate_layers(spark: SparkSession, sf_dir: str) -> Q:
    q = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), F.concat(F.lit("question "), (F.col("vec_id") % 97).cast("string")).alias("raw"), F.lit("").alias("norm"))
    none = spark.createDataFrame([], "a long, b long")  # the fuzzy layer, which has a query of its own
    return dedupe.layered(dedupe.exact_pairs(q), dedupe.normalized_pairs(q), none, vector_topk(spark, sf_dir))


def fast_path_verdicts(spark: SparkSession, sf_dir: str) -> Q:
    return dedupe.fast_path(bank.lines(spark, sf_dir).select("qid", "raw", "norm")).drop("duplicate")


def _judged(spark: SparkSession, sf_dir: str) -> Q:
    pairs = dedupe.embedding_pairs(_vectors(spark, sf_dir), 8, 0.30)
    verdicts = dedupe.score_verdicts(pairs, 0.40, 0.38)
    return staged(verdicts.withColumn("source", F.lit("embedding")).withColumn("hint", F.lit(None).cast("string")), "verdicts")


def review_band(spark: SparkSession, sf_dir: str) -> Q:
    return _judged(spark, sf_dir).select("a", "b", F.round("confidence", 6).alias("confidence"), "duplicate", "review")


def vector_components(spark: SparkSession, sf_dir: str) -> Q:
    edges = _judged(spark, sf_dir).filter(dedupe.merges(0.40)).select("a", "b")
    return components(_vectors(spark, sf_dir).select("id"), edges)


def line_components(spark: SparkSession, sf_dir: str) -> Q:
    q = bank.lines(spark, sf_dir)
    q = staged(q.select("qid", F.xxhash64(text.exact_key("raw")).alias("x"), F.xxhash64(dedupe.comparison(q)).alias("n")), "keys")
    edges = dedupe.equal_stars(q, F.col("x")).unionByName(dedupe.equal_stars(q, F.col("n")))
    return components(q.select(F.col("qid").alias("id")), edges)


def _canonical(spark: SparkSession, sf_dir: str) -> Q:
    q = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("qid"), F.concat(F.lit("question "), (F.col("vec_id") % 97).cast("string")).alias("raw"),
        F.concat(F.lit("r"), (F.col("vec_id") % 7).cast("string")).alias("record_id"), F.concat(F.lit("round "), F.col("label").cast("string")).alias("hint"),
    )
    verdicts = _judged(spark, sf_dir)
    c = dedupe.canonical_questions(q, verdicts, dedupe.cluster_labels(q, verdicts, 0.40), 0.40)
    arrays = {n: F.array_join(F.transform(n, lambda x: x.cast("string")), ",") for n in ("member_ids", "round_hints", "variants", "source_refs")}
    return c.withColumns(arrays)


def canonical(spark: SparkSession, sf_dir: str) -> Q:
    return _canonical(spark, sf_dir).filter("not in_review").drop("in_review")


def review_queue(spark: SparkSession, sf_dir: str) -> Q:
    return _canonical(spark, sf_dir).filter("in_review").drop("in_review")


def keyword_classify(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents")
    found = providers.classify_keywords(docs, bank.topic_keywords(spark), "doc_id", "text")
    return found.select("doc_id", "primary_tag", F.array_join("secondary_tags", ",").alias("secondary_tags"))


def tag_stats(spark: SparkSession, sf_dir: str) -> Q:
    return keyword_classify(spark, sf_dir).groupBy("primary_tag").agg(F.count(F.lit(1)).alias("n"))


def company_rollup(spark: SparkSession, sf_dir: str) -> Q:
    return rollup.company_totals(rollup.by_company(bank.groups(spark, sf_dir)))


def company_tag_rank(spark: SparkSession, sf_dir: str) -> Q:
    rows = rollup.ranked(rollup.with_tag(rollup.by_company(bank.tagged(spark, sf_dir))), ["company", "tag"])
    return rows.select("company", "tag", F.col("rank").cast("long").alias("rank"), "label", "member_count")


def company_sheet(spark: SparkSession, sf_dir: str) -> Q:
    rows = rollup.company_sheet(rollup.by_company(bank.tagged(spark, sf_dir)))
    return rows.toDF("company", "question", "tier", "topic", "secondary", "count", "variants")


def knowledge_rollup(spark: SparkSession, sf_dir: str) -> Q:
    return rollup.category_totals(rollup.with_category(bank.tagged(spark, sf_dir), bank.topic_names(spark))).select(F.coalesce("category", F.lit("ALL")).alias("category"), "questions", "high_frequency")


def knowledge_rank(spark: SparkSession, sf_dir: str) -> Q:
    rows = rollup.ranked(rollup.with_category(bank.tagged(spark, sf_dir), bank.topic_names(spark)), ["category"])
    return rows.select("category", F.col("rank").cast("long").alias("rank"), "label", "member_count", "company_count")


def knowledge_sheet(spark: SparkSession, sf_dir: str) -> Q:
    rows = rollup.with_category(bank.tagged(spark, sf_dir), bank.topic_names(spark))
    return rollup.knowledge_sheet(rows).toDF("category", "question", "tier", "count", "company_count", "companies", "variants", "secondary")


def company_report(spark: SparkSession, sf_dir: str) -> Q:
    return reports.company_report(rollup.by_company(bank.tagged(spark, sf_dir)))


def _categories(spark: SparkSession, sf_dir: str) -> Q:
    return rollup.with_category(bank.tagged(spark, sf_dir), bank.topic_names(spark))


def knowledge_report(spark: SparkSession, sf_dir: str) -> Q:
    return reports.knowledge_report(staged(_categories(spark, sf_dir), "categories"))


def category_order(spark: SparkSession, sf_dir: str) -> Q:
    return reports.category_order(_categories(spark, sf_dir))


def company_group_sheets(spark: SparkSession, sf_dir: str) -> Q:
    sheet = rollup.company_sheet(rollup.by_company(bank.tagged(spark, sf_dir)))
    return reports.group_sheets(sheet, "公司", rollup.by_company_and_tier()).toDF("company", "place", "sheet")


def knowledge_group_sheets(spark: SparkSession, sf_dir: str) -> Q:
    return reports.group_sheets(rollup.knowledge_sheet(_categories(spark, sf_dir)), "知识点", [*rollup.by_tier(), F.col("知识点")]).toDF("category", "place", "sheet")


def _errors(spark: SparkSession, sf_dir: str) -> Q:
    return audit.histogram(table(spark, sf_dir, "events"), "event_type")


def run_report(spark: SparkSession, sf_dir: str) -> Q:
    records, questions = _audited(spark, sf_dir)
    found = staged(audit.full(records, table(spark, sf_dir, "conversations"), questions, table(spark, sf_dir, "benchmark")), "audit")
    return reports.run_report(found, staged(audit.uncovered(records, questions), "uncovered"), _errors(spark, sf_dir))


def audit_full(spark: SparkSession, sf_dir: str) -> Q:
    records, questions = _audited(spark, sf_dir)
    return audit.full(records, table(spark, sf_dir, "conversations"), questions, table(spark, sf_dir, "benchmark")).withColumn("coverage_rate", F.round("coverage_rate", 6))


def uncovered_head(spark: SparkSession, sf_dir: str) -> Q:
    return audit.uncovered_head(uncovered_records(spark, sf_dir))


def ingest_stats(spark: SparkSession, sf_dir: str) -> Q:
    return audit.ingest_stats(table(spark, sf_dir, "documents").select(F.col("lang").alias("source_type"), F.col("source").alias("company_raw")))


def extract_stats(spark: SparkSession, sf_dir: str) -> Q:
    return audit.extract_stats(table(spark, sf_dir, "conversations"), _audited(spark, sf_dir)[1])


def dedupe_stats(spark: SparkSession, sf_dir: str) -> Q:
    return audit.dedupe_stats(table(spark, sf_dir, "embeddings"), _judged(spark, sf_dir), _canonical(spark, sf_dir))


def coverage_pass(spark: SparkSession, sf_dir: str) -> Q:
    rows = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.col("conv_id").alias("record_id"), F.col("text").alias("chunk_text"))
    cued = lambda *cues: lambda: providers.Resilient(providers.CueExtractor(cues))
    none = F.array().cast("array<string>")
    first = staged(providers.run_provider(rows.withColumn("known", none), "chunk_id", "chunk_text", cued(" the "), known="known"), "first")
    again = providers.coverage_input(rows, providers.atomic(first.join(rows, "chunk_id"), "first"))
    found = providers.run_provider(again, "chunk_id", "chunk_text", cued(" that ", " der "), splits=1, known="known")
    return found.select("chunk_id", F.size("values").cast("long").alias("questions"))


def merged_repairs(spark: SparkSession, sf_dir: str) -> Q:
    base = bank.lines(spark, sf_dir).select(F.col("record_id").alias("chunk_id"), F.col("qid").alias("pos"), F.col("raw").alias("question_text_raw"))
    again = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("chunk_id"), "turn", F.posexplode(F.split("text", "\n", -1)).alias("p", "question_text_raw"))
    return dedupe.merged_repairs(base, again.select("chunk_id", (F.col("turn") * 1_000_000 + F.col("p")).alias("pos"), "question_text_raw"))


def _files(spark: SparkSession) -> Q:
    return _rows(spark, literals.FILES, "id long, path string, content string")


def standard_body(spark: SparkSession, sf_dir: str) -> Q:
    return _files(spark).select("id", notes.standard_body(F.col("content")).alias("body"))


def bank_split(spark: SparkSession, sf_dir: str) -> Q:
    return _files(spark).select("id", F.posexplode(notes.bank_blocks(F.col("content"))).alias("n", "block")).select("id", F.col("n").cast("long").alias("n"), "block")


def deep_dive_split(spark: SparkSession, sf_dir: str) -> Q:
    found = notes.parse_deep_dive(_files(spark).withColumn("path", F.col("id").cast("string")))
    return found.select(F.col("path").cast("long").alias("id"), "section", F.col("source_title").alias("title"), "frequency")


def json_validate(spark: SparkSession, sf_dir: str) -> Q:
    rows = _rows(spark, literals.TYPED_ANSWERS, "id long, kind string, answer string")
    valid = F.coalesce(*[F.when(F.col("kind") == kind, providers.validated(F.col("answer"), kind).isNotNull()) for kind in providers.ANSWERS])
    return rows.select("id", valid.alias("valid"))


def _audited(spark: SparkSession, sf_dir: str) -> tuple[Q, Q]:
    records = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"))
    questions = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("record_id"), F.when(F.col("quality") == 1, "first").otherwise("coverage").alias("extract_pass"))
    return records, questions


def coverage_audit(spark: SparkSession, sf_dir: str) -> Q:
    return audit.coverage(*_audited(spark, sf_dir)).withColumn("coverage_rate", F.round("coverage_rate", 6))


def uncovered_records(spark: SparkSession, sf_dir: str) -> Q:
    return audit.uncovered(*_audited(spark, sf_dir))


def json_recover(spark: SparkSession, sf_dir: str) -> Q:
    e = table(spark, sf_dir, "events").select("event_id", recovered(F.col("props")).alias("props"))
    return e.select("event_id", "props")


def json_repair(spark: SparkSession, sf_dir: str) -> Q:
    return _rows(spark, literals.ANSWERS, "id long, answer string").select("id", recovered(F.col("answer")).alias("object"))


def excel_sanitize(spark: SparkSession, sf_dir: str) -> Q:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("\u0001"), F.col("text"), F.lit("\u001f")).alias("t"))
    return docs.select("doc_id", text.sheet_safe("t").alias("safe"))


def queries() -> dict:
    named = [
        flagship_frequency, normalize_text, compare_key, clean_html, csv_text_split, detect_format, dispatch_parser, company_from_dir, alias_join,
        company_from_content, parse_notes, header_synonyms, sentence_split, paragraph_split, chunk_fold, chunk_stats, rule_extract, provider_extract,
        status_histogram, keep_first_dedupe, exact_pairs, normalized_pairs, exact_pair_count, fuzzy_pairs, tf_cosine_pairs, vector_topk, candidate_layers,
        fast_path_verdicts, review_band, vector_components, line_components, canonical, review_queue, keyword_classify, tag_stats, company_rollup,
        company_tag_rank, company_sheet, knowledge_rollup, knowledge_rank, knowledge_sheet, company_report, coverage_audit, uncovered_records,
        json_recover, json_repair, excel_sanitize, knowledge_report, category_order, company_group_sheets, knowledge_group_sheets, run_report, audit_full,
        uncovered_head, ingest_stats, extract_stats, dedupe_stats, coverage_pass, merged_repairs, standard_body, bank_split, deep_dive_split, json_validate,
    ]
    return {f.__name__: f for f in named}
