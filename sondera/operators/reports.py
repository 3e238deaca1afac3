"""Markdown reports and workbook sheets as ordered rows.

A report is a DataFrame of lines with order keys: section, o1, o2, o3, o4 and line_no.
write_report sorts by them and writes text, so a report of any size needs no driver memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sondera.functions.text import percent, tier_icon
from sondera.operators.rollup import HIGH_FREQUENCY, MOST_SHEETS, SHEET_NAME, TOP_OVERVIEW, UNCERTAIN, UNCERTAIN_LABEL, company_totals, ranked, with_tag

# The wording of the reports.
COMPANY_TITLE, COMPANY_COUNT = "# AI算法工程师面经汇总 - 按公司分类", "共收录 %d 家公司的面试问题"
TOTALS, TOPIC_TOTALS = "**问题总数**: %d (高频 %d 个)", "**题目数量**: %d (高频 %d 个)"
VARIANTS, TIMES, TIMES_HIGH = "**常见变体**:", "**出现次数**: %d", "**出现次数**: **%d** (高频)"
TOPIC_TITLE, TOPIC_ALL, TOPIC_AREAS, TOPIC_HIGH = "# AI算法工程师面经汇总 - 按知识点分类", "共收录 %d 个问题", "涵盖 %d 个知识点领域", "**高频问题（出现5次以上）: %d 个**"
OVERVIEW_HEAD, OVERVIEW_LINE, CONTENTS_HEAD, CONTENTS_LINE, CONTENTS_HIGH = "## 高频问题速览", "- %s **%s** (%d次 | %s)", "## 目录", "- [%s](#%s) (%d题%s)", " (%d高频)"
SEEN_AT, AND_MORE = "**出现公司**: %s", "%s 等%d家公司"
RUN_TITLE, RUN_COUNTS, RUN_HEAD = "# 面经处理流水线运行报告", "## 数据统计", ["| 指标 | 数量 |", "|------|------|"]
RUN_ROWS = [("原始面经记录", "total_records"), ("文本分块数", "total_chunks"), ("原子问题总数", "total_questions"), ("首次抽取问题数", "first_pass"), ("补漏抽取问题数", "coverage_pass"), ("去重后问题数", "canonical_questions")]
RUN_COVERAGE, RUN_RATE, RUN_MISSING, RUN_MISSING_COUNT, RUN_REST = "## 覆盖率", "**源记录覆盖率**: %s", "### 未覆盖记录", "共 %d 条记录未抽取到问题：", "- ... 还有 %d 条"
RUN_ERRORS, RUN_STATE, RUN_DONE, RUN_OPEN = "## 错误统计", "## 验收状态", "- [x] 覆盖率 = 100%", "- [ ] 覆盖率 = %s (目标100%%)"
LISTED_UNCOVERED = 10

KEYS = ["section", "o1", "o2", "o3", "o4", "line_no"]


def _lines(rows: DataFrame, section: int, lines: Column, o1=None, o2=None, o3=None, o4=None) -> DataFrame:
    given = [F.lit(0) if o1 is None else o1, F.lit("") if o2 is None else o2, F.lit("") if o3 is None else o3, F.lit(0) if o4 is None else o4]
    keys = [c.cast(t).alias(n) for c, n, t in zip(given, ("o1", "o2", "o3", "o4"), ("long", "string", "string", "long"), strict=True)]
    out = rows.select(F.lit(section).cast("long").alias("section"), *keys, F.posexplode(lines).alias("line_no", "line"))
    return out.withColumn("line_no", F.col("line_no").cast("long")).select(*KEYS, "line")


def _array(*lines) -> Column:
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines])


def _item(level: str) -> Column:
    high = F.col("member_count") >= HIGH_FREQUENCY
    number = F.col("rank").cast("string")
    return F.when(high, F.concat(F.lit(level), number, F.lit(". "), tier_icon("member_count"), F.lit(" "), F.col("text"))).otherwise(F.concat(F.lit(level), number, F.lit(". "), F.col("text")))


def _times() -> Column:
    return F.when(F.col("member_count") >= HIGH_FREQUENCY, F.format_string(TIMES_HIGH, "member_count")).otherwise(F.format_string(TIMES, "member_count"))


def _dashed(values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit("- "), v))


def _union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def company_report(exploded: DataFrame) -> DataFrame:
    """Companies by falling question count, tags by name, questions by rank (label, text, member_count, variants, primary_tag, company)."""
    rows = with_tag(exploded)
    totals = company_totals(rows)
    items = ranked(rows, ["company", "tag"]).join(totals, "company")
    first = -F.col("questions")
    head = totals.agg(F.count(F.lit(1)).alias("n"))
    others = F.filter(F.slice("variants", 1, 3), lambda v: v != F.col("text"))
    variants = F.when(F.size("variants") > 0, F.concat(_array(VARIANTS), _dashed(others), _array(""))).otherwise(F.array().cast("array<string>"))
    tag_name = F.when(F.col("tag") == UNCERTAIN, UNCERTAIN_LABEL).otherwise(F.col("tag"))
    tags = items.select("company", "questions", "tag").distinct()
    return _union(
        _lines(head, 0, _array(COMPANY_TITLE, "", F.format_string(COMPANY_COUNT, "n"), "", "---", "")),
        _lines(totals, 1, _array(F.concat(F.lit("## "), "company"), "", F.format_string(TOTALS, "questions", "high_frequency"), ""), first, F.col("company")),
        _lines(tags, 1, _array(F.concat(F.lit("### "), tag_name), ""), first, F.col("company"), F.concat(F.lit("\u0001"), "tag")),
        _lines(items, 1, F.concat(_array(_item("#### "), ""), variants, _array(_times(), "")), first, F.col("company"), F.concat(F.lit("\u0001"), "tag"), F.col("rank")),
        _lines(totals, 1, _array("---", ""), first, F.col("company"), F.lit("\u0002")),
    )


def category_order(questions: DataFrame) -> DataFrame:
    """category, questions, high_frequency and place: categories by falling size, then name."""
    sizes = questions.groupBy("category").agg(F.count(F.lit(1)).alias("questions"), F.count_if(F.col("member_count") >= HIGH_FREQUENCY).alias("high_frequency"))
    before = Window.orderBy(F.desc("questions"), "category")  # one row per category
    return sizes.withColumn("place", F.row_number().over(before).cast("long"))


def knowledge_report(questions: DataFrame) -> DataFrame:
    """Totals, the most frequent questions, contents, then categories by size with their questions by rank."""
    order = category_order(questions)
    high = questions.filter(F.col("member_count") >= HIGH_FREQUENCY)
    totals = order.agg(F.coalesce(F.sum("questions"), F.lit(0)).alias("q"), F.count(F.lit(1)).alias("c"), F.coalesce(F.sum("high_frequency"), F.lit(0)).alias("h"))
    top = high.orderBy(F.desc("member_count"), "label").limit(TOP_OVERVIEW)
    named = F.array_join(F.slice("companies", 1, 3), ", ")
    overview = F.array(F.format_string(OVERVIEW_LINE, tier_icon("member_count"), F.col("text"), F.col("member_count"), named))
    mark = F.when(F.col("high_frequency") > 0, F.format_string(CONTENTS_HIGH, "high_frequency")).otherwise("")
    entry = F.array(F.format_string(CONTENTS_LINE, F.col("category"), F.lower("category"), F.col("questions"), mark))
    items = ranked(questions, ["category"]).join(order.select("category", "place"), "category")
    count = F.size("companies")
    shown = F.array_join(F.slice("companies", 1, 5), ", ")
    seen = F.when(count > 5, F.format_string(SEEN_AT, F.format_string(AND_MORE, shown, count))).otherwise(F.format_string(SEEN_AT, shown))
    none = F.array().cast("array<string>")
    others = F.filter(F.slice("variants", 1, 5), lambda v: v != F.col("text"))
    variants = F.when(F.size(others) > 0, F.concat(_array(VARIANTS), _dashed(F.slice(others, 1, 3)), _array(""))).otherwise(none)
    body = F.concat(_array(_item("### "), ""), F.when(count > 0, _array(seen, "")).otherwise(none), _array(_times(), ""), variants)
    return _union(
        _lines(totals, 0, _array(TOPIC_TITLE, "", F.format_string(TOPIC_ALL, "q"), F.format_string(TOPIC_AREAS, "c"), F.format_string(TOPIC_HIGH, "h"), "", "---", "", OVERVIEW_HEAD, "")),
        _lines(top, 1, overview, -F.col("member_count"), o4=F.col("label")),
        _lines(totals, 2, _array("", "---", "", CONTENTS_HEAD, "")),
        _lines(order, 3, entry, F.col("place")),
        _lines(totals, 4, _array("", "---", "")),
        _lines(order, 5, _array(F.concat(F.lit("## "), "category"), "", F.format_string(TOPIC_TOTALS, "questions", "high_frequency"), ""), F.col("place")),
        _lines(items, 5, body, F.col("place"), o4=F.col("rank")),
        _lines(order, 5, _array("---", ""), F.col("place"), o2=F.lit("end")),
    )


def run_report(audited: DataFrame, uncovered: DataFrame, errors: DataFrame, run: tuple[str, str, str] = ("", "", "")) -> DataFrame:
    """The audit as a report. audited: one row of audit.full; uncovered: record_id; errors: status, n; run: id, start and end."""
    rate = percent(F.col("coverage_rate"))
    heads = [RUN_TITLE, "", f"**运行ID**: {run[0]}", f"**开始时间**: {run[1]}", f"**结束时间**: {run[2]}", "", "---", "", RUN_COUNTS, "", *RUN_HEAD]
    counts = [F.format_string(f"| {label} | %d |", name) for label, name in RUN_ROWS]
    first = uncovered.orderBy("record_id").limit(LISTED_UNCOVERED)
    missing = audited.filter(F.col("failures") > 0)
    failed = errors.filter(F.col("status") != "ok")
    rest = F.when(F.col("failures") > LISTED_UNCOVERED, F.array(F.format_string(RUN_REST, F.col("failures") - LISTED_UNCOVERED))).otherwise(F.array().cast("array<string>"))
    state = F.when(F.col("coverage_rate") >= 1, F.lit(RUN_DONE)).otherwise(F.format_string(RUN_OPEN, rate))
    any_error = failed.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    return _union(
        _lines(audited, 0, _array(*heads, *counts, "", "---", "", RUN_COVERAGE, "", F.format_string(RUN_RATE, rate), "")),
        _lines(missing, 1, _array(RUN_MISSING, "", F.format_string(RUN_MISSING_COUNT, "failures"), "")),
        _lines(first, 2, F.array(F.concat(F.lit("- `"), F.col("record_id").cast("string"), F.lit("`"))), o2=F.lpad(F.col("record_id").cast("string"), 64, " ")),
        _lines(missing, 3, F.concat(rest, _array(""))),
        _lines(any_error, 4, _array("---", "", RUN_ERRORS, "")),
        _lines(failed, 5, F.array(F.concat(F.lit("- "), "status", F.lit(": "), F.col("n").cast("string"))), o2=F.col("status")),
        _lines(any_error, 6, _array("")),
        _lines(audited, 7, _array("---", "", RUN_STATE, "", state, "")),
    )


def group_sheets(sheet: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The first MOST_SHEETS groups in the order of the sheet's rows, their place and sheet names."""
    place = Window.orderBy("_first")  # one row per group
    keyed = sheet.select(group, F.struct(*[c.alias(f"k{n}") for n, c in enumerate(order)]).alias("_key"))
    firsts = keyed.groupBy(group).agg(F.min("_key").alias("_first"))
    return firsts.withColumn("place", F.row_number().over(place).cast("long")).filter(F.col("place") <= MOST_SHEETS).select(group, "place", F.substring(group, 1, SHEET_NAME).alias("sheet"))


def write_report(lines: DataFrame, path: str) -> None:
    lines.orderBy(*KEYS).select("line").write.mode("overwrite").text(path)


def empty_errors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string("status string, n long"))
