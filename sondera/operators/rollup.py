"""Roll-ups by company and by topic, ranks, sheets and report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sondera.functions.text import sheet_safe, tier

# Labels, limits and file formats of the reports.
UNKNOWN, OTHER, UNCERTAIN, UNCERTAIN_LABEL = "未知", "其他", "uncertain", "待分类"
HIGH_FREQUENCY = 5
TIER_LABELS = {3: "超高频", 2: "高频", 1: "中频", 0: ""}
TOP_OVERVIEW, MOST_SHEETS, SHEET_NAME = 50, 20, 31


def with_companies(canonical: DataFrame, records: DataFrame) -> DataFrame:
    """Replace companies by the distinct companies of each question's source records; unknown records add none.

    canonical: label, source_refs; records: record_id, company_norm, company_raw.
    """
    refs = canonical.select("label", F.explode("source_refs").alias("record_id"))
    name = F.coalesce(F.when(F.col("company_norm") != "", F.col("company_norm")), F.when(F.col("company_raw") != "", F.col("company_raw")), F.lit(UNKNOWN))
    met = refs.join(records.select("record_id", name.alias("company")), "record_id").groupBy("label").agg(F.array_sort(F.collect_set("company")).alias("companies"))
    out = canonical.drop("companies", "company_count").join(met, "label", "left")
    return out.withColumn("companies", F.coalesce("companies", F.array().cast("array<string>"))).withColumn("company_count", F.size("companies").cast("long"))


def by_company(questions: DataFrame) -> DataFrame:
    """One row per question and company."""
    return questions.withColumn("company", F.explode("companies"))


def company_totals(exploded: DataFrame) -> DataFrame:
    return exploded.groupBy("company").agg(F.count(F.lit(1)).alias("questions"), F.count_if(F.col("member_count") >= HIGH_FREQUENCY).alias("high_frequency"))


def ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rank by member count, falling, then by label."""
    w = Window.partitionBy(*by).orderBy(F.desc("member_count"), "label")
    return rows.withColumn("rank", F.row_number().over(w))


def with_tag(questions: DataFrame) -> DataFrame:
    return questions.withColumn("tag", F.coalesce(F.when(F.col("primary_tag") != "", F.col("primary_tag")), F.lit(OTHER)))


def with_category(questions: DataFrame, names: DataFrame) -> DataFrame:
    """Add category: the display name of the primary tag, the tag itself if unknown, or uncertain. names: tag, name (small)."""
    tag = F.coalesce(F.when(F.col("primary_tag") != "", F.col("primary_tag")), F.lit(UNCERTAIN))
    out = questions.withColumn("_tag", tag).join(F.broadcast(names.toDF("_tag", "_name")), "_tag", "left")
    return out.withColumn("category", F.coalesce("_name", "_tag")).drop("_tag", "_name")


def category_totals(questions: DataFrame) -> DataFrame:
    """Totals per category and, with a null category, of all."""
    return questions.rollup("category").agg(F.count(F.lit(1)).alias("questions"), F.count_if(F.col("member_count") >= HIGH_FREQUENCY).alias("high_frequency"))


def overview(questions: DataFrame, most: int = TOP_OVERVIEW) -> DataFrame:
    """The most frequent questions."""
    return questions.filter(F.col("member_count") >= HIGH_FREQUENCY).orderBy(F.desc("member_count"), "label").limit(most)


def tier_label(count: str = "member_count"):
    t = tier(count)
    return F.element_at(F.create_map(*[F.lit(x) for kv in TIER_LABELS.items() for x in kv]), t)



def by_tier() -> list[Column]:
    """The order of sheet rows: tier, count, question."""
    return [-tier("出现次数"), -F.col("出现次数"), F.col("问题")]


def by_company_and_tier() -> list[Column]:
    return [F.col("公司"), *by_tier()]


def company_sheet(exploded: DataFrame) -> DataFrame:
    """Rows of the company workbook in their order."""
    rows = exploded.select(
        F.col("company").alias("公司"), sheet_safe("text").alias("问题"), tier_label().alias("高频标记"), F.coalesce("primary_tag", F.lit("")).alias("知识点"),
        sheet_safe(F.array_join("secondary_tags", ", ")).alias("次级知识点"), F.col("member_count").alias("出现次数"), sheet_safe(F.array_join(F.slice("variants", 1, 3), "; ")).alias("变体"),
    )
    return rows.orderBy(*by_company_and_tier())


def knowledge_sheet(questions: DataFrame) -> DataFrame:
    """Rows of the topic workbook in their order."""
    rows = questions.select(
        F.col("category").alias("知识点"), sheet_safe("text").alias("问题"), tier_label().alias("高频标记"), F.col("member_count").alias("出现次数"),
        F.col("company_count").alias("出现公司数"), F.array_join(F.slice("companies", 1, 5), ", ").alias("出现公司"),
        sheet_safe(F.array_join(F.slice("variants", 1, 3), "; ")).alias("变体"), F.array_join("secondary_tags", ", ").alias("次级知识点"),
    )
    return rows.orderBy(*by_tier())
