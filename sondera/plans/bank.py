"""Question-bank frames over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sondera.functions.text import compare_key, normalize, strip
from sondera.operators.providers import classify_keywords
from sondera.sources.tables import staged, table

#: A small taxonomy in the languages of the driver's documents: category, display name, keywords.
TOPICS = {
    "contact": ("Contact", ["@", "+1 ("]),
    "english": ("English", [" the ", " and ", " that "]),
    "french": ("French", [" les ", " des ", " une "]),
    "german": ("German", [" der ", " und ", " die "]),
    "licence": ("Licence", ["licensed", "license"]),
    "spanish": ("Spanish", [" los ", " que ", " las "]),
}


#: Variants that a group shows.
VARIANTS = 10


def topic_keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, w) for c, (_, words) in TOPICS.items() for w in words], "category string, keyword string")


def topic_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, name) for c, (name, _) in TOPICS.items()], "tag string, name string")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank lines of documents as questions: qid, record_id, source, raw, norm, hint."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    q = d.select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("qid"), F.col("doc_id").alias("record_id"), "source", strip("line").alias("raw"))
    return q.filter("raw != ''").withColumn("norm", normalize("raw")).withColumn("hint", F.lit(None).cast("string"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines grouped by comparison key: label, text, member_count, companies, variants. Equal keys are components already.

    Equal lines are counted before they meet by key, and a key gathers its first 10
    variants and its sources only, so a very common line fills no row.
    """
    q = lines(spark, sf_dir).select("qid", "source", "raw", compare_key("norm").alias("k"))
    each = staged(q.groupBy("k", "raw", "source").agg(F.count(F.lit(1)).alias("n"), F.min("qid").alias("qid")), "lines")
    whole = each.groupBy("k").agg(
        F.min("qid").alias("label"),
        F.max_by("raw", F.struct(F.length("raw").alias("n"), (-F.col("qid")).alias("o"))).alias("text"),
        F.sum("n").alias("member_count"),
    )
    first = each.select("k", "raw").distinct().withColumn("_n", F.row_number().over(Window.partitionBy("k").orderBy("raw"))).filter(F.col("_n") <= VARIANTS)
    variants = first.groupBy("k").agg(F.array_sort(F.collect_list("raw")).alias("variants"))
    companies = each.select("k", "source").distinct().groupBy("k").agg(F.array_sort(F.collect_list("source")).alias("companies"))
    return whole.join(companies, "k").join(variants, "k").select("k", "label", "text", "member_count", "companies", "variants")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped lines with their tags and company counts."""
    g = staged(groups(spark, sf_dir).drop("k").withColumn("company_count", F.size("companies").cast("long")), "groups")
    return g.join(classify_keywords(g, topic_keywords(spark), "label", "text"), "label")
