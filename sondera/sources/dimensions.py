"""Small dimension tables from YAML files: company aliases, directories, taxonomy, terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def pairs(spark: SparkSession, mapping: dict, key: str, value: str) -> DataFrame:
    rows = [(str(k), str(v)) for k, v in mapping.items()]
    return spark.createDataFrame(rows, f"{key} string, {value} string")


def aliases(spark: SparkSession, config: dict) -> DataFrame:
    """company_raw, canonical; names are case-sensitive."""
    return pairs(spark, config.get("mappings", {}), "company_raw", "canonical")


def directories(spark: SparkSession, config: dict) -> DataFrame:
    """dir_key, company."""
    return pairs(spark, config.get("dir_to_company", {}), "dir_key", "company")


def terms(config: dict) -> list[tuple[str, str]]:
    """Term rewrites in file order."""
    return list(config.get("normalization", {}).get("term_mappings", {}).items())


def taxonomy(spark: SparkSession, config: dict) -> DataFrame:
    """category, category_name, subcategory, keyword, one row per keyword."""
    rows = [
        (category, c.get("name", category), sub, str(keyword))
        for category, c in config.get("taxonomy", {}).items()
        for sub, s in c.get("subcategories", {}).items()
        for keyword in s.get("keywords", [])
    ]
    return spark.createDataFrame(rows, "category string, category_name string, subcategory string, keyword string")


def shortcuts(spark: SparkSession, config: dict) -> DataFrame:
    """keyword, category."""
    return pairs(spark, config.get("keyword_to_category", {}), "keyword", "category")
