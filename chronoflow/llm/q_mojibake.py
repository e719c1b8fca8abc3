"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoflow.llm.mojibake import repair_encoding
from chronoflow.sources.tables import table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows whose text was decoded in a wrong encoding."""
    return p6_restored(spark, sf_dir).select("row_id")


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the original text, as far as it can be had."""
    return repair_encoding(table(spark, sf_dir, "published"), "row_id", "text")


QUERIES = {"p6_found": p6_found, "p6_restored": p6_restored}
SQL = {}
