"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoflow.llm.residue import Model, residue
from chronoflow.llm.truncation import truncated
from chronoflow.sources.tables import table


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "published")
    return truncated(rows, "row_id", "text", "site").join(residue(rows, "row_id", "text").select("row_id"), "row_id", "left_anti")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows whose text was cut off; residue is no text of the record."""
    rows = table(spark, sf_dir, "published")
    return truncated(rows, "row_id", "text", "site", residue=Model.fit(rows, "text")).where("cut").select("row_id")


def p2_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each site truncates, among its rows with text that is no residue."""
    return _scored(spark, sf_dir).groupBy(F.col("source").alias("site")).agg(
        F.count(F.lit(1)).alias("texts"), F.count_if("cut").alias("truncated"), F.round(F.avg(F.col("cut").cast("int")), 6).alias("share")
    )


QUERIES = {"p2_found": p2_found, "p2_sources": p2_sources}
SQL = {}
