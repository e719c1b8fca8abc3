"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoflow.llm.residue import residue
from chronoflow.sources.tables import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows that hold residue instead of a sentence of the record."""
    return p4_matches(spark, sf_dir).select("row_id")


def p4_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the exemplar that a window of the text covers best."""
    return residue(table(spark, sf_dir, "published"), "row_id", "text")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows without residue."""
    rows = table(spark, sf_dir, "published")
    return rows.select("row_id", "text").join(residue(rows, "row_id", "text").select("row_id"), "row_id", "left_anti")


QUERIES = {"p4_found": p4_found, "p4_matches": p4_matches, "p4_clean": p4_clean}
SQL = {}
