"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoflow.llm.neardup import near_duplicates
from chronoflow.sources.tables import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of published rows of similarity 0.8 or more whose dates don't conflict."""
    found = near_duplicates(table(spark, sf_dir, "published"), "row_id", "text", "date")
    return found.pairs().select(F.col("a").alias("row_id_a"), F.col("b").alias("row_id_b"))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each published row with words: its group of connected texts and its text's links to others."""
    found = near_duplicates(table(spark, sf_dir, "published"), "row_id", "text", "date")
    return found.groups().select(F.col("id").alias("row_id"), F.col("group").alias("group_id"), "links")


def p3_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each published row with words: the row that stands for its exact copies. With p3_links all that p3_found says, in linear space."""
    found = near_duplicates(table(spark, sf_dir, "published"), "row_id", "text", "date")
    return found.members().select(F.col("id").alias("row_id"), F.col("node").alias("copy_of"))


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different texts (each by the row that stands for its copies)."""
    found = near_duplicates(table(spark, sf_dir, "published"), "row_id", "text", "date")
    return found.links.select(F.col("a").alias("row_id_a"), F.col("b").alias("row_id_b"))


QUERIES = {"p3_found": p3_found, "p3_groups": p3_groups, "p3_members": p3_members, "p3_links": p3_links}
SQL = {}
