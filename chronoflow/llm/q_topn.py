"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoflow.llm.topn import top_n
from chronoflow.sources.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three rows of highest weight of every section of every page."""
    return top_n(table(spark, sf_dir, "published"), ["page_id", "section"], "weight", "row_id", 3)


QUERIES = {"p1_found": p1_found}
SQL = {
    "p1_found": """
SELECT page_id, section, row_id FROM (
  SELECT page_id, section, row_id, row_number() OVER (PARTITION BY page_id, section ORDER BY weight DESC, row_id) AS rn
  FROM published WHERE page_id IS NOT NULL AND section IS NOT NULL AND weight IS NOT NULL AND NOT isnan(weight)
) WHERE rn <= 3"""
}
