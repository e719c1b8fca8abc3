"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoflow.llm.capping import cap_contributors
from chronoflow.sources.tables import table

#: A country may hold one record in this many.
SHARE = 50


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records left out when every country is held to a fiftieth of the records with a country."""
    rows = table(spark, sf_dir, "published")
    country = F.lower(F.trim("country"))
    country = F.when(country != "", country)
    cap = rows.select(F.count(country)).first()[0] // SHARE
    return cap_contributors(rows, country, "weight", "row_id", cap, "loaded_at").displaced().select(F.col("t").alias("row_id"))


QUERIES = {"p5_found": p5_found}
SQL = {
    "p5_found": """
WITH rows AS (
  SELECT row_id, nullif(lower(trim(country)), '') AS c, CASE WHEN weight IS NULL OR isnan(weight) THEN '-infinity'::DOUBLE ELSE weight END AS w FROM published
)
SELECT row_id FROM (
  SELECT row_id, row_number() OVER (PARTITION BY c ORDER BY w DESC, row_id) AS rn FROM rows WHERE c IS NOT NULL
) WHERE rn > (SELECT count(c) // 50 FROM rows)"""
}
