"""Queries on the continuous periods of state offices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoflow.operators.intervals import merge_intervals
from chronoflow.sources.tables import table

#: The year that stands for an end not yet reached.
OPEN_END = 2026


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous periods and the gaps between them for every (state_link, office)."""
    rows = table(spark, sf_dir, "stateleaders").select("state_link", "office", "terms", "years").where("state_link is not null and office is not null")
    term = F.transform(
        F.coalesce("terms", F.array().cast("array<array<int>>")),
        lambda t: F.struct(F.get(t, 0).alias("s"), F.coalesce(F.get(t, 1), F.lit(OPEN_END)).alias("e")),
    )
    year = F.transform(F.coalesce("years", F.array().cast("array<int>")), lambda y: F.struct(y.alias("s"), y.alias("e")))
    spans = rows.select("state_link", "office", F.inline(F.concat(term, year))).withColumnsRenamed({"s": "start", "e": "end"})
    return merge_intervals(spans, ["state_link", "office"])


P7_SQL = """
WITH spans AS (
  SELECT state_link, office, t[1] AS s, coalesce(t[2], 2026) AS e FROM (SELECT state_link, office, unnest(terms) AS t FROM stateleaders)
  UNION ALL
  SELECT state_link, office, y, y FROM (SELECT state_link, office, unnest(years) AS y FROM stateleaders)
), ok AS (
  SELECT *, max(e) OVER (PARTITION BY state_link, office ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM spans WHERE state_link IS NOT NULL AND office IS NOT NULL AND s IS NOT NULL AND s <= e
), runs AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR reach + 1 < s THEN 1 ELSE 0 END) OVER (PARTITION BY state_link, office ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM ok
), periods AS (
  SELECT state_link, office, min(s) AS year_from, max(e) AS year_to FROM runs GROUP BY state_link, office, run
), linked AS (
  SELECT *, lead(year_from) OVER (PARTITION BY state_link, office ORDER BY year_from) AS nxt FROM periods
)
SELECT state_link, office, 'period' AS what, year_from::INTEGER AS year_from, year_to::INTEGER AS year_to FROM linked
UNION ALL
SELECT state_link, office, 'gap', (year_to + 1)::INTEGER, (nxt - 1)::INTEGER FROM linked WHERE nxt IS NOT NULL
"""

QUERIES = {"p7_found": p7_found}
SQL = {"p7_found": P7_SQL}
