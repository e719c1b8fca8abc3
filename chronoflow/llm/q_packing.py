"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoflow.llm.encoding import default_vocabulary
from chronoflow.llm.packing import pack
from chronoflow.sources.tables import table

#: Tokens a container holds.
CAPACITY = 2048


def p9_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or of every part of one above the capacity."""
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text", default_vocabulary(), CAPACITY)


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and room of every container."""
    return p9_packed(spark, sf_dir).groupBy("container").agg(F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("tokens"), (F.lit(CAPACITY) - F.sum("tokens")).alias("room"))


QUERIES = {"p9_packed": p9_packed, "p9_containers": p9_containers}
SQL = {}
