"""Queries of problem 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoflow.llm.encoding import default_vocabulary
from chronoflow.llm.splitting import split_texts
from chronoflow.sources.tables import table

#: Most tokens of a piece, and tokens that consecutive pieces share.
LIMIT, OVERLAP = 512, 64


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces of at most ``LIMIT`` tokens that share ``OVERLAP``."""
    return split_texts(table(spark, sf_dir, "documents"), "doc_id", "text", default_vocabulary(), LIMIT, OVERLAP)


QUERIES = {"p10_pieces": p10_pieces}
SQL = {}
