"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoflow.llm.encoding import decode_ids, default_vocabulary, encode_texts
from chronoflow.sources.tables import table


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text", default_vocabulary())


def p8_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of every document after encoding and decoding it: the length of its text."""
    ids = p8_ids(spark, sf_dir)
    return decode_ids(ids, "doc_id", "ids", default_vocabulary()).select("doc_id", F.length("text").cast("bigint").alias("chars"))


QUERIES = {"p8_ids": p8_ids, "p8_roundtrip": p8_roundtrip}
SQL = {"p8_roundtrip": "SELECT doc_id, coalesce(length(text), 0)::BIGINT AS chars FROM documents"}
