"""Queries and the SQL they are held against, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronoflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The tables of one data folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Register a function of ``Tables`` under its own name."""

        def register(f: Callable[[Tables], DataFrame]):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return f(Tables(spark, sf_dir))

            run.__doc__ = f.__doc__
            self.queries[f.__name__] = run
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register
