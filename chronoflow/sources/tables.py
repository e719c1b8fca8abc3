"""Reading the driver's tables, with UTC-safe and column-pruned scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoflow.plans.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; columns and filters are pushed into the scan."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
