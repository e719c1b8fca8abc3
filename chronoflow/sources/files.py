"""Reading and writing keyed files: JSON per key, NDJSON, CSV series, GeoJSON, Parquet exports, JSONL logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def json_per_key(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All JSON documents of a folder with ``key``, the number in the file or folder name; index files are skipped."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path).withColumn("file", F.col("_metadata.file_path"))
    key = F.regexp_extract("file", r"(-?\d+)(?:\.json|/[^/]*)$", 1)
    return rows.where(~F.col("file").rlike(r"/(?:index\.json|_)")).withColumn("key", key.try_cast("int")).drop("file")


def write_json_per_key(df: DataFrame, path: str, key: str) -> None:
    """One folder of NDJSON per key; what was there before is replaced."""
    df.repartition(key).write.mode("overwrite").partitionBy(key).json(path)


def csv_series(spark: SparkSession, path: str) -> DataFrame:
    """period, value of a CSV with a header in which a dot or nothing means missing; missing values are left out."""
    rows = spark.read.option("header", "true").schema("period string, value string").csv(path)
    return rows.select("period", F.col("value").try_cast("double").alias("value")).where("value is not null")


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON files, each id once: id, time (ms), properties."""
    schema = "features array<struct<id string, properties struct<time bigint, kind string, size double>>>"
    rows = spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").json(path)
    return rows.select(F.inline("features")).select("id", "properties.*").dropDuplicates(["id"])


def latest_ok(df: DataFrame, key: str, order: str, ok: str) -> DataFrame:
    """Of an appended log the last successful row per key, else the last."""
    return df.groupBy(key).agg(F.max_by(F.struct("*"), F.struct(F.col(ok).cast("int"), F.col(order))).alias("r")).select("r.*")


def redirects(df: DataFrame, alias: str, target: str, weight: str, most: int) -> DataFrame:
    """alias, target: the ``most`` aliases of the weightiest targets, each alias once (a redirect table has a size limit)."""
    w = Window.partitionBy(alias).orderBy(F.desc(weight), target)
    return df.withColumn("r", F.row_number().over(w)).where("r = 1").orderBy(F.desc(weight), alias).limit(most).select(alias, target)
