"""Aggregations over records and series: prominence, rollups with floors, completeness, cross-checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prominence(df: DataFrame, links: str, period: str, keep: Column | None = None) -> DataFrame:
    """Distinct periods in which each linked entity occurs."""
    pairs = df.select(F.explode(links).alias("link"), F.col(period).alias("period"))
    return (pairs if keep is None else pairs.where(keep)).groupBy("link").agg(F.count_distinct("period").alias("prominence"))


def with_floor(df: DataFrame, keys: list[str], floor: int, *extra: Column) -> DataFrame:
    """Rows per key, of keys with at least ``floor`` rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("entries"), *extra).where(F.col("entries") >= floor)


def complete_mean(df: DataFrame, group: str, value: str, need: int, digits: int, exact: bool = False) -> DataFrame:
    """Mean per group over its sub-periods, only of groups that have enough of them."""
    n = F.count(value)
    out = df.groupBy(group).agg(n.alias("n"), F.round(F.avg(F.col(value).cast("decimal(20,6)")), digits).cast("double").alias("mean"))
    return out.where(F.col("n") == need if exact else F.col("n") >= need)


def cross_check(a: DataFrame, b: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """One row: common keys, largest absolute difference and its key, keys beyond the tolerance, passed."""
    both = a.select(key, F.col(value).alias("va")).join(b.select(key, F.col(value).alias("vb")), key).withColumn("d", F.round(F.abs(F.col("va") - F.col("vb")), 6))
    out = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("d").alias("max_diff"),
        F.min_by(key, F.struct((-F.col("d")).alias("x"), key)).alias("worst"),
        F.count_if(F.col("d") > tolerance + 1e-12).alias("beyond"),
    )
    return out.withColumn("passed", (F.col("n") > 0) & (F.col("beyond") == 0))


def most_frequent(df: DataFrame, key: Column, spelling: str) -> DataFrame:
    """The most frequent spelling per key, ties by the spelling."""
    counts = df.groupBy(key.alias("key"), F.col(spelling).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("key").orderBy(F.desc("n"), "label")
    return counts.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def rebaselined(df: DataFrame, period: Column, value: str, in_base: Column, within: list[str] = []) -> DataFrame:  # noqa: B006
    """Series minus its mean over the base period, per ``within``."""
    mean = F.avg(F.when(in_base, F.col(value)))
    # without groups the mean is one number, never a window over the whole series
    base = mean.over(Window.partitionBy(*within)) if within else df.agg(mean.alias("m")).scalar()
    return df.withColumn("anomaly", F.round(F.col(value) - base, 4))


def missing_periods(df: DataFrame, year: str, month: str) -> DataFrame:
    """Per year with data: the months without, in order."""
    have = df.select(year, month).distinct()
    grid = have.select(year).distinct().select(year, F.explode(F.sequence(F.lit(1), F.lit(12))).alias(month))
    gone = grid.join(have, [year, month], "left_anti")
    return gone.groupBy(year).agg(F.array_join(F.array_sort(F.collect_list(month)).cast("array<string>"), ",").alias("missing"))
