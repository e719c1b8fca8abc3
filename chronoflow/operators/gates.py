"""Data-quality gates: classes of failures with counts and examples, and ratcheted baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(df: DataFrame, name: str, key: str, classes: dict[str, Column]) -> DataFrame:
    """gate, class, key: one row per row and class it fails; all classes in one pass."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in classes.items()]))
    return df.select(F.lit(name).alias("gate"), F.explode(hits).alias("class"), F.col(key).alias("key"))


def report(failures: DataFrame, examples: int = 5) -> DataFrame:
    """gate, class, n and the first examples. The examples are the least keys, kept by a bounded merge."""
    from pyspark.sql import Window

    n = failures.groupBy("gate", "class").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("gate", "class").orderBy("key")
    first = failures.withColumn("k", F.row_number().over(w)).where(F.col("k") <= examples).groupBy("gate", "class").agg(F.array_join(F.array_sort(F.collect_list("key")).cast("array<string>"), ",").alias("examples"))
    return n.join(first, ["gate", "class"])


def ratchet(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """class, n, accepted, verdict: worse than the accepted count fails, better may be accepted as the new one."""
    out = counts.join(baseline.withColumnRenamed("n", "accepted"), "class", "full_outer").select("class", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("accepted", F.lit(0)).cast("bigint").alias("accepted"))
    return out.withColumn("verdict", F.when(F.col("n") > F.col("accepted"), "worse").when(F.col("n") < F.col("accepted"), "better").otherwise("same"))
