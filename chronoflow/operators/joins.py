"""Joins beyond equality: as-of, interval and overlap joins, agreement of two sources, co-occurrence.

Interval joins are turned into equi-joins: both sides are exploded into blocks of the axis that their
intervals touch, so a shuffle join on the block does the work and no nested loop is planned. A pair
that meets in several blocks is kept in the one in which the later of the two begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, value: list[str], forward: bool = False, tolerance: Column | None = None) -> DataFrame:
    """Each left row with the values of the last right row at or before it (or first at or after it).

    Union and carry: one shuffle on ``by``, one sort, no join. Of right rows with the same place the
    greatest value row counts. ``tolerance`` is a condition on ``at`` and ``as_of``.
    """
    payload = F.struct(F.col(at).alias("as_of"), *value).alias("v")
    r = right.groupBy(*by, at).agg(F.max(F.struct(*value)).alias("m")).select(*by, at, *[F.col(f"m.{c}").alias(c) for c in value])
    both = left.withColumn("side", F.lit(1)).withColumn("v", F.lit(None)).unionByName(
        r.select(*by, at, payload).withColumn("side", F.lit(0)), allowMissingColumns=True
    )
    if forward:
        w = Window.partitionBy(*by).orderBy(F.desc(at), "side").rowsBetween(Window.unboundedPreceding, 0)
    else:
        w = Window.partitionBy(*by).orderBy(at, "side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("v", F.last("v", ignorenulls=True).over(w)).where("side = 1").select(*left.columns, "v.*")
    if tolerance is not None:
        out = out.select(*left.columns, *[F.when(tolerance, F.col(c)).alias(c) for c in ("as_of", *value)])
    return out


def overlapping(left: DataFrame, right: DataFrame, by: list[str], l_span: tuple[str, str], r_span: tuple[str, str], width: int) -> DataFrame:
    """Pairs whose closed integer spans overlap, within ``by``; blocks of ``width`` make it an equi-join."""
    block = lambda c: F.floor(F.col(c) / width)
    l = left.withColumn("block", F.explode(F.sequence(block(l_span[0]), block(l_span[1]))))  # noqa: E741
    r = right.withColumn("block", F.explode(F.sequence(block(r_span[0]), block(r_span[1]))))
    met = l.join(r, [*by, "block"]).where((F.col(l_span[0]) <= F.col(r_span[1])) & (F.col(r_span[0]) <= F.col(l_span[1])))
    return met.where(F.col("block") == F.floor(F.greatest(l_span[0], r_span[0]) / width)).drop("block")


def overlap_counts(left: DataFrame, right: DataFrame, by: str, l_span: tuple[str, str], r_span: tuple[str, str]) -> DataFrame:
    """Left columns, ``by``, n: how many right spans of each value of ``by`` overlap each left span, where any does.

    No pair is built: spans that began by a left span's end, less those that ended before its start,
    are running sums over the axis, looked up as of those two places. ``by`` has few values.
    """
    if by in left.columns:
        raise ValueError(f"column {by!r} of the left side is taken")

    def running(at: str) -> DataFrame:
        n = right.groupBy(by, F.col(at).cast("bigint").alias("at")).agg(F.count(F.lit(1)).alias("c"))
        return n.withColumn("so_far", F.sum("c").over(Window.partitionBy(by).orderBy("at"))).drop("c")

    each = left.withColumn(by, F.explode(right.agg(F.collect_set(by)).scalar()))
    begun = as_of(each.withColumn("at", F.col(l_span[1]).cast("bigint")), running(r_span[0]), [by], "at", ["so_far"]).withColumnRenamed("so_far", "begun").drop("as_of", "at")
    ended = as_of(begun.withColumn("at", F.col(l_span[0]).cast("bigint") - 1), running(r_span[1]), [by], "at", ["so_far"]).withColumnRenamed("so_far", "ended").drop("as_of", "at")
    n = F.coalesce("begun", F.lit(0)) - F.coalesce("ended", F.lit(0))
    return ended.select(*left.columns, by, n.alias("n")).where("n > 0")


def agreement(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with a status: same, different, only left, only right (full outer join, null-safe values)."""
    l = left.select(*keys, F.struct(value).alias("l"))  # noqa: E741
    r = right.select(*keys, F.struct(value).alias("r"))
    status = F.when(F.col("r").isNull(), "only left").when(F.col("l").isNull(), "only right").when(F.col("l").eqNullSafe(F.col("r")), "same").otherwise("different")
    return l.join(r, keys, "full_outer").select(*keys, status.alias("status"))


def co_occurrence(df: DataFrame, row: str, item: str, keep: int) -> DataFrame:
    """The ``keep`` items most often in one row with each item. Rows hold few items (a sentence's links)."""
    x = df.select(row, item).distinct()
    pairs = x.join(x.select(row, F.col(item).alias("other")), row).where(F.col(item) != F.col("other"))
    counts = pairs.groupBy(item, "other").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(item).orderBy(F.desc("n"), "other")
    return counts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep)


def best_overlap(left: DataFrame, right: DataFrame, by: list[str], l_id: str, r_id: str, l_tokens: str, r_tokens: str) -> DataFrame:
    """For each left row the right row of its group with the largest share of the left row's tokens.

    An equi-join on tokens; ties by ``r_id``.
    """
    l = left.select(*by, l_id, F.size(l_tokens).alias("size"), F.explode(l_tokens).alias("token"))  # noqa: E741
    r = right.select(*by, r_id, F.explode(r_tokens).alias("token"))
    met = l.join(r, [*by, "token"]).groupBy(*by, l_id, "size", r_id).agg(F.count(F.lit(1)).alias("shared"))
    w = Window.partitionBy(*by, l_id).orderBy(F.desc("shared"), r_id)
    return met.withColumn("k", F.row_number().over(w)).where("k = 1").withColumn("coverage", F.round(F.col("shared") / F.col("size"), 6)).drop("k", "size")
