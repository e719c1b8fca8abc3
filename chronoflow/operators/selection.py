"""Weights, quotas and samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def event_weight(size: Column, prominence: Column, most: Column, dated: Column, length: Column) -> Column:
    """Notability weight of an event from its subject's size, how common it is, a date and its length."""
    common = F.least(F.lit(1.0), F.log1p(F.greatest(F.lit(0), prominence - 3)) / math.log(61))
    notable = F.least(F.lit(1.0), F.log1p(size) * (1 - 0.85 * common) / math.log(200001))
    fame = F.least(F.lit(1.0), F.log1p(most) / math.log(251))
    return F.round(0.62 * notable + 0.10 * fame + 0.16 * dated.cast("int") + 0.12 * F.when(length < 70, 0.5).otherwise(1.0), 5)


def person_weight(size: Column, spread: Column, dated: Column) -> Column:
    return F.round(0.72 * F.least(F.lit(1.0), F.log1p(size) / math.log(200001)) + 0.16 * spread + 0.12 * dated.cast("int"), 5)


def claim_weight(prominence: Column, dated: Column, length: Column) -> Column:
    fit = F.when(length.between(70, 260), 1.0).when(length <= 400, 0.6).otherwise(0.35)
    return F.round(0.55 * F.log1p(prominence) / math.log(401) + 0.25 * dated.cast("int") + 0.20 * fit, 4)


def top_per_group(df: DataFrame, by: list[str], order: list[Column], cap: Column | int, name: str = "place") -> DataFrame:
    """The first ``cap`` rows of each group in a total order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= cap)


def even_spread(df: DataFrame, by: list[str], order: list[str], cap: int) -> DataFrame:
    """``cap`` rows of each group at even distances in order; smaller groups whole."""
    w = Window.partitionBy(*by)
    i, n = F.col("__i"), F.col("__n")
    out = df.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count(F.lit(1)).over(w))
    # row i is taken if some k has floor(k * n / cap) = i
    k = F.ceil(i * cap / n)
    taken = (n <= cap) | ((k < cap) & (F.floor(k * n / cap) == i))
    return out.where(taken).drop("__i", "__n")


def breadth_first(df: DataFrame, by: list[str], party: str, order: list[Column], cap: int) -> DataFrame:
    """Round robin over the parties of a group: every party's best row before any party's second."""
    w = Window.partitionBy(*by, party).orderBy(*order)
    rows = df.withColumn("depth", F.row_number().over(w)).where(F.col("depth") <= cap)
    return top_per_group(rows, by, [F.asc("depth"), *order], cap)


def seeded_order(seed: str, *keys: Column) -> Column:
    """A reproducible random order: the MD5 of a seed and the row's keys."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys]))


def stratified(df: DataFrame, stratum: str, group: str, key: str, seed: str, quota: int, per_group: int) -> DataFrame:
    """A seeded sample: up to ``quota`` rows per stratum and ``per_group`` per group of it, relaxed only if the stratum stays short."""
    r = seeded_order(seed, F.col(key))
    rows = df.withColumn("r", r).withColumn("in_group", F.row_number().over(Window.partitionBy(stratum, group).orderBy("r", key)))
    tier = F.when(F.col("in_group") <= per_group, 0).otherwise(F.col("in_group"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(stratum).orderBy(tier, "r", key))).where(F.col("place") <= quota).drop("r", "in_group")


def seeded_pairs(df: DataFrame, value: str, seed: str, least: int, quota: int, backward: float = 0.2) -> DataFrame:
    """A seeded sample without repeats of pairs of distinct values at least ``least`` apart: ``a``, ``b``, ``place``.

    Both orders of a pair are drawn alike; a backward draw (a > b) stays so with the chance ``backward``
    and is turned round else, which leaves half that share backward. ``value`` holds each value once.
    """
    a, b = F.col("a"), F.col("b")
    # the values are those of one axis (years): few enough to hold each against each
    pairs = df.select(F.col(value).alias("a")).join(F.broadcast(df.select(F.col(value).alias("b"))), b - a >= least)
    there, back = seeded_order(seed, a, b), seeded_order(seed, b, a)
    stays = F.conv(F.substring(seeded_order(f"{seed}|back", b, a), 1, 8), 16, 10).cast("double") < backward * 2**32
    draw = lambda x, y, r: F.struct(x.alias("a"), y.alias("b"), r.alias("r"))
    drawn = F.when(stays, F.array(draw(a, b, there), draw(b, a, back))).otherwise(F.array(draw(a, b, F.least(there, back))))
    first = pairs.select(F.explode(drawn).alias("x")).select("x.*").orderBy("r", "a", "b").limit(quota)
    return first.select("a", "b", F.row_number().over(Window.orderBy("r", "a", "b")).alias("place"))
