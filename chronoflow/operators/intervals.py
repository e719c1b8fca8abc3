"""Continuous periods and gaps from overlapping integer intervals, by dyadic blocks.

Every closed interval is cut into canonical dyadic blocks ``[i * 2^k, (i + 1) * 2^k)``. Two dyadic
blocks are nested or disjoint, so coverage is a question of ancestors, and union is a matter of
replacing two present siblings by their parent, level by level. What is left is coalesced where
blocks touch.

Blocks are keyed by a segment of ``2^SEGMENT`` years, which bounds every group a task sees: a
segment holds at most ``2^(SEGMENT + 1)`` distinct blocks however many rows an entity has. Rows are
made distinct map-side before the only big shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Years per segment as a power of two.
SEGMENT = 13
#: Shift that makes every 32-bit year non-negative; a multiple of the segment length.
OFFSET = 1 << 32


def dyadic_blocks(start: Column, end: Column) -> Column:
    """Canonical blocks of the closed interval [start, end]: array<struct<k int, i bigint>>.

    At level k the interval spans the whole blocks ceil(a / 2^k) to floor(b / 2^k) - 1 (b exclusive);
    the left one is canonical if its index is odd, the right one if its bound is. The top level keeps
    all that is left.
    """
    a, b = start.cast("bigint") + F.lit(OFFSET), end.cast("bigint") + F.lit(OFFSET + 1)

    def bounds(k: int) -> tuple[Column, Column]:
        return F.shiftright(a + F.lit((1 << k) - 1), k), F.shiftright(b, k)

    levels = []
    for k in range(SEGMENT):
        lo, hi = bounds(k)
        block = lambda i, k=k: F.struct(F.lit(k).alias("k"), i.cast("bigint").alias("i"))
        levels += [
            F.when((lo < hi) & (lo.bitwiseAND(F.lit(1)) == 1), block(lo)),
            F.when((lo < hi) & (hi.bitwiseAND(F.lit(1)) == 1), block(hi - 1)),
        ]
    lo, hi = bounds(SEGMENT)
    top = F.when(lo < hi, F.transform(F.sequence(lo, hi - 1), lambda i: F.struct(F.lit(SEGMENT).alias("k"), i.cast("bigint").alias("i"))))
    return F.concat(F.array_compact(F.array(*levels)), F.coalesce(top, F.array().cast("array<struct<k:int,i:bigint>>")))


def merge_intervals(intervals: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Periods and gaps per entity: ``keys``, ``what`` (period, gap), ``year_from``, ``year_to``.

    Rows with a null key, a null bound or an end before the start are ignored; repeated rows count
    once; an empty input gives no rows; other columns are not read.
    """
    own = [f"__k{n}" for n in range(len(keys))]
    valid = intervals.select(
        *(F.col(f"`{k}`").alias(o) for k, o in zip(keys, own)), F.col(f"`{start}`").cast("int").alias("__s"), F.col(f"`{end}`").cast("int").alias("__e")
    ).where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*own, "__s", "__e")]) & (F.col("__s") <= F.col("__e")))
    blocks = (
        valid.select(*own, F.explode(dyadic_blocks(F.col("__s"), F.col("__e"))).alias("b"))
        .select(*own, F.expr(f"shiftright(b.i, {SEGMENT} - b.k)").alias("__seg"), F.col("b.k").alias("k"), F.col("b.i").alias("i"))
        .distinct()
    )
    # one exchange by segment; everything down to the coalescing runs in its partitions
    blocks = blocks.repartition(*own, "__seg")
    blocks = blocks.withColumn("lo", F.expr("shiftleft(i, k)")).withColumn("hi", F.expr("shiftleft(i + 1, k)"))
    before = Window.partitionBy(*own, "__seg").orderBy("lo", F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    kept = blocks.withColumn("__reach", F.max("hi").over(before)).where(F.col("__reach").isNull() | (F.col("__reach") < F.col("hi")))
    kept = kept.select(*own, "__seg", "k", "i")
    for level in range(SEGMENT):
        here = F.col("k") == level
        kept = (
            kept.groupBy(*own, "__seg", "k", F.when(here, F.shiftright("i", 1)).otherwise(F.col("i")).alias("up"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("i"))
            .select(*own, "__seg", F.when(F.col("n") == 2, F.lit(level + 1)).otherwise(F.col("k")).alias("k"), F.when(F.col("n") == 2, F.col("up")).otherwise(F.col("i")).alias("i"))
        )
    spans = kept.select(*own, F.expr("shiftleft(i, k)").alias("lo"), F.expr("shiftleft(i + 1, k)").alias("hi"))
    by = Window.partitionBy(*own).orderBy("lo")
    runs = (
        spans.withColumn("__new", F.coalesce((F.lag("hi").over(by) < F.col("lo")).cast("int"), F.lit(1)))
        .withColumn("__run", F.sum("__new").over(by))
        .groupBy(*own, "__run")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .withColumn("__next", F.lead("lo").over(by))
    )
    year = lambda c: (c - F.lit(OFFSET)).cast("int")
    row = lambda what, x, y: F.struct(F.lit(what).alias("what"), year(x).alias("year_from"), year(y).alias("year_to"))
    both = F.array_compact(F.array(row("period", F.col("lo"), F.col("hi") - 1), F.when(F.col("__next").isNotNull(), row("gap", F.col("hi"), F.col("__next") - 1))))
    return runs.select(*own, F.inline(both)).select(*(F.col(o).alias(k) for k, o in zip(keys, own)), "what", "year_from", "year_to")
