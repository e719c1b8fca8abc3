"""Top N rows of every group by descending score bands.

The rows, narrowed to group, score and tie-break, are written once into score bands. Bands are then
processed from the top: groups already filled are anti-joined away, the rest take from the band what
they still need. Most groups are filled by the first bands, so the long tail of rows is read once
and dropped by a join on groups. Ties are settled in the band by (score desc, id asc).

A group never lands whole in a task: ``row_number() <= n`` is pushed below the exchange as a group
limit, so each map task sends at most ``n`` rows per group, however hot the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoflow.plans.staging import Stage

#: Shares of the rows above each inner band edge, from the top.
BANDS = (0.1, 0.25, 0.5)


def top_n(df: DataFrame, groups: list[str], score: str, tie: str, n: int = 3, bands: tuple[float, ...] = BANDS) -> DataFrame:
    """``groups`` + ``tie`` of the first ``n`` rows per group by ``score`` desc, then ``tie`` asc.

    Rows with a null group value, a null tie or a score that is null or NaN take no part. Repeated
    rows count once each; if ``tie`` itself is repeated with the same score the copies are
    interchangeable. An empty input, or n <= 0, gives no rows. Other columns are not read, whatever
    their names.
    """
    keys = [f"g{i}" for i in range(len(groups))]
    narrow = df.select(*(F.col(f"`{g}`").alias(k) for g, k in zip(groups, keys)), F.col(f"`{score}`").cast("double").alias("s"), F.col(f"`{tie}`").alias("t"))
    narrow = narrow.where(F.col("s").isNotNull() & ~F.isnan("s") & F.col("t").isNotNull())
    for k in keys:
        narrow = narrow.where(F.col(k).isNotNull())
    out = [F.col(k).alias(g) for g, k in zip(groups, keys)] + [F.col("t").alias(tie)]
    if n <= 0:
        return narrow.where(F.lit(False)).select(*out)
    # edges of the bands from a quantile sketch over all rows: a few numbers
    edges = narrow.select(F.percentile_approx("s", [1 - b for b in bands], 200)).first()[0] if bands else None
    edges = sorted({*(edges or ())}, reverse=True)
    stage = Stage(df.sparkSession, "topn")
    band = F.lit(0)
    for e in edges:
        band = band + (F.col("s") < F.lit(e)).cast("int")
    banded = stage.write(narrow.withColumn("band", band), "bands", ["band"])
    kept_path, taken = [], None
    rank = Window.partitionBy(*keys).orderBy(F.desc("s"), F.asc("t"))
    for b in range(len(edges) + 1):
        rows = banded.where(F.col("band") == b).drop("band")
        if taken is not None:
            rows = rows.join(taken.where(F.col("have") >= n).select(*keys), keys, "left_anti")
        rows = rows.withColumn("rn", F.row_number().over(rank)).where(F.col("rn") <= n)
        if taken is not None:
            rows = rows.join(taken, keys, "left").where(F.col("rn") <= F.lit(n) - F.coalesce("have", F.lit(0)))
        path = stage.write_path(rows.select(*keys, "t"), "kept")
        kept_path.append(path)
        kept = df.sparkSession.read.schema(rows.select(*keys, "t").schema).parquet(*kept_path)
        taken = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("have"))
    return kept.select(*out)
