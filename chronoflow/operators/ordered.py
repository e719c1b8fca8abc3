"""Operators that depend on order: neighbours, islands, carried state, transitions, resetting folds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbours(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Previous and next key among the rows of each group."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("prev", F.lag(order).over(w)).withColumn("next", F.lead(order).over(w))


def islands(df: DataFrame, by: list[str], at: str) -> DataFrame:
    """Runs of consecutive integers: ``by``, first, last, n. Repeats and nulls count once or not at all."""
    w = Window.partitionBy(*by).orderBy(at)
    rows = df.select(*by, at).where(F.col(at).isNotNull()).distinct()
    return rows.withColumn("island", F.col(at) - F.row_number().over(w)).groupBy(*by, "island").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n")).drop("island")


def carried(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The last value that was not null up to each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def order_violations(df: DataFrame, by: list[str], order: str, key: str) -> DataFrame:
    """Rows whose key is under that of the row before."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("before", F.lag(key).over(w)).where(F.col("before") > F.col(key))


def packed_paragraphs(df: DataFrame, by: list[str], order: str, text: str, room: int) -> DataFrame:
    """``by``, place, paragraph: texts of a group joined in order into paragraphs, each ended as soon as it holds ``room`` characters.

    Rows are sorted by group and order within partitions and folded as they stream by: only the open
    paragraph is held, however many rows a group has. Null keys are one group; null texts are left out.
    """
    keys = [f"k{n}" for n in range(len(by))]
    rows = df.where(F.col(text).isNotNull()).select(*(F.col(b).alias(k) for b, k in zip(by, keys)), F.col(order).alias("o"), F.col(text).alias("x"))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "o", "x")

    def run(batches):
        own, place, parts, size = None, 0, [], 0
        schema = None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in range(len(keys))]
            schema = schema or pa.schema([*(batch.schema.field(n) for n in range(len(keys))), ("place", pa.int32()), ("paragraph", pa.string())])
            out = []
            for *key, x in zip(*columns, batch.column(len(keys) + 1).to_pylist()):
                if key != own:
                    if parts:
                        out.append((*own, place, " ".join(parts)))
                    own, place, parts, size = key, 0, [], 0
                if x == "" and not parts:
                    continue
                parts.append(x)
                size += len(x) + (len(parts) > 1)
                if size >= room:
                    out.append((*own, place, " ".join(parts)))
                    place, parts, size = place + 1, [], 0
            yield _batch(out, schema)
        if parts:
            yield _batch([(*own, place, " ".join(parts))], schema)

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    done = rows.mapInArrow(run, f"{kinds}, place int, paragraph string")
    return done.select(*(F.col(k).alias(b) for b, k in zip(by, keys)), "place", "paragraph")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], f.type) for n, f in enumerate(schema)], schema=schema)

