"""Classification by prototype vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify(df: DataFrame, key: str, vector: str, prototypes: list[tuple[int, list[float]]]) -> DataFrame:
    """``key``, ``theme`` and ``similarity``: the theme whose best prototype has the highest cosine.

    The prototypes are a small stated set; all rows are held against them in batches, one matrix
    product each. Ties go to the lower theme. A null or zero vector has no theme.
    """
    if not prototypes:  # nothing to be near to
        return df.select(key, F.lit(None).cast("int").alias("theme"), F.lit(None).cast("double").alias("similarity"))
    themes = np.array([t for t, _ in prototypes])
    matrix = np.array([v for _, v in prototypes], np.float64)
    matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    order = sorted(set(themes.tolist()))
    narrow = df.select(F.col(key).alias("k"), F.col(vector).alias("v"))

    def run(batches):
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            good = [i for i, v in enumerate(vectors) if v and any(v)]
            best, score = [None] * len(vectors), [None] * len(vectors)
            if good:
                x = np.array([vectors[i] for i in good], np.float64)
                sims = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ matrix.T
                per = np.stack([sims[:, themes == t].max(1) for t in order], 1)
                for i, j, s in zip(good, per.argmax(1), per.max(1)):
                    best[i], score[i] = order[j], round(float(s), 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array(score, pa.float64())], ["k", "theme", "similarity"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, theme int, similarity double").withColumnRenamed("k", key)
