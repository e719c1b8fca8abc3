"""Filling containers of a fixed token capacity with texts of varying length.

Packing works on the histogram of lengths, so all that is solved on the driver is bounded by the
capacity, not by the number of texts:

1. Combinations of one or two lengths whose sum lies in a window under the capacity, and of three
   lengths that fill it, are enumerated among the lengths present.
2. Non-negative least squares finds how often each combination is to be repeated so that together
   they use up the histogram (accelerated projected gradient; a combination touches at most three
   lengths, so a step is a gather and a scatter).
3. Repeats are rounded and held to what is there; what remains is packed greedily, longest first,
   whole compositions at a time.

The plan then goes back to the rows. Every text gets its rank among those of its length from its
place in its partition and the counts of the partitions before it, so no length is gathered in one
task, and the rank leads to a slot of the plan. A text is divided only if it exceeds the capacity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoflow.llm.bpe import encoder
from chronoflow.plans.staging import Stage

#: Rows of the table of partition offsets up to which it is broadcast; beyond, it is joined by shuffle.
MAX_BROADCAST = 200_000


def combinations(present: np.ndarray, capacity: int, window: int) -> np.ndarray:
    """Rows of up to three lengths (0 = none): singles and pairs filling to within ``window``, triples filling exactly."""
    there = np.zeros(capacity + 1, bool)
    there[present] = True
    singles = present[present >= capacity - window]
    found = [np.stack([singles, np.zeros_like(singles), np.zeros_like(singles)], 1)]
    for total in range(capacity - window, capacity + 1):
        a = present[(present * 2 >= total) & (present < total)]
        b = total - a
        ok = there[b]
        found.append(np.stack([a[ok], b[ok], np.zeros(ok.sum(), int)], 1))
    for a in present[present * 3 >= capacity]:
        b = present[(present <= a) & (present * 2 >= capacity - a) & (present < capacity - a)]
        c = capacity - a - b
        ok = there[c]
        found.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(found).astype(np.int64) if found else np.zeros((0, 3), np.int64)


def nnls(combos: np.ndarray, histogram: np.ndarray, steps: int = 300) -> np.ndarray:
    """Repeats x >= 0 of least ||A x - histogram||, column j of A counting the lengths of combination j."""
    n = len(combos)
    if not n:
        return np.zeros(0)
    flat, size = combos.ravel(), len(histogram)
    filled = flat > 0

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.repeat(x, 3) * filled, size)

    def backward(r: np.ndarray) -> np.ndarray:
        return (r[flat] * filled).reshape(n, 3).sum(1)

    # step size: A's row and column sums bound its squared norm
    bound = backward(forward(np.ones(n))).max()
    x = z = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        step = np.maximum(z - backward(forward(z) - histogram) / bound, 0)
        nxt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = step + (t - 1) / nxt * (step - x)
        x, t = step, nxt
    return x


def plan(histogram: np.ndarray, capacity: int, window: int = 16) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of compositions that together hold the histogram exactly (index = length)."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    present = np.flatnonzero(left)
    out: list[tuple[tuple[int, ...], int]] = []
    if not len(present):
        return out
    combos = combinations(present, capacity, window)
    repeats = np.rint(nnls(combos, left.astype(float))).astype(np.int64)
    for j in sorted(np.flatnonzero(repeats).tolist(), key=lambda j: (-repeats[j], j)):
        lengths = tuple(int(v) for v in combos[j] if v)
        can = min(int(left[v]) // lengths.count(v) for v in set(lengths))
        if (k := min(can, int(repeats[j]))) > 0:
            out.append((lengths, k))
            for v in lengths:
                left[v] -= k
    # greedy: the longest left, then again and again the longest that fits; each round uses up a length
    sizes = np.flatnonzero(left).tolist()
    while sizes:
        space, lengths, i = capacity, [], len(sizes) - 1
        while i >= 0 and space:
            v = sizes[i]
            if (k := min(space // v, int(left[v]))) > 0:
                lengths += [v] * k
                space -= v * k
            i -= 1
        k = min(int(left[v]) // lengths.count(v) for v in set(lengths))
        out.append((tuple(lengths), k))
        for v in lengths:
            left[v] -= k
        sizes = [v for v in sizes if left[v]]
    return out


def slots(compositions: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The plan as sorted arrays: length and first rank of each run of slots, its first container and slots per container; and the number of containers."""
    rows, first = [], 0
    used: dict[int, int] = {}
    for lengths, k in compositions:
        for v in sorted(set(lengths)):
            per = lengths.count(v)
            rows.append((v, used.get(v, 0), first, per))
            used[v] = used.get(v, 0) + per * k
        first += k
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return a[:, 0], a[:, 1], a[:, 2], a[:, 3], first


def pack(df: DataFrame, key: str, text: str, path: str, capacity: int = 2048, window: int = 16) -> DataFrame:
    """One row per part of a text: ``key``, ``part``, ``tokens``, ``container``.

    Texts up to ``capacity`` tokens have one part; longer ones are divided into full parts and a
    rest. Null and empty texts have 0 tokens and are spread over the containers (all in container 0
    if there is no other). Repeated rows are placed once each. An empty table gives no rows. Other
    columns are not read.
    """
    spark = df.sparkSession
    stage = Stage(spark, "packing")
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x"))
    kind = narrow.schema["k"].dataType.simpleString()

    def measure(batches):
        own, seen = encoder(path), {}
        part_id = TaskContext.get().partitionId()
        for batch in batches:
            rows, part, size, place = [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                n = len(own.encode_packed(t)) >> 2 if t else 0
                full, rest = divmod(n, capacity)
                for p, s in enumerate([capacity] * full + ([rest] if rest or not n else [])):
                    rows.append(i)
                    part.append(p)
                    size.append(s)
                    place.append(seen.get(s, 0))
                    seen[s] = place[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(part, pa.int32()), pa.array(size, pa.int32()), pa.array([part_id] * len(rows), pa.int32()), pa.array(place, pa.int64())],
                ["k", "part", "tokens", "pid", "place"],
            )

    items = stage.write(narrow.mapInArrow(measure, f"k {kind}, part int, tokens int, pid int, place bigint"), "items")
    per = items.groupBy("tokens", "pid").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("tokens").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    per = stage.write(per.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "offsets")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in per.groupBy("tokens").agg(F.sum("n").alias("n")).toLocalIterator():  # at most capacity + 1 rows
        histogram[r.tokens] = r.n
    length, rank, first, each, containers = slots(plan(histogram, capacity, window))
    shift = int(histogram.max()) + 1
    starts = length * shift + rank

    def place(batches):
        for batch in batches:
            tokens = batch.column(2).to_numpy().astype(np.int64)
            ranks = batch.column(3).to_numpy()
            at = np.maximum(np.searchsorted(starts, tokens * shift + ranks, "right") - 1, 0)
            if containers:
                to = first[at] + (ranks - rank[at]) // each[at]
                to = np.where(tokens == 0, ranks % containers, to)
            else:
                to = np.zeros(len(tokens), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(to)], ["k", "part", "tokens", "container"])

    offsets = per.select("tokens", "pid", "before")
    if per.count() <= MAX_BROADCAST:
        offsets = F.broadcast(offsets)
    ranked = items.join(offsets, ["tokens", "pid"]).select("k", "part", "tokens", (F.col("before") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(place, f"k {kind}, part int, tokens int, container bigint").select(F.col("k").alias(key), "part", "tokens", "container")
