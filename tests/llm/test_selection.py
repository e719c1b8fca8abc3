"""Top N and capping against plain Python."""

import math
import random

from pyspark.sql import functions as F

from chronoflow.llm.capping import cap_contributors
from chronoflow.llm.topn import top_n

SCHEMA = "page bigint, sec string, id bigint, w double, g0 string, s string, t string, band int"


def rows(n=400, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        w = rnd.choice([0.1, 0.1, 0.2, 0.5, 0.5, 0.9, rnd.random(), None, math.nan, -1.0, math.inf])
        # half of all rows are in one group
        out.append((1 if i % 2 else rnd.randrange(9), rnd.choice(["a", "b", None]), i, w, "x", None, "y", 7))
    return out


def test_top_n(spark):
    data = rows()
    want = {}
    for p, s, i, w, *_ in data:
        if s is not None and w is not None and not math.isnan(w):
            want.setdefault((p, s), []).append((-w, i))
    want = {(p, s, i) for (p, s), v in want.items() for _, i in sorted(v)[:3]}
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert {tuple(r) for r in top_n(df, ["page", "sec"], "w", "id", 3).collect()} == want
    one = top_n(df, ["page", "sec"], "w", "id", 3, bands=())
    assert {tuple(r) for r in one.collect()} == want


def test_top_n_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert top_n(empty, ["page"], "w", "id").count() == 0
    assert top_n(spark.createDataFrame(rows(9), SCHEMA), ["page"], "w", "id", 0).count() == 0
    ties = spark.createDataFrame([(1, "a", i, 0.5, None, None, None, 0) for i in range(50)], SCHEMA)
    assert sorted(r.id for r in top_n(ties, ["page", "sec"], "w", "id", 3).collect()) == [0, 1, 2]


CAP = "c string, id bigint, w double, at timestamp, out boolean, part int"


def test_capping(spark):
    import datetime

    rnd = random.Random(5)
    data = []
    for i in range(600):
        c = rnd.choice(["A", "a ", " a", "B", "c", None, " ", ""]) if i % 3 else "A"
        at = None if i % 17 == 0 else datetime.datetime(2025, 1, 1) + datetime.timedelta(minutes=rnd.randrange(9000))
        data.append((c, i, rnd.choice([0.1, 0.2, 0.2, rnd.random(), None, math.nan]), at, None, 1))
    by = {}
    for c, i, w, *_ in data:
        key = (c or "").strip().lower()
        if key:
            by.setdefault(key, []).append((math.inf if w is None or math.isnan(w) else -w, i))
    df = spark.createDataFrame(data, CAP)
    name = F.lower(F.trim("c"))
    name = F.when(name != "", name)
    for cap in (1, 20, 10_000, 0):
        want = {i for v in by.values() for _, i in sorted(v)[cap:]}
        for batches in (1, 4):
            state = cap_contributors(df, name, "w", "id", cap, "at", batches)
            log = state.displaced()
            got = [r.t for r in log.collect()]
            assert sorted(got) == sorted(want), (cap, batches)
            assert state.kept.count() == sum(map(len, by.values())) - len(want)


def test_capping_empty(spark):
    state = cap_contributors(spark.createDataFrame([], CAP), F.col("c"), "w", "id", 3, "at")
    assert state.kept.count() == 0
    assert state.displaced().count() == 0
