"""A capping state that is saved, loaded and goes on."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from chronoflow.llm.capping import CappedState, records

SCHEMA = "id bigint, who string, w double, kept string, c int"


def batch(seed, first, n=400):
    rnd = random.Random(seed)
    return [(first + i, rnd.choice(["hot"] * 5 + ["a", "b", None]), rnd.choice([None, float("nan"), 0.5, 1.0, rnd.random()]), None, 1) for i in range(n)]


def brute(rows, cap):
    by = {}
    for i, who, w, *_ in rows:
        if who is not None:
            by.setdefault(who, []).append((-(w if w is not None and w == w else float("-inf")), i))
    return {i for v in by.values() for _, i in sorted(v)[cap:]}


def frame(spark, rows):
    return records(spark.createDataFrame(rows, SCHEMA), F.col("who"), "w", "id").drop("a")


def test_two_sessions_equal_one(spark, tmp_path):
    parts = [batch(s, 1000 * s) for s in (1, 2, 3)]
    rows = [r for p in parts for r in p]
    whole = CappedState.open(spark, f"{tmp_path}/whole", 40)
    whole.absorb(frame(spark, rows))
    path = f"{tmp_path}/state"
    for n, part in enumerate(parts):
        state = CappedState.open(spark.newSession(), path, 40)
        assert state.version == n
        state.absorb(frame(spark, part))
        want = brute([r for p in parts[: n + 1] for r in p], 40)
        again = CappedState.open(spark.newSession(), path, 40)
        assert {r.t for r in again.displaced().collect()} == want
        assert again.displaced().count() == len(want)
    assert {tuple(r) for r in again.kept.select("c", "t").collect()} == {tuple(r) for r in whole.kept.select("c", "t").collect()}
    with pytest.raises(ValueError):
        CappedState.open(spark, path, 41)


def test_a_version_that_was_not_finished_does_not_count(spark, tmp_path):
    path = f"{tmp_path}/state"
    state = CappedState.open(spark, path, 40)
    state.absorb(frame(spark, batch(1, 0)))
    first = {r.t for r in state.displaced().collect()}
    state.absorb(frame(spark, batch(2, 1000)))
    shutil.rmtree(f"{path}/v000002/done")
    back = CappedState.open(spark, path, 40)
    assert back.version == 1 and {r.t for r in back.displaced().collect()} == first
    back.absorb(frame(spark, batch(2, 1000)))
    assert {r.t for r in back.displaced().collect()} == brute(batch(1, 0) + batch(2, 1000), 40)


def test_empty_batches(spark, tmp_path):
    state = CappedState.open(spark, f"{tmp_path}/state", 3)
    state.absorb(frame(spark, []))
    state.absorb(frame(spark, batch(1, 0, 30)))
    state.absorb(frame(spark, []))
    assert {r.t for r in state.displaced().collect()} == brute(batch(1, 0, 30), 3)
    assert sorted(os.listdir(f"{tmp_path}/state")) == ["v000001", "v000002", "v000003"]
