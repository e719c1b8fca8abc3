"""Periods and gaps against sets of years."""

import random

from chronoflow.operators.intervals import merge_intervals

SCHEMA = "e string, o string, s int, t int, what string, k int"


def runs(years):
    years = sorted(years)
    out, start = [], None
    for i, y in enumerate(years):
        start = y if start is None else start
        if i + 1 == len(years) or years[i + 1] != y + 1:
            out.append(("period", start, y))
            if i + 1 < len(years):
                out.append(("gap", y + 1, years[i + 1] - 1))
            start = None
    return out


def test_against_sets(spark):
    rnd = random.Random(3)
    rows = []
    for e in range(30):
        for _ in range(rnd.randrange(1, 25)):
            s = rnd.randrange(-9000, 9000) if e % 3 else rnd.randrange(-20, 20)
            rows.append((f"e{e}", "o", s, s + rnd.choice([0, 0, 1, 2, 5, 40, 700, 9000]), "x", 1))
    rows += rows[:20]
    want = {}
    for e, o, s, t, *_ in rows:
        want.setdefault((e, o), set()).update(range(s, t + 1))
    got = {}
    for r in merge_intervals(spark.createDataFrame(rows, SCHEMA), ["e", "o"], "s", "t").collect():
        got.setdefault((r.e, r.o), set()).add((r.what, r.year_from, r.year_to))
    assert got == {k: set(runs(v)) for k, v in want.items()}


def test_nulls_and_inverted(spark):
    rows = [("a", "o", None, 3, None, 1), ("a", "o", 5, None, None, 1), ("a", "o", 9, 3, None, 1), (None, "o", 1, 2, None, 1), ("b", None, 1, 2, None, 1), ("c", "o", 0, 0, None, 1), ("c", "o", -1, -1, None, 1)]
    got = [tuple(r) for r in merge_intervals(spark.createDataFrame(rows, SCHEMA), ["e", "o"], "s", "t").collect()]
    assert got == [("c", "o", "period", -1, 0)]


def test_empty_and_extremes(spark):
    assert merge_intervals(spark.createDataFrame([], SCHEMA), ["e"], "s", "t").count() == 0
    rows = [("a", "o", 2**31 - 1, 2**31 - 1, None, 1), ("a", "o", -(2**31), -(2**31), None, 1)]
    got = {tuple(r) for r in merge_intervals(spark.createDataFrame(rows, SCHEMA), ["e"], "s", "t").collect()}
    assert got == {("a", "period", -(2**31), -(2**31)), ("a", "gap", -(2**31) + 1, 2**31 - 2), ("a", "period", 2**31 - 1, 2**31 - 1)}
