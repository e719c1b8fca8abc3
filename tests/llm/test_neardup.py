"""Near duplicates against all pairs of a small fixture."""

import random
import re

import regex

from chronoflow.llm.neardup import month_day, near_duplicates

SCHEMA = "id bigint, text string, date string, n int, v string, a bigint, node string"


def brute(rows):
    sets = {i: frozenset(w.lower() for w in regex.findall(r"[\p{L}\p{N}]+", t or "")) for i, t, *_ in rows}
    months = "jan feb mar apr may jun jul aug sep oct nov dec".split()
    day = {}
    for i, _, d, *_ in rows:
        m, n = re.search("|".join(months), (d or "").lower()), re.search(r"\d+", d or "")
        day[i] = (m.group(), int(n.group())) if m and n else None
    ids = sorted(i for i in sets if sets[i])
    out = set()
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            o = len(sets[a] & sets[b])
            if o * 5 >= 4 * (len(sets[a]) + len(sets[b]) - o) and not (day[a] and day[b] and day[a] != day[b]):
                out.add((a, b))
    return out


def fixture():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "Łódź", "Мянап", "½"]
    rows, i = [], 0
    for size in [1, 1, 2, 3, 4, 5, 6, 9, 14, 22, 40, 60, 64, 66, 70, 79, 80, 81, 100, 300] * 4:
        words = rnd.sample(vocabulary, size)
        for _ in range(rnd.randrange(1, 6)):
            edited = list(words)
            for _ in range(rnd.randrange(0, max(1, size // 7) + 1)):
                edited[rnd.randrange(size)] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                rnd.shuffle(edited)
            if rnd.random() < 0.3:
                edited = edited + rnd.sample(vocabulary, max(1, size // 9))
            rows.append((i, rnd.choice([" ", ", ", "-"]).join(edited).title(), rnd.choice([None, "3 May", "May 3–5", "3rd of May", "May", "June 3", " May. 3 "]), 1, "x", None, None))
            i += 1
    rows += [(i + k, t, None, 1, None, None, None) for k, t in enumerate([None, "", "  ", "...", "same", "Same!", "SAME", "x" * 5000])]
    return rows


def test_pairs_and_groups(spark):
    rows = fixture()
    want = brute(rows)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA), "id", "text", "date")
    got = [tuple(r) for r in found.pairs().collect()]
    assert len(got) == len(set(got))
    assert set(got) == want
    parent = {}

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in want:
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    groups = {r.id: r.group for r in found.groups().collect()}
    assert groups == {i: top(i) for i in groups}


def test_empty(spark):
    found = near_duplicates(spark.createDataFrame([], SCHEMA), "id", "text", "date")
    assert found.pairs().count() == 0 and found.groups().count() == 0


def test_days(spark):
    cases = {"January 20": (1, 20), "20 January": (1, 20), " Mar. 4 ": (3, 4), "2nd of April": (4, 2), "July 30–31": (7, 30), "July 30 - August 2": (7, 30), "2–5 March": (3, 2), "June": None, "Spring": None, "c. harvest": None, "": None, None: None, "May 45": None, "2024-02-29": (2, 29)}
    df = spark.createDataFrame([(k, i) for i, k in enumerate(cases)], "d string, i int").select("i", month_day(df_col("d")).alias("m"))
    got = {r.i: r.m for r in df.collect()}
    for i, v in enumerate(cases.values()):
        assert got[i] == (None if v is None else v[0] * 32 + v[1]), list(cases)[i]


def df_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_split_lists_and_copies(spark, monkeypatch):
    """Lists and sets of copies in blocks of three give the same pairs, each once."""
    from chronoflow.llm import neardup

    monkeypatch.setattr(neardup, "HOT", 3)
    rows = fixture()
    i = len(rows)
    rare = [f"rare{k}" for k in range(20)]
    rows += [(i + k, " ".join(rare[:18] + [f"x{k % 14}"]), None, 1, None, None, None) for k in range(40)]
    want = brute(rows)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA), "id", "text", "date")
    got = [tuple(r) for r in found.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == want
    members = {r.id: r.node for r in found.members().collect()}
    links = {(r.a, r.b) for r in found.links.collect()}
    ids = sorted(members)
    said = {(x, y) for n, x in enumerate(ids) for y in ids[n + 1 :] if members[x] == members[y] or (min(members[x], members[y]), max(members[x], members[y])) in links}
    assert said == want


def test_merged_sketches_dismiss_no_pair():
    """The words in which two texts of similarity t differ bound what differs in their merged sketch."""
    rnd = random.Random(3)
    for _ in range(2000):
        n = rnd.randrange(1, 200)
        a = rnd.sample(range(10**6), n)
        b = set(a[: rnd.randrange(int(n * 0.7), n + 1)]) | set(rnd.sample(range(10**6), rnd.randrange(0, n // 8 + 1)))
        a = set(a)
        if b and len(a & b) >= 0.8 * len(a | b):
            merged = set(sorted(a | b)[:32])
            assert len(merged - (a & b)) <= (len(a) + len(b)) * 0.2 / 1.8 + 1e-9
