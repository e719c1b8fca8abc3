"""Queries over their whole job, on small tables and against plain Python."""

import hashlib
import random
from collections import Counter

from chronoflow.queries import corpus, search, selection


def published(spark, folder, schema, rows):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/published.parquet")
    return str(folder)


def test_every_cited_number_counts(spark, tmp_path):
    d = published(spark, tmp_path, "row_id bigint, text string", [(1, "[1] a [2] b [3] c [4] d [5][4]"), (2, "none"), (3, None), (4, "1234567 and 21")])
    got = sorted((r.answer, r.passage) for r in search.QUERIES["q11_cited"](spark, d).collect())
    assert got == [(1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (4, 2)]


def test_pairs_of_any_distance_and_direction(spark, tmp_path):
    years = [-570, -40, 3, 8, *range(1000, 2000, 37)]
    d = published(spark, tmp_path, "year int", [(y,) for y in [*years, *years, None]])
    md5 = lambda *x: hashlib.md5("|".join(map(str, x)).encode()).hexdigest()
    first = {}
    for a in years:
        for b in years:
            if abs(a - b) >= 5:
                turned = a > b and int(md5("s3", "back", a, b)[:8], 16) >= 0.2 * 2**32
                pair = (b, a) if turned else (a, b)
                first[pair] = min(md5("s3", a, b), first.get(pair, "g"))
    want = sorted(first, key=lambda p: (first[p], p))[:150]
    got = [(r.a, r.b) for r in selection.QUERIES["t13_pairs"](spark, d).orderBy("place").collect()]
    assert got == want and len(set(got)) == 150
    assert max(b - a for a, b in got) > 60 and 0 < sum(a > b for a, b in got) < 40


def first_repetition(text):
    """The first n-gram filter that fails, by brute force."""
    w = text.split()
    total = sum(map(len, w))
    for n, most in ((2, 0.20), (3, 0.18), (4, 0.16)):
        grams = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        top, count = max(grams.items(), key=lambda x: (x[1], len("".join(x[0]))))
        if count > 1 and round(len("".join(top)) * count / total, 6) > most:
            return f"top_{n}"
    for n, most in ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10)):
        seen, chars, i = [], 0, 0
        while i + n <= len(w):
            repeated = w[i : i + n] in seen
            chars += len("".join(w[i : i + n])) * repeated
            seen += [] if repeated else [w[i : i + n]]
            i += n if repeated else 1
        if round(chars / total, 6) > most:
            return f"repeated_{n}"
    return "pass"


def test_cascade_with_repetition_and_block_list(spark, tmp_path):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(3, 8)))
    texts = []
    for size, copies in ((2, 40), (3, 20), (4, 15), (8, 3), (6, 6), (12, 2), (30, 2), (0, 0), (0, 0)):
        block = [word() for _ in range(size)]
        parts = [block] * copies + [[word(), word(), "the", word(), "of", word() + "."] for _ in range(30)]
        rnd.shuffle(parts)
        texts.append(" ".join(w for p in parts for w in p))
    rows = [(i, x, "en", "a.example", "k") for i, x in enumerate(texts)]
    want = {i: first_repetition(x) for i, x in enumerate(texts)}
    assert len(set(want.values())) > 3 and "pass" in want.values()
    again = "to be here and there again. " * 20
    rows += [(20, again, "de", "a.example", "k"), (21, again, "en", "B.Invalid", "k"), (22, " ", "en", "b.invalid", "k"), (23, "a line\n" * 9, "en", "a.example", "k"), (24, "so it is so it is", "en", None, "k")]
    want |= {20: "language", 21: "url", 22: "empty", 23: "duplicate_lines", 24: "top_2"}
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kind string").write.parquet(f"{tmp_path}/documents.parquet")
    d, q = str(tmp_path), corpus.QUERIES
    assert {r.doc_id: r.verdict for r in q["g01_verdicts"](spark, d).collect()} == want
    assert {r.verdict: r.n for r in q["a21_failure_codes"](spark, d).collect()} == Counter(want.values())
    rate = q["a21_pass_rates"](spark, d).first()
    assert (rate.n, rate.rate, rate.some_fail) == (len(want), round(list(want.values()).count("pass") / len(want), 6), True)
