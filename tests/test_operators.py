"""Operators on small fixtures, against plain Python where it is short."""

import datetime
import random

from pyspark.sql import functions as F

from chronoflow.functions import text as X
from chronoflow.functions import timeaxis as T
from chronoflow.operators import aggregates as A
from chronoflow.operators import corpus_filters as G
from chronoflow.operators import gates as V
from chronoflow.operators import joins as J
from chronoflow.operators import ordered as O
from chronoflow.operators import selection as S
from chronoflow.operators import benchmark
from chronoflow.operators.benchmark import score_names
from chronoflow.operators.vectors import classify


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_years(spark):
    rows = spark.createDataFrame([(y,) for y in (1900, 2000, 1, 0, -43, -99, -100)], "y int")
    got = {r.y: (r.c, r.s, r.d, r.l) for r in rows.select("y", T.century(F.col("y")).alias("c"), T.strict_century(F.col("y")).alias("s"), T.decade(F.col("y")).alias("d"), T.decade_label(T.decade(F.col("y"))).alias("l")).collect()}
    assert got[1900] == (20, 19, 1900, "1900s") and got[2000][1] == 20
    assert got[0] == (-1, -1, -10, "0s BC") and got[-43] == (-1, -1, -50, "40s BC") and got[-99] == (-2, -1, -110, "100s BC")
    assert one(spark, T.year_of(F.lit("490BC")), T.year_of(F.lit("0")), T.year_of(F.lit("AD 12")), T.year_of(F.lit("x")))[:] == (-489, None, 12, None)
    julian = one(spark, T.to_julian(F.lit(1582), F.lit(10), F.lit(15)).alias("j")).j
    assert (julian.year, julian.month, julian.day) == (1582, 10, 5)
    assert one(spark, T.day_distance(F.lit(12), F.lit(31), F.lit(1), F.lit(1)).alias("d")).d == 1


def test_spans(spark):
    """What is no range has no days: its single day is told by parse_date."""
    cases = {
        "October 24-29": 6, "December 30 - January 2": 4, "February 28 - March 1": 3, "May 1—2": 2, "July 30 - August 13": 15, "November 5 - 11,000 scientists": 0, "February 10 - 17th Congress": 0, "August 13-29": 0, "July 30 - August 14": 0,
        "June": 0, None: 0, "February 30": 0, "June 5": 0, "June 9-5": 0, "June 28-31": 0, "May 5 - May 3": 0,
    }
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, d string").select("i", F.size(T.span_days(F.col("d"))).alias("n")).collect()
    for r, want in zip(sorted(rows), cases.values()):
        assert r.n == want, list(cases)[r.i]


def test_text(spark):
    row = one(spark, X.slugify(F.lit("Łódź & Żary: Été  (1939)")), X.norm(F.lit("Été—1939!")), X.as_sentence(F.lit("; and so it ends:")), X.trim_to(F.lit("word " * 60), 20))
    assert row[0] == "odz-and-zary-ete-1939" and row[1] == "ete 1939" and row[2] == "And so it ends." and row[3] == "word word word…"
    words = {"fell": "fall", "landed": "land", "cities": "city", "buildings": "build", "as": "as", "gas": "gas"}
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", X.stem(F.col("w")).alias("s"))
    assert {r.w: r.s for r in df.collect()} == words
    tokens = one(spark, X.index_tokens(F.lit("The kings of Apollo 11 at V2 pass kings")).alias("t")).t
    assert sorted(tokens) == ["11", "apollo", "king", "kings", "pass", "v2"]


def test_as_of(spark):
    rnd = random.Random(2)
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=n)
    left = [(i, rnd.randrange(4), day(rnd.randrange(200))) for i in range(80)]
    right = [(rnd.randrange(4), day(rnd.randrange(200)), i) for i in range(60)]
    l, r = spark.createDataFrame(left, "i int, k int, at timestamp"), spark.createDataFrame(right, "k int, at timestamp, v int")  # noqa: E741
    for forward in (False, True):
        got = {x.i: (x.as_of, x.v) for x in J.as_of(l, r, ["k"], "at", ["v"], forward=forward).collect()}
        for i, k, at in left:
            near = [(a, v) for kk, a, v in right if kk == k and (a >= at if forward else a <= at)]
            want = (min(near, key=lambda x: (x[0], -x[1])) if forward else max(near)) if near else (None, None)
            assert got[i] == want
    assert J.as_of(l.limit(0), r, ["k"], "at", ["v"]).count() == 0
    assert J.as_of(l, r.limit(0), ["k"], "at", ["v"]).where("v is null").count() == 80


def test_overlapping(spark):
    rnd = random.Random(5)
    span = lambda: (lambda s: (s, s + rnd.choice([0, 1, 9, 70, 300])))(rnd.randrange(-200, 500))
    a, b = [(i, rnd.randrange(2), *span()) for i in range(60)], [(i, rnd.randrange(2), *span()) for i in range(60)]
    got = [(r.i, r.j) for r in J.overlapping(spark.createDataFrame(a, "i int, k int, s int, e int"), spark.createDataFrame(b, "j int, k int, x int, y int"), ["k"], ("s", "e"), ("x", "y"), 32).collect()]
    want = {(i, j) for i, k, s, e in a for j, m, x, y in b if k == m and s <= y and x <= e}
    assert len(got) == len(set(got)) and set(got) == want


def test_agreement_and_cross_check(spark):
    a, b = spark.createDataFrame([(1, 2.0), (2, None), (3, 1.0), (5, 1.0)], "k int, v double"), spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0), (4, 1.0)], "k int, v double")
    assert {r.k: r.status for r in J.agreement(a, b, ["k"], "v").collect()} == {1: "same", 2: "same", 3: "different", 4: "only right", 5: "only left"}
    row = A.cross_check(a.where("v is not null"), b.where("v is not null"), "k", "v", 0.5).first()
    assert (row.n, row.max_diff, row.worst, row.beyond, row.passed) == (2, 3.0, 3, 1, False)
    assert A.cross_check(a.limit(0), b, "k", "v", 1).first().passed is False


def test_ordered(spark):
    rows = spark.createDataFrame([("a", y) for y in (1, 2, 2, 3, 7, 9, 10, None)], "k string, y int")
    assert sorted((r.first, r.last, r.n) for r in O.islands(rows, ["k"], "y").collect()) == [(1, 3, 3), (7, 7, 1), (9, 10, 2)]
    p = spark.createDataFrame([(1, i, "x" * n) for i, n in enumerate((3, 4, 9, 1, 1))], "k int, i int, t string")
    assert [len(r.paragraph) for r in O.packed_paragraphs(p, ["k"], "i", "t", 8).orderBy("place").collect()] == [8, 9, 3]


def test_selection(spark):
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 3), (2, 20), (3, 8)) for i in range(n)], "k int, i int")
    got = {}
    for r in S.even_spread(rows, ["k"], ["i"], 8).collect():
        got.setdefault(r.k, []).append(r.i)
    assert sorted(got[1]) == [0, 1, 2] and sorted(got[2]) == [int(x * 20 / 8) for x in range(8)] and len(got[3]) == 8
    parties = spark.createDataFrame([("s", "big", i) for i in range(9)] + [("s", "small", 100), ("s", "mid", 50), ("s", "mid", 51)], "s string, p string, i int")
    first = [r.p for r in S.breadth_first(parties, ["s"], "p", [F.asc("i")], 5).orderBy("place").collect()]
    assert sorted(first[:3]) == ["big", "mid", "small"] and sorted(first[3:]) == ["big", "mid"]


def test_filters(spark):
    rows = spark.createDataFrame([(1, "en", "the man and the dog have been with us. " * 12), (2, "en", None), (3, "de", "x"), (4, "en", "the people and that house of stone stand here. " * 12 + "{"), (5, "en", "word\n" * 80)], "id int, lang string, text string")
    got = {r.id: r.verdict for r in G.verdicts(rows, "text").select("id", "verdict").collect()}
    assert got == {1: "pass", 2: "empty", 3: "language", 4: "brace", 5: "duplicate_lines"}
    rep = {r.id: r for r in G.repetition(rows, "id", "text").collect()}
    assert rep[1].repeated_5 > 0.15 and rep[3].verdict == "pass" and rep[2].top_2 == 0


def test_gates(spark):
    rows = spark.createDataFrame([(i, "x" * i) for i in range(10)], "id bigint, t string")
    failures = V.gate(rows, "g", "id", {"short": F.length("t") < 7, "empty": F.col("t") == "", "never": F.lit(None).cast("boolean")})
    got = {r["class"]: (r.n, r.examples) for r in V.report(failures, 3).collect()}
    assert got == {"short": (7, "0,1,2"), "empty": (1, "0")}
    n = failures.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    base = spark.createDataFrame([("short", 9), ("old", 1)], "class string, n bigint")
    assert {r["class"]: r.verdict for r in V.ratchet(n, base).collect()} == {"short": "better", "empty": "worse", "old": "better"}


def test_classify(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0])], "id int, v array<float>")
    got = {r.id: r.theme for r in classify(rows, "id", "v", [(7, [1.0, 0.0]), (9, [0.0, 1.0]), (9, [-1.0, 0.0])]).collect()}
    assert got == {1: 7, 2: 9, 3: None, 4: None}
    assert {r.theme for r in classify(rows, "id", "v", []).collect()} == {None}


def test_names(spark):
    cases = [
        ("Louis XVIII", "It was Louis 18th", "regnal"), ("Louis XVIII", "Louis XVI", "none"), ("Ilham Aliyev", "Heydar Aliyev", "none"), ("Ilham Aliyev", "President Ilham Aliyev", "surname"), ("Ismail Fahmi", "Ismail Fahmy", "near surname"), (None, "x", "none"), ("A", "", "none"),
        ("Umberto I", "Humbert 1st", "regnal"), ("Carlos III", "Charles the 3rd", "regnal"), ("Ahmad I Al-Jaber Al-Sabah", "Ahmed Al-Jaber Al-Sabah", "surname"), ("Alexandru II Ghica", "Alexandru III Ghica", "none"), ("Müller", "Ms. Mueller", "near surname"), ("Weiß", "Mr Weiss", "surname"),
        ("Mobutu Sese Seko", "Mobutu", "first of several"), ("Omar Hassan Ahmad", "Umar of Hasan", "none"), ("Omar Bongo Ondimba", "Umar Bongo", "two parts"), ("José de la Mar", "General de la Mar", "surname"), ("Sa’id Lamu", "Saeed Lamu", "surname"), ("Og", "Og", "none"), ("of the", "of the", "none"),
    ]
    rows = spark.createDataFrame([(i, *c[:2], 1) for i, c in enumerate(cases)], "i int, gold string, said string, g int")
    got = {r.i: r.rule for r in score_names(rows, "gold", "said").collect()}
    assert [(c, got[i]) for i, c in enumerate(cases) if got[i] != c[2]] == []
    assert {r.rule for r in score_names(rows.where("i = 4"), "gold", "said", near=False).collect()} == {"none"}
    assert score_names(rows.limit(0), "gold", "said").columns == ["i", "gold", "said", "g", "rule"]


def test_titles_and_amounts(spark):
    titles = [("Rolling (Live)", '"Rolling" by Someone', True), ("Rolling", "Rolling - Someone", True), ("Medley: A & B", "a and b", True), ("One of These", "I say one of these it is", True), ("Two Words", "I say two words it is", False), ("", "", False), (None, "x", False), ("x", None, False)]
    rows = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(titles)], "i int, t string, a string")
    got = {r.i: r.ok for r in rows.select("i", benchmark.title_accepted(F.array("t"), F.col("a")).alias("ok")).collect()}
    assert got == {i: c[2] for i, c in enumerate(titles)}
    texts = {"in 1920, 100 cost 1,234.50 and 7": 1234.5, "1920 and 10,20": 10.0, "100": 100.0, "none": None, "12,345,678.": 12345678.0, "1.2.3 9": 9.0}
    rows = spark.createDataFrame([(k,) for k in texts], "x string")
    assert {r.x: r.v for r in rows.select("x", benchmark.amount_answer(F.col("x"), F.lit(1920), F.lit(1950)).alias("v")).collect()} == texts


def test_overlap_counts(spark):
    import random

    rnd = random.Random(2)
    span = lambda: sorted(rnd.sample(range(-30, 60), 2))
    left, right = [(i, *span()) for i in range(60)], [(rnd.choice("xyz"), *span()) for _ in range(80)]
    got = J.overlap_counts(spark.createDataFrame(left, "id int, a int, b int"), spark.createDataFrame(right, "g string, s int, e int"), "g", ("a", "b"), ("s", "e"))
    want = {(i, g): n for i, a, b in left for g in "xyz" if (n := sum(1 for h, s, e in right if h == g and s <= b and a <= e))}
    assert {(r.id, r.g): r.n for r in got.collect()} == want
    none = spark.createDataFrame([], "g string, s int, e int")
    assert J.overlap_counts(spark.createDataFrame(left, "id int, a int, b int"), none, "g", ("a", "b"), ("s", "e")).count() == 0


def test_paragraphs_stream_by(spark):
    """One page with most rows, pages without a key, empty and null texts: as a plain fold gives them."""
    import random

    rnd = random.Random(5)
    rows = [(rnd.choice([1] * 6 + [2, 3, None]), i, rnd.choice([None, "", "x" * rnd.randrange(1, 30), "a b"])) for i in range(3000)]

    def fold(texts):
        out, open_ = [], ""
        for x in texts:
            open_ = x if open_ == "" else f"{open_} {x}"
            if len(open_) >= 50:
                out.append(open_)
                open_ = ""
        return out + [open_] * (open_ != "")

    want = {(k, n, p) for k in (1, 2, 3, None) for n, p in enumerate(fold([x for key, _, x in sorted(rows, key=lambda r: r[1]) if key == k and x is not None]))}
    df = spark.createDataFrame(rows, "k int, i int, t string").repartition(7)
    got = [tuple(r) for r in O.packed_paragraphs(df, ["k"], "i", "t", 50).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert O.packed_paragraphs(df.limit(0), ["k"], "i", "t", 50).count() == 0
