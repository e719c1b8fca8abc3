"""Texts that stop before their sentence is complete.

Labels are made, not given: values that end as sentences do (on a stop, or on a phrase that texts
usually end on) are intact; cutting them at chance places, inside words or between them, with and
without a mark, gives the positives; the intact ones, half of them without their final stop, are the
negatives. A hashed logistic regression is fitted on closing characters, closing words (names and
numbers reduced to their kind), punctuation and the distance to the field's limit, and scores every
record.

A source has a limit if its texts pile up at a length, few being longer: five lengths are far denser
than the twenty below and the twenty above them. Limits come from counts over all records. For the fit they are drawn at random, so
that the model learns what a text at its limit means without having seen that source.

The fit takes its intact values from at most ``SAMPLE`` texts, those of lowest hash; known words, closing
phrases, limits and scores cover all records.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoflow.llm.residue import Model
from chronoflow.plans.staging import Stage

#: Most texts from which intact values are taken for the fit, and the number of hashed weights.
SAMPLE, WEIGHTS = 30_000, 1 << 18
#: One text in so many has a known word, and closes on an established phrase.
SHARE, CLOSING = 1_500, 6_000
#: Sources with a limit up to which their table is broadcast; beyond, it is joined by shuffle.
MAX_BROADCAST = 50_000
#: Probability from which a record counts as truncated.
LEAST = 0.5
#: Labelled marks of a cut, as publishing software leaves them.
MARKS = ("…", "...", " …", " ...", "[…]", " […]", "[...]", "[more]", " [more]", "(more…)", " (more…)", " (see more…)", "&hellip;", " &hellip;", " &nbs", " &am", " &quot", " &#82", " &#8", "&am", " [[", "[[", " (see", " (")
WORDS = regex.compile(r"[\p{L}\p{M}’'-]+|\p{N}[\p{N},.½]*(?<=\p{N}|½)|[^\s\p{L}\p{N}]")
ENDS = regex.compile(r"[.!?][”\")]?$|\)$")
MARKED = regex.compile(r"(…|\.\.\.|\]|&\w*;?|&#\d*;?|more…?\))\s*$")


def gap_class(length: int, limit: int | None) -> str:
    if not limit:
        return "-"
    gap = limit - length
    return "over" if gap < 0 else str(gap) if gap < 3 else "5" if gap <= 5 else "10" if gap <= 10 else "20" if gap <= 20 else "60" if gap <= 60 else "far"


def features(text: str, limit: int | None, known: frozenset[str]) -> list[int]:
    """Hashed features of a text's closing, its marks and its distance to the limit."""
    body = text.rstrip()
    opened = body.count("“") - body.count("”")
    if not opened and "”" in body:  # quotes around words say nothing
        body = body.replace("“", "").replace("”", "")
    tail = body[-160:]
    found = WORDS.findall(tail)[-8:]
    flat = text.islower() or text.isupper()
    kinds = []
    for w in found:
        low = w.lower()
        if low in known or not w[0].isalnum():
            kinds.append(low)
        elif w[0].isnumeric():
            kinds.append("9")
        else:
            kinds.append("X" if flat or not w[0].islower() else "x")
    stop = body[-1:] in ".!?" or body[-2:] in (".”", '."', ".)")
    bare = [k for k in kinds if k != "."] if stop and not body.endswith("..") else kinds
    gap = gap_class(len(text), limit)
    last = found[-1] if found else ""
    end = body[-1:]
    kind = "L" if end.islower() else "U" if end.isupper() else "9" if end.isnumeric() else end
    out = [
        "bias",
        f"stop {stop} {gap}",
        f"gap {gap}",
        f"end {kind} {gap}",
        f"blank {text[-1:].isspace()} {stop}",
        f"c2 {body[-2:].lower()}",
        f"c3 {body[-3:].lower()}",
        f"c4 {body[-4:].lower()}",
        f"c6 {body[-6:].lower()}",
        f"last {kinds[-1] if kinds else ''} {min(len(last), 9)} {stop}",
        f"word {last[-3:].lower()} {kinds[-1] if kinds else ''}",
        f"brackets {body.count('(') - body.count(')')} {stop}",
        f"quotes {opened} {stop}",
        f"links {body.count('[[') - body.count(']]')} {body.count('[') - body.count(']')}",
        f"comma {',' in bare[-3:]} {kinds[-1] if kinds else ''}",
    ]
    for n in (1, 2, 3, 4, 5, 6, 7):
        gram = " ".join(bare[-n:])
        out.append(f"w{n} {gram}")
        if n in (2, 4):
            out.append(f"s{n} {stop} {gram}")
    out.append(f"at {gap} {stop} {bare[-1] if bare else ''}")
    if len(body) < 40:
        out.append("short")
    return [zlib.crc32(f.encode("utf-8", "replace")) & (WEIGHTS - 1) for f in out]


def statistics(texts: DataFrame, n: int) -> tuple[frozenset[str], frozenset[str]]:
    """(known words, closing phrases) of a column ``x``, counted over all ``n`` texts.

    A word in small letters is known if one text in ``SHARE`` has it (three at least), so there are at
    most ``SHARE`` times the words of a text. A closing phrase is the last three words of texts without a
    stop; it is established if enough texts close on it (one in ``CLOSING``, five at least, so there are at
    most ``CLOSING``) and most texts that hold it do, which words before a chance cut never do.
    """
    word = F.explode(F.array_distinct(F.regexp_extract_all("x", F.lit(r"(?<![\p{L}\p{N}])\p{Ll}+(?![\p{L}\p{N}])"), F.lit(0))))
    known = texts.select(word.alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= max(3, n // SHARE))
    words = F.regexp_extract_all(F.lower("x"), F.lit(r"[\p{L}\p{M}’'-]+"), F.lit(0))
    x = F.rtrim("x")
    ended = x.rlike(ENDS.pattern) & ~x.rlike(MARKED.pattern)
    three = lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    last = F.array_join(F.slice("w", -3, 3), " ")
    closing = texts.where(~ended & x.rlike(r"[\p{L}\p{N}]$")).select(words.alias("w")).where("size(w) > 5").select(last.alias("p"), three(F.size("w") - 3).alias("h"))
    closing = closing.groupBy("p", "h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= max(5, n // CLOSING)).collect()
    usual: frozenset[str] = frozenset()
    if closing:
        few = F.broadcast(texts.sparkSession.createDataFrame([(r.h,) for r in closing], "h bigint"))
        threes = F.transform(F.sequence(F.lit(0), F.size("w") - 3), three)
        held = texts.select(words.alias("w")).where("size(w) > 2").select(F.explode(F.array_distinct(threes)).alias("h")).join(few, "h").groupBy("h").agg(F.count(F.lit(1)).alias("c"))
        held = {r.h: r.c for r in held.collect()}
        usual = frozenset(r.p for r in closing if r.c >= 0.7 * held[r.h])
    return frozenset(r.w for r in known.select("w").collect()), usual


def intact_values(texts: list[str], usual: frozenset[str]) -> list[str]:
    """Texts that end as sentences do: on a stop or closing bracket, or on an established closing phrase."""
    words = regex.compile(r"[\p{L}\p{M}’'-]+")
    return [t for t in texts if ENDS.search(t) and not MARKED.search(t) or t[-1].isalnum() and " ".join(words.findall(t.lower())[-3:]) in usual]


def fit(intact: list[str], known: frozenset[str], seed: int = 7, rounds: int = 10) -> np.ndarray:
    """Weights from intact values and their artificial cuts."""
    rnd = random.Random(seed)
    rows, labels = [], []

    def add(text: str, limit: int | None, label: int) -> None:
        rows.append(features(text, limit, known))
        labels.append(label)

    for t in intact:
        whole = t if rnd.random() < 0.4 else t[:-1].rstrip() if t.endswith(".") else t
        add(whole, len(whole) + rnd.randrange(0, 400) if rnd.random() < 0.4 else None, 0)
        if len(t) < 40:
            continue
        at = rnd.randrange(int(len(t) * 0.3), len(t) - 2)
        style = rnd.random()
        cut = t[:at]
        if style < 0.55:  # between words
            cut = cut[: max(cut.rfind(" "), 10)].rstrip(" ,") if rnd.random() < 0.8 else cut[: max(cut.rfind(" ") + 1, 10)]
        limit = None
        if rnd.random() < 0.4:
            limit = at if style >= 0.55 else len(cut) + rnd.randrange(0, 6)
        elif rnd.random() < 0.4:
            mark = rnd.choice(MARKS)
            cut = cut.rstrip() + mark + (rnd.choice(t.split()).strip(".,") if mark.endswith("[[") else "")
        elif rnd.random() < 0.2:
            limit = len(cut) + rnd.randrange(6, 150)
        add(cut, limit, 1)
    width = max(map(len, rows))
    x = np.full((len(rows), width), WEIGHTS, np.int64)
    for i, r in enumerate(rows):
        x[i, : len(r)] = r
    y = np.array(labels, np.float64)
    w, g2 = np.zeros(WEIGHTS + 1), np.full(WEIGHTS + 1, 1e-6)
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 256)):
            at = x[part]
            p = 1 / (1 + np.exp(-np.clip(w[at].sum(1), -30, 30)))
            grad = np.repeat((p - y[part])[:, None], width, 1).ravel()
            flat = at.ravel()
            step = np.bincount(flat, grad, WEIGHTS + 1)
            used = np.unique(flat)
            step = step[used] / len(part) + 2e-6 * w[used]
            g2[used] += step**2
            w[used] -= 0.25 * step / np.sqrt(g2[used])
            w[WEIGHTS] = 0
    return w[:WEIGHTS].astype(np.float32)


def field_limits(df: DataFrame, text: str, source: str) -> DataFrame:
    """s, limit: sources whose texts pile up at a length (counts over all records).

    Five lengths are a pile if they are far denser than the twenty on either side and hold more texts
    than all lengths beyond, so longer exceptions leave a source its limit. The greatest length of a
    pile that is no stray (a fiftieth of it at least) is the limit.
    """
    lengths = df.select(F.col(f"`{source}`").alias("s"), F.length(F.col(f"`{text}`")).alias("n")).where("s is not null and n > 0").groupBy("s", "n").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("s").orderBy("n")
    held = lambda first, last: F.coalesce(F.sum("c").over(w.rangeBetween(first, last)), F.lit(0))
    near = lengths.select("s", "n", "c", held(-4, 0).alias("at"), held(-24, -5).alias("below"), held(1, 20).alias("above"), held(1, Window.unboundedFollowing).alias("beyond"))
    piled = near.where("at >= 10 and at / 5 > 3 * below / 20 and at / 5 > 3 * above / 20 and beyond < at and c >= 0.02 * at")
    return piled.groupBy("s").agg(F.max("n").alias("limit"))


def truncated(df: DataFrame, key: str, text: str, source: str, least: float = LEAST, sample: int = SAMPLE, residue: Model | None = None) -> DataFrame:
    """Every record with text: ``key``, ``source``, ``probability``, ``cut`` (boolean).

    Null, empty and blank texts give no row. Repeated rows give one each. With too few intact values
    to fit (fewer than 20) nothing is cut. An empty table gives no rows. Other columns are not read.
    With ``residue`` a text that it finds is none of the record and never cut; only texts that would
    count as cut are held against it.
    """
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x"), F.col(f"`{source}`").cast("string").alias("s")).where(F.length(F.trim("x")) > 0)
    hashed = narrow.select("x", F.xxhash64("x", "k").alias("h"))
    total = narrow.count()
    if total > 4 * sample:  # the lowest hashes lie far below this bound: only they are sorted
        hashed = hashed.where(F.col("h") < int(-(2**63) + 2**64 * (2 * sample / total)))
    known, usual = statistics(narrow.select("x"), total)
    intact = intact_values([r.x.rstrip() for r in hashed.orderBy("h", "x").limit(sample).select("x").toLocalIterator()], usual)
    # one row per source with a limit
    limits = Stage(df.sparkSession, "truncation").write(field_limits(df, text, source), "limits")
    if limits.count() <= MAX_BROADCAST:
        limits = F.broadcast(limits)
    rows = narrow.join(limits, "s", "left")
    weights = fit(intact, known) if len(intact) >= 20 else None

    def run(batches):
        for batch in batches:
            texts, bounds = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            if weights is None:
                p = np.zeros(len(texts))
            else:
                p = np.array([1 / (1 + np.exp(-min(30.0, max(-30.0, float(weights[features(t, b, known)].sum()))))) for t, b in zip(texts, bounds)])
                if residue is not None:
                    p[[i for i in np.flatnonzero(p >= least) if residue.best(texts[i])]] = 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p, pa.float64())], ["k", "s", "p"])

    kind = narrow.schema["k"].dataType.simpleString()
    scored = rows.select("k", "x", "s", "limit").mapInArrow(run, f"k {kind}, s string, p double")
    return scored.select(F.col("k").alias(key), F.col("s").alias("source"), F.col("p").alias("probability"), (F.col("p") >= least).alias("cut"))
