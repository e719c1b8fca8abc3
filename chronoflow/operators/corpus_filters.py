"""Quality filters for web text: every measure a column, the first that fails names the verdict.

Measures are expressions over a text's words and lines, computed in the JVM without a shuffle. Only
the repetition measures over word n-grams need a scan with memory and run on Arrow batches.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of which a text needs two.
COMMON = ("the", "be", "to", "of", "and", "that", "have", "with")
#: N and the largest share of characters in the most frequent n-gram, and in repeated n-grams.
TOP_NGRAMS = {2: 0.20, 3: 0.18, 4: 0.16}
REPEATED_NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}


#: What lines on policies hold.
POLICY = "terms of use|privacy policy|cookie policy|uses cookies|use of cookies|use cookies"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\r\n\f]+"), F.lit(0))


def lines(text: Column) -> Column:
    """Lines that are not blank, without outer blanks."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"^[ \t\r\f]+|[ \t\r\f]+$", "")), lambda x: x != "")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole, 6))


def measures(text: Column) -> dict[str, Column]:
    """Measures by name, of the columns ``w`` (words) and ``l`` (lines) and the text."""
    w, l = F.col("w"), F.col("l")  # noqa: E741
    n, m = F.size(w), F.size(l)
    chars = F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x))
    line_chars = F.aggregate(l, F.lit(0), lambda a, x: a + F.length(x))
    count = lambda xs, f: F.size(F.filter(xs, f))
    of = lambda s: F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))
    clean = F.filter(l, lambda x: ~F.contains(F.lower(x), F.lit("javascript")) & ~F.lower(x).rlike(POLICY))
    joined = F.array_join(clean, "\n")
    return {
        "words": n,
        "mean_word": _share(chars, n),
        "duplicate_lines": _share(m - F.size(F.array_distinct(l)), m),
        "bullets": _share(count(l, lambda x: x.rlike("^[•‣*-]")), m),
        "ellipses": _share(count(l, lambda x: x.rlike(r"(\.\.\.|…)$")), m),
        "alphabetic": _share(count(w, lambda x: x.rlike(r"\p{L}")), n),
        "common": F.size(F.array_intersect(F.transform(w, F.lower), F.array(*map(F.lit, COMMON)))),
        "hashes": _share(of("#"), n),
        "dots": _share((of("...") / 3 + of("…")), n),
        "ended_lines": _share(count(l, lambda x: x.rlike(r"[.!?\"”]$")), m),
        "short_lines": _share(count(l, lambda x: F.length(x) <= 30), m),
        "duplicate_line_chars": _share(line_chars - F.aggregate(F.array_distinct(l), F.lit(0), lambda a, x: a + F.length(x)), line_chars),
        "line_breaks": _share(of("\n"), n),
        "lorem": F.contains(F.lower(text), F.lit("lorem ipsum")),
        "brace": F.contains(text, F.lit("{")),
        "sentences": F.size(F.regexp_extract_all(joined, F.lit(r"[.!?]+(?:[ \n”\"]|$)"), F.lit(0))),
    }


#: Verdicts in order: name, condition over the measures.
CASCADE = (
    ("empty", "words = 0"),
    ("language", "coalesce(lower(lang), 'und') <> 'en'"),
    ("duplicate_lines", "duplicate_lines > 0.30"),
    ("too_short", "words < 50"),
    ("too_long", "words > 100000"),
    ("short_words", "mean_word < 3"),
    ("long_words", "mean_word > 10"),
    ("bullets", "bullets > 0.90"),
    ("ellipses", "ellipses > 0.30"),
    ("alphabetic", "alphabetic < 0.80"),
    ("common_words", "common < 2"),
    ("hashes", "hashes > 0.1"),
    ("dots", "dots > 0.1"),
    ("lorem", "lorem"),
    ("brace", "brace"),
    ("few_sentences", "sentences < 3"),
    ("line_ends", "ended_lines < 0.12"),
    ("short_lines", "short_lines > 0.67"),
    ("duplicate_line_chars", "duplicate_line_chars > 0.01"),
    ("line_breaks", "line_breaks > 0.3"),
)
#: Filters over the measures of repetition(), in the order of their stage.
NGRAMS = (*((f"top_{n}", f"top_{n} > {most}") for n, most in TOP_NGRAMS.items()), *((f"repeated_{n}", f"repeated_{n} > {most}") for n, most in REPEATED_NGRAMS.items()))
#: Fixed value: how the hosts on the block list end. The filter reads the host from ``source``.
BLOCKED = ".invalid"
#: The reference's whole cascade: the block list stands before the language, n-grams right after duplicate lines.
WHOLE = (CASCADE[0], ("url", f"endswith(lower(source), '{BLOCKED}')"), *CASCADE[1:3], *NGRAMS, *CASCADE[3:])


def measured(df: DataFrame, text: str) -> DataFrame:
    base = df.withColumn("w", words(F.col(text))).withColumn("l", lines(F.col(text)))
    return base.withColumns(measures(F.coalesce(F.col(text), F.lit("")))).drop("w", "l")


def verdicts(df: DataFrame, text: str, cascade=CASCADE) -> DataFrame:
    """Measures and ``verdict``: the first filter of the cascade that fails, or pass.

    Measures of repetition() are taken if the cascade asks for them, of the rows no earlier filter decides.
    """
    rows, verdict, scanned = measured(df, text), F.when(F.lit(False), ""), False
    for name, condition in cascade:
        if name in dict(NGRAMS) and not scanned:
            scanned = True
            shares = F.arrow_udf(_shares, "array<double>")(F.when(verdict.isNull(), F.col(text)))
            rows = rows.withColumn("shares", shares).withColumns({n: F.get("shares", i) for i, (n, _) in enumerate(NGRAMS)}).drop("shares")
        verdict = verdict.when(F.expr(condition), name)
    return rows.withColumn("verdict", verdict.otherwise("pass"))


def _shares(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else _repetition(t) for t in texts.to_pylist()], pa.list_(pa.float64()))


def _half_up(x: float) -> float:
    return math.floor(x * 1e6 + 0.5) / 1e6


def _repetition(text: str) -> list[float]:
    w = text.split()
    total = sum(map(len, w)) or 1
    grams = lambda n: list(zip(*(w[i:] for i in range(n))))
    chars = lambda g: sum(map(len, g))
    out = []
    for n in TOP_NGRAMS:
        counts = Counter(grams(n))
        most = max(counts.values(), default=1)
        if most == 1:  # then no longer n-gram is repeated either
            break
        out.append(_half_up(max(chars(g) for g, c in counts.items() if c == most) * most / total))
    for n in REPEATED_NGRAMS if len(out) == len(TOP_NGRAMS) else ():
        seen, repeated, i, found = set(), 0, 0, grams(n)
        while i < len(found):
            if found[i] in seen:
                repeated += chars(found[i])
                i += n
            else:
                seen.add(found[i])
                i += 1
        if not repeated:
            break
        out.append(_half_up(repeated / total))
    return out + [0.0] * (len(NGRAMS) - len(out))


def repetition(df: DataFrame, key: str, text: str) -> DataFrame:
    """Shares of characters in the most frequent 2- to 4-gram and in repeated 5- to 10-grams of each text."""
    names = [n for n, _ in NGRAMS]
    narrow = df.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("x"))

    def run(batches):
        for batch in batches:
            rows = [_repetition(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], pa.float64()) for i in range(len(names)))], ["k", *names])

    kind = narrow.schema["k"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"k {kind}, " + ", ".join(f"{n} double" for n in names)).withColumnRenamed("k", key)
    failed = F.when(F.lit(False), "")
    for n, condition in NGRAMS:
        failed = failed.when(F.expr(condition), n)
    return out.withColumn("verdict", failed.otherwise("pass"))
