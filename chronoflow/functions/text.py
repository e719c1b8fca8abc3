"""Text functions as column expressions: folding, slugs, tokens, stems, sentences, display forms."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoflow.functions.timeaxis import MONTHS

#: Words that an index of sentences leaves out.
STOP = (
    "a an the and or of in on at to for from by with as is are was were be been being it its this that these those his her their he she they them we you i not no "
    "but if then than so such into over under after before during between within about also more most other some any all each both few many one two three which who whom whose what "
    "when where why how there here have has had do does did will would can could may might must shall should new first second"
).split()
#: Words that a claim's matching leaves out.
CLAIM_STOP = (
    "a an the and or of in on at to for from by with as is are was were be been being it its this that these those his her their he she they them not no but if then than so into over under after before "
    "during between within about also which who whom whose what when where how there have has had do does did will would can could may might happened happen took place year date became become"
).split()
#: Irregular past forms and their stems.
IRREGULAR = {
    "fell": "fall", "sank": "sink", "won": "win", "began": "begin", "became": "become", "took": "take", "died": "die", "born": "bear", "wrote": "write", "led": "lead", "fought": "fight", "built": "build", "made": "make",
    "struck": "strike", "rose": "rise", "froze": "freeze", "flew": "fly", "ran": "run", "sold": "sell", "bought": "buy", "shot": "shoot", "killed": "kill", "gave": "give", "held": "hold", "met": "meet", "left": "leave", "lost": "lose",
}
#: Letters that decompose to no ASCII letter, with their plain spelling.
SPECIAL = {"đ": "d", "ð": "d", "ø": "o", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t"}
#: Letters with a plain spelling of two.
DOUBLE = {"ß": "ss", "æ": "ae", "Æ": "Ae", "œ": "oe", "Œ": "Oe", "þ": "th", "Þ": "Th"}


@functools.cache
def fold_table() -> tuple[str, str]:
    """Letters with marks and their base letters, by decomposition."""
    pairs = [(chr(c), d[0]) for c in range(0xC0, 0x250) if (d := unicodedata.normalize("NFKD", chr(c)))[0].isascii() and d[0].isalpha() and all(unicodedata.combining(x) for x in d[1:])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(text: Column, special: bool = False) -> Column:
    """Letters without their marks, inside the JVM; with ``special`` also đ, ø, ł, ß, æ and the like."""
    a, b = fold_table()
    if special:
        for x, y in SPECIAL.items():
            a, b = a + x + x.upper() * (x != "ı"), b + y + y.upper() * (x != "ı")
        for x, y in DOUBLE.items():
            text = F.replace(text, F.lit(x), F.lit(y))
    return F.translate(text, a, b)


def norm(text: Column) -> Column:
    """Small ASCII letters and digits with single blanks; null gives an empty text."""
    return F.trim(F.regexp_replace(fold(F.lower(F.coalesce(text, F.lit("")))), "[^a-z0-9]+", " "))


def slugify(text: Column, longest: int = 80) -> Column:
    """ASCII slug: & as and, other signs as single hyphens, at most ``longest`` characters."""
    plain = F.regexp_replace(fold(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit(" and ")))), "[^\\x00-\\x7f]", "")
    return F.regexp_replace(F.left(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(longest)), "-+$", "")


def index_tokens(text: Column) -> Column:
    """Distinct tokens of an index: three characters or more (two with a digit), no stop words, with a crude singular."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    # one hash lookup per word, and repeats are gone before the rest
    known = F.array_except(words, F.array(*map(F.lit, STOP)))
    kept = F.filter(known, lambda w: (F.length(w) >= 3) | ((F.length(w) >= 2) & w.rlike("[0-9]")))
    single = lambda w: (F.length(w) > 4) & F.endswith(w, F.lit("s")) & ~F.endswith(w, F.lit("ss"))
    return F.array_distinct(F.flatten(F.transform(kept, lambda w: F.when(single(w), F.array(w, F.left(w, F.length(w) - 1))).otherwise(F.array(w)))))


def content_words(text: Column) -> Column:
    """Distinct words of four letters or more that are no stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]{4,}"), F.lit(0))
    return F.array_distinct(F.array_except(words, F.array(*map(F.lit, STOP))))


def stem(word: Column) -> Column:
    """Irregular past forms by a table, else the first ending off that leaves three letters."""
    table = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    out = None
    for suffix in ("ings", "ing", "ied", "ies", "ed", "es", "s"):
        hit = F.endswith(word, F.lit(suffix)) & (F.length(word) - len(suffix) >= 3)
        base = F.left(word, F.length(word) - len(suffix))
        base = F.concat(base, F.lit("y")) if suffix in ("ied", "ies") else base
        out = F.when(hit, base) if out is None else out.when(hit, base)
    return F.coalesce(F.try_element_at(table, word), out.otherwise(word))


def claim_tokens(text: Column, year: Column, day: Column) -> Column:
    """Words of a claim worth matching: no stop words or months; numbers up to three digits except the date's own; Roman numerals."""
    words = F.split(norm(text), " ")
    months = F.array(*[F.lit(m.lower()) for m in MONTHS])
    skip = F.array_compact(F.array(year.cast("string"), (1 - year).cast("string"), day.cast("string")))
    stop = F.array(*map(F.lit, [*CLAIM_STOP, "bce", "ad", "bc"]))
    number = lambda w: w.rlike("^[0-9]+$")
    roman = lambda w: w.rlike("^(ii|iii|iv|vi|vii|viii|ix|xi|xii|xiii|xiv|xv|xvi|xvii|xviii)$")
    good = lambda w: F.when(number(w), (F.length(w) <= 3) & (w.try_cast("int") > 0) & ~F.array_contains(skip, w)).otherwise(roman(w) | ((F.length(w) > 2) & ~F.array_contains(stop, w) & ~F.array_contains(months, w)))
    return F.array_distinct(F.filter(words, good))


def as_sentence(text: Column) -> Column:
    """A clause as a sentence: no signs before it, no colon after it, a capital, a final stop."""
    t = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[\s,;:.–—-]+", ""), r"[\s,:;–—-]+$", "")
    t = F.concat(F.upper(F.left(t, F.lit(1))), F.substr(t, F.lit(2)))
    return F.when(t == "", t).when(t.rlike(r"[.!?][”\"')]?$"), t).otherwise(F.concat(t, F.lit(".")))


def strip_date_prefix(text: Column) -> Column:
    """A text without the date printed before it; a printed range stays."""
    months = "|".join(MONTHS)
    lead = rf"^(?:(?:{months})\s+\d{{1,2}}|\d{{1,2}}\s+(?:{months}))\s*(?:[–—-]|:|,)\s*(?![\d])"
    return F.regexp_replace(text, lead, "")


def trim_to(text: Column, longest: int = 155) -> Column:
    """A text cut at a word's end with an ellipsis if it is longer than ``longest``."""
    cut = F.regexp_replace(F.left(text, F.lit(longest - 1)), r"\s+\S*$", "")
    return F.when(F.length(text) <= longest, text).otherwise(F.concat(F.regexp_replace(cut, r"[\s,;:.]+$", ""), F.lit("…")))


def number_word(n: Column) -> Column:
    """zero to twelve in words, other numbers in digits."""
    words = "zero one two three four five six seven eight nine ten eleven twelve".split()
    return F.when(n.between(0, 12), F.element_at(F.array(*map(F.lit, words)), n.cast("int") + 1)).otherwise(n.cast("string"))
