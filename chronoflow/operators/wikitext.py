"""Extraction of dated, sourced claims from wikitext."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoflow.functions import wikitext as W
from chronoflow.functions.timeaxis import MONTHS, month_number, parse_date


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, line, heading, level: the lines of each text with the heading they stand under."""
    rows = df.select(key, F.posexplode(F.split(text, "\n")).alias("n", "line"))
    level = F.length(F.regexp_extract("line", r"^(={2,6})[ \t]*(.*?)[ \t]*(={2,6})[ \t]*$", 1))
    name = F.regexp_extract("line", r"^(={2,6})[ \t]*(.*?)[ \t]*(={2,6})[ \t]*$", 2)
    w = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("heading", F.last(F.when(level > 0, name), ignorenulls=True).over(w)).withColumn("level", level)


def plain(line: Column) -> Column:
    """A line without references, links' targets, templates without nesting, and marks."""
    t = line
    for pattern, to in ((r"<ref[^>/]*/>", ""), (r"<ref[^>]*>[^<]*</ref>", ""), (r"\{\{[^{}]*\}\}", ""), (r"\[\[[^\[\]|]*\|([^\[\]|]*)\]\]", "$1"), (r"\[\[([^\[\]|]*)\]\]", "$1"), ("''+", ""), ("&ndash;", "–"), ("&nbsp;", " "), (r"^[*:# \x{00a0}]+|[ \x{00a0}]+$", "")):
        t = F.regexp_replace(t, pattern, to)
    return t


#: Top sections that are no part of the record (apparatus, invention, tables of awards and offices).
APPARATUS = (
    "references", "external links", "see also", "notes", "sources", "further reading", "bibliography", "gallery", "in fiction", "notes and references", "citations", "in works of fiction", "fiction", "in legend", "in popular culture", "predictions and fictional events",
    "further reading and year books", "yearbooks", "works cited", "primary sources and year books", "new english words", "new english words and terms", "nobel prizes", "fields medal", "templeton prize", "right livelihood award", "other academic awards",
    "incumbents", "incumbent", "incumbents and office holders", "government", "federal government", "state governments",
    "monarch", "heads of state", "office holders", "works of art", "new books", "publications", "poetry and songs", "prose",
)
_MONTH = "|".join(MONTHS)
_DAY = rf"(?:{_MONTH})\s+\d{{1,2}}|\d{{1,2}}\s+(?:{_MONTH})"
_DASHES = " –—-"


def sections(df: DataFrame, key: str, text: str, month_markers: bool = False) -> DataFrame:
    """key, n, line, trail, top: lines outside comments with the headings above them, one per level.

    A heading ends those of its level and below. With ``month_markers`` a line ";May" is a heading
    below all others until the next one. Headings themselves are not returned.
    """
    rows = df.select(F.col(key).alias("k"), F.posexplode(F.split(text, "\n")).alias("n", "raw")).withColumn("line", F.rtrim("raw"))
    order = Window.partitionBy("k").orderBy("n")
    above, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    times = lambda x: F.size(F.split("line", x)) - 1
    # a line that opens more comments than it closes hides all lines up to the one that closes them
    rows = rows.withColumn("opens", (times("<!--") > times("-->")).cast("int")).withColumn("closes", (times("-->") > times("<!--")).cast("int"))
    rows = rows.withColumn("open", F.coalesce(F.last(F.when(F.col("opens") == 1, True).when(F.col("closes") == 1, False), ignorenulls=True).over(above), F.lit(False)))
    rows = rows.where("not open and opens = 0")
    heading = r"^(={2,6})\s*(.+?)\s*\1\s*$"
    level = F.length(F.regexp_extract("line", heading, 1))
    name = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("line", heading, 2), r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", "$1"), r"\s+", " "))
    soft = F.regexp_extract("line", rf"^;\s*'{{0,3}}\[?\[?\s*({_MONTH})\s*\]?\]?'{{0,3}}\s*:?\s*$", 1) if month_markers else F.lit("")
    rows = rows.withColumn("level", F.when(soft != "", 7).otherwise(level)).withColumn("name", F.when(soft != "", soft).otherwise(name))
    # the last heading of each level stands unless one of a higher level came after it
    last = lambda cond: F.last(F.when(cond, F.struct("n", "name")), ignorenulls=True).over(upto)
    for d in range(2, 8):
        rows = rows.withColumn(f"h{d}", last(F.col("level") == d)).withColumn(f"up{d}", last((F.col("level") > 0) & (F.col("level") < d)))
    standing = [F.when(F.col(f"h{d}").isNotNull() & (F.col(f"up{d}").isNull() | (F.col(f"h{d}.n") > F.col(f"up{d}.n"))), F.col(f"h{d}.name")) for d in range(2, 8)]
    rows = rows.withColumn("trail", F.filter(F.array(*standing), lambda x: x.isNotNull())).where("level = 0")
    return rows.select(F.col("k").alias(key), "n", "line", "trail", F.lower(F.get("trail", 0)).alias("top"))


def header_day(said: Column) -> Column:
    """The day of a line that is a header of what is nested below it: a date alone, or with a bracket or a short label."""
    s = F.trim(said)
    day = F.regexp_extract(s, rf"^({_DAY})\b", 1)
    rest = F.trim(F.regexp_replace(F.btrim(F.substring(s, F.length(day) + 1, F.lit(1 << 20)), F.lit(_DASHES)), r"^\([^)]*\)\s*[–—-]?\s*", ""))
    label = F.endswith(rest, F.lit(":")) & (F.size(F.split(rest, r"\s+")) <= 4)
    return F.when((day != "") & ((rest == "") | label), day)


def header_context(said: Column) -> Column:
    """What a header says beyond its day: a bracket that names no month, or a short label in small letters."""
    s = F.trim(said)
    tail = F.btrim(F.substring(s, F.length(F.regexp_extract(s, rf"^({_DAY})\b", 1)) + 1, F.lit(1 << 20)), F.lit(_DASHES))
    inner = F.trim(F.regexp_extract(tail, r"^\((.+)\)\s*:?\s*$", 1))
    label = F.trim(F.regexp_replace(tail, ":+$", ""))
    short = F.endswith(tail, F.lit(":")) & label.rlike(r"^\p{Ll}") & (F.size(F.split(label, r"\s+")) <= 4)
    return F.when((inner != "") & ~inner.rlike(rf"^(?:{_MONTH})\b"), inner).when((inner == "") & short, label)


def titles_of(year: Column) -> Column:
    """Titles of articles that are about one year alone."""
    n = F.when(year > 0, year).otherwise(F.abs(year) + 1).cast("string")
    of = lambda *forms: F.array(*(F.format_string(f, n) for f in forms))
    return F.when(year > 0, of("%s", "AD %s", "%s AD", "%s events")).otherwise(of("%s BC", "%s BCE", "%s BC events"))


def about_year(year: Column, trail: Column, said: Column) -> Column:
    """Whether a line of a wider article is about the year: by a heading above it or by how it begins (no range)."""
    n = F.when(year > 0, year).otherwise(F.abs(year) + 1).cast("string")
    era = F.when(year > 0, r"(?:\s*(?:AD|CE))?").otherwise(r"\s*(?:BCE?)")
    begins = F.concat(F.lit(r"(?i)^(?:c\.|circa|ca\.)?\s*(?:AD\s+)?"), n, era, F.lit(r"\s*[:–—-]\s*(?!\d{1,4}\s*(?:BCE?|AD)?\s*[:–—-])"))
    titles = F.transform(titles_of(year), F.lower)
    return F.exists(trail, lambda h: F.array_contains(titles, F.lower(F.trim(h)))) | F.regexp_like(said, begins)


def _cleaned(lines: pa.Array) -> pa.Array:
    out = [W.clean_line(x) if x is not None else None for x in lines.to_pylist()]
    return pa.array([None if x is None else dict(zip(("said", "links", "good"), x)) for x in out], pa.struct([("said", pa.string()), ("links", pa.list_(pa.string())), ("good", pa.bool_())]))


def claims(df: DataFrame, key: str, text: str, year: str, title: str | None = None, month_markers: bool = False) -> DataFrame:
    """key, id, n, kind, month, day, trail, text, body, links, raw, prefix, suffix: the claims of each text, the first of equal ones.

    Bullets of every section but the apparatus. A bullet that is only a date heads those nested below
    it: they take its day unless they print one, and what it says besides. Of an article that is not
    about one year (by ``title``; none is given: all are) only what is about the year. Ids are the year
    and twelve digits of the sentence's SHA-1. Null texts give none. Lines are cleaned on Arrow batches;
    headings, comments and days in force are windows over a text's lines.
    """
    own = df.select(F.col(key).alias("k"), F.col(text).alias("x"), F.col(year).cast("int").alias("y"), (F.col(title) if title else F.lit(None).cast("string")).alias("title"))
    rows = sections(own, "k", "x", month_markers).where(F.col("top").isNotNull() & ~F.col("top").isin(*APPARATUS) & F.col("line").rlike(r"^:*\*"))
    nested = F.col("line").rlike(r"^(?::+\*|\*\*)")
    rows = rows.withColumn("nested", nested).withColumn("raw", F.trim(F.regexp_replace("line", r"^:*\**", "")))
    rows = rows.withColumn("c", F.arrow_udf(_cleaned, "said string, links array<string>, good boolean")("raw"))
    day = F.when(~F.col("nested"), header_day(F.col("c.said")))
    rows = rows.withColumn("head", F.when(~F.col("nested"), F.struct(day.alias("day"), F.when(day.isNotNull(), header_context(F.col("c.said"))).alias("context"))))
    above = Window.partitionBy("k").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("force", F.when(F.col("nested"), F.last("head", ignorenulls=True).over(above)))
    rows = rows.where(F.when(F.col("nested"), F.length("raw") >= 40).otherwise(F.col("head.day").isNull() & (F.length("raw") >= 25)))
    prints = F.col("c.said").rlike(rf"^(?:{_MONTH})\s+\d{{1,2}}\b")
    rows = rows.withColumn("prefix", F.when(~prints, F.col("force.day"))).withColumn("suffix", F.col("force.context"))
    said = F.concat(F.coalesce(F.concat("prefix", F.lit(" – ")), F.lit("")), F.col("c.said"), F.coalesce(F.concat(F.lit(" — "), "suffix"), F.lit("")))
    rows = rows.withColumn("text", said).join(own.select("k", "y", "title"), "k")
    scoped = F.col("title").isNull() | F.array_contains(titles_of(F.col("y")), F.trim("title"))
    rows = rows.where(F.col("c.good") & F.length("text").between(30, 1200) & F.col("text").rlike("[a-zA-Z]{3}") & F.coalesce(scoped | about_year(F.col("y"), F.col("trail"), F.col("text")), F.lit(False)))
    first = Window.partitionBy("k", F.left(F.lower("text"), F.lit(120))).orderBy("n")
    rows = rows.withColumn("rank", F.row_number().over(first)).where("rank = 1")
    date = parse_date(F.col("text"))
    month = F.coalesce(date.month, month_number(F.get(F.filter("trail", lambda h: h.isin(*MONTHS)), 0)))
    body = F.trim(F.regexp_replace("text", rf"^(?:{_DAY}|(?:{_MONTH}))\b\s*(?:[-–—:]\s*)?", ""))
    kind = F.when(F.startswith("top", F.lit("birth")), "birth").when(F.startswith("top", F.lit("death")), "death").otherwise("event")
    out = rows.select(
        F.col("k").alias(key), F.concat_ws(":", F.col("y").cast("string"), F.left(F.sha1("text"), F.lit(12))).alias("id"), "n", kind.alias("kind"), month.alias("month"), date.day.alias("day"), "trail",
        "text", F.when(month.isNotNull(), body).otherwise(F.col("text")).alias("body"), F.slice("c.links", 1, 12).alias("links"), "raw", "prefix", "suffix",
    )
    return out.where("length(body) >= 20")


def bullet_trees(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, depth, parent: nested bullets of any depth with the line of the bullet above, one pass over each text."""
    narrow = df.select(F.col(key).alias("k"), F.col(text).alias("x"))

    def run(batches):
        for batch in batches:
            found = [(i, *b[:3]) for i, x in enumerate(batch.column(1).to_pylist()) if x for b in W.bullet_tree(x.split("\n"))]
            at, n, depth, parent = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int32()) for c in (n, depth, parent))], ["k", "n", "depth", "parent"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, n int, depth int, parent int").withColumnRenamed("k", key)


def tables(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, tab, row, cells: the top tables of each text with their spans filled in, in one pass."""
    narrow = df.select(F.col(key).alias("k"), F.col(text).alias("x")).where(F.contains("x", F.lit("{|")))

    def run(batches):
        for batch in batches:
            found = [(i, t, r, cells) for i, x in enumerate(batch.column(1).to_pylist()) for t, rows in enumerate(W.grid(x)) for r, cells in enumerate(rows)]
            at, tab, row, cells = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(tab, pa.int32()), pa.array(row, pa.int32()), pa.array(cells, pa.list_(pa.string()))], ["k", "tab", "row", "cells"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, tab int, row int, cells array<string>").withColumnRenamed("k", key)


def holders(df: DataFrame, key: str, line: str) -> DataFrame:
    """key, place, person, post, start, until, open, why: the holders that a line of an office list names, with each of their terms.

    Leading links are the persons (else what stands before the first comma); the last bracket holds the
    terms; what stands between is the post. A part of the terms that is vague or no year gives no term
    but ``why`` with its text.
    """
    narrow = df.select(F.col(key).alias("k"), F.col(line).alias("x"))
    schema = pa.schema([("place", pa.int32()), ("person", pa.string()), ("post", pa.string()), ("start", pa.int32()), ("until", pa.int32()), ("open", pa.bool_()), ("why", pa.string())])

    def run(batches):
        for batch in batches:
            at, out = [], []
            for i, x in enumerate(batch.column(1).to_pylist()):
                for place, person, post, start, until, why in W.holder_terms(x or ""):
                    at.append(i)
                    out.append({"place": place, "person": person, "post": post, "start": start, "until": until, "open": start is not None and until is None, "why": why})
            rest = pa.RecordBatch.from_pylist(out, schema=schema)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *rest.columns], ["k", *schema.names])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, place int, person string, post string, start int, until int, open boolean, why string").withColumnRenamed("k", key)
