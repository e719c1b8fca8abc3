"""Checking claims against the record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoflow.functions.text import norm, stem
from chronoflow.functions.timeaxis import MONTHS

_M = "|".join(m.lower() for m in MONTHS)


def claim_date(text: Column) -> Column:
    """struct(year, month, day) that a claim names: the first form that is found, in a fixed order."""
    low = F.lower(text)
    get = lambda p, i: F.nullif(F.regexp_extract(low, p, i), F.lit(""))
    number = lambda c: c.try_cast("int")
    edge = r"(?:^|[^\p{L}\p{N}])"
    end = r"(?![\p{L}\p{N}])"
    month = lambda c: F.when(c.isNotNull(), F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), c).cast("int"))
    none = F.lit(None).cast("int")
    iso, mdy, dmy = rf"{edge}(\d{{4}})-(\d{{2}})-(\d{{2}}){end}", rf"{edge}({_M})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{3,4}}){end}", rf"{edge}(\d{{1,2}})(?:st|nd|rd|th)?\s+({_M}),?\s+(\d{{3,4}}){end}"
    bce, four, said = rf"{edge}(\d{{1,4}})\s*(?:bc|bce){end}", rf"{edge}(1\d{{3}}|20\d{{2}}){end}", rf"{edge}(?:in|ad|year)\s+([1-9]\d{{1,2}}){end}"
    found = lambda y, m, d, ok: F.when(ok.isNotNull(), F.struct(y.alias("year"), m.alias("month"), d.alias("day")))
    return F.coalesce(
        found(number(get(iso, 1)), number(get(iso, 2)), number(get(iso, 3)), get(iso, 1)),
        found(number(get(mdy, 3)), month(get(mdy, 1)), number(get(mdy, 2)), get(mdy, 1)),
        found(number(get(dmy, 3)), month(get(dmy, 2)), number(get(dmy, 1)), get(dmy, 1)),
        found(1 - number(get(bce, 1)), none, none, get(bce, 1)),
        found(number(get(four, 1)), none, none, get(four, 1)),
        found(number(get(said, 1)), none, none, get(said, 1)),
    )


def coverage(claims: DataFrame, rows: DataFrame, least: float = 0.5) -> DataFrame:
    """claim, row_id, covered, tokens: rows that hold at least ``least`` of a claim's words and all its numbers.

    claims: claim, tokens (array); rows: row_id, text. Words meet by themselves or by their stems,
    numbers only by themselves. The claims are a stated set of bounded size and are broadcast.
    """
    number = lambda c: c.rlike("^[0-9]+$")
    t = claims.select("claim", F.size("tokens").alias("tokens"), F.size(F.filter("tokens", number)).alias("numbers"), F.explode("tokens").alias("token"))
    t = t.withColumn("meet", F.when(number(F.col("token")), F.col("token")).otherwise(stem(F.col("token"))))
    words = rows.select("row_id", F.explode(F.array_distinct(F.split(norm(F.col("text")), " "))).alias("word"))
    words = words.select("row_id", F.when(number(F.col("word")), F.col("word")).otherwise(stem(F.col("word"))).alias("meet")).distinct()
    met = words.join(F.broadcast(t), "meet").select("claim", "row_id", "token", "tokens", "numbers").distinct()
    got = met.groupBy("claim", "row_id", "tokens", "numbers").agg(F.count(F.lit(1)).alias("covered"), F.count_if(number(F.col("token"))).alias("n"))
    return got.where((F.col("n") == F.col("numbers")) & (F.col("covered") >= F.col("tokens") * least)).select("claim", "row_id", "covered", F.col("tokens").cast("bigint").alias("tokens"))


def disagreements(terms: DataFrame, note: int = 25, now: int = 2026) -> DataFrame:
    """term_id, gap, class: holders whose terms and confirmed years differ by more than a year at either end; from ``note`` years on a note."""
    own = terms.select("term_id", F.explode("terms").alias("x")).select("term_id", F.get("x", 0).alias("s"), F.coalesce(F.get("x", 1), F.lit(now)).alias("e")).where("s <= e")
    a = own.groupBy("term_id").agg(F.min("s").alias("s1"), F.max("e").alias("e1"))
    b = terms.select("term_id", F.array_min("years").alias("s2"), F.array_max("years").alias("e2")).where("s2 is not null")
    gap = F.greatest(F.abs(F.col("s1") - F.col("s2")), F.abs(F.col("e1") - F.col("e2")))
    return a.join(b, "term_id").select("term_id", gap.alias("gap")).where("gap > 1").withColumn("class", F.when(F.col("gap") >= note, "note").otherwise("gap"))
