"""Queries on weights, quotas, samples, set operations and deduplication."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoflow.operators import selection as S
from chronoflow.queries.aggregates import COUNTRY, SQL_MD, country, dated
from chronoflow.queries.registry import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

#: A weight that orders: null and NaN last.
W = "CASE WHEN weight IS NULL OR isnan(weight) THEN -1.0 ELSE weight END"


def weighted(t):
    return t.published.withColumn("w", F.when(F.col("weight").isNull() | F.isnan("weight"), -1.0).otherwise(F.col("weight")))


@R.add("""
SELECT row_id, round(0.62 * least(1.0, ln(1 + coalesce(length(text), 0) * 100) * (1 - 0.85 * least(1.0, ln(1 + greatest(0, prominence - 3)) / ln(61))) / ln(200001))
 + 0.10 * least(1.0, ln(1 + prominence) / ln(251)) + 0.16 * (date IS NOT NULL)::INTEGER + 0.12 * CASE WHEN coalesce(length(text), 0) < 70 THEN 0.5 ELSE 1.0 END, 5) AS w FROM published WHERE prominence IS NOT NULL""")
def t01_event_weight(t):
    """Notability weights of events."""
    p, n = F.col("prominence"), F.coalesce(F.length("text"), F.lit(0))
    return t.published.where("prominence is not null").select("row_id", S.event_weight(n * 100, p, p, F.col("date").isNotNull(), n).alias("w"))


@R.add("""SELECT row_id, round(0.72 * least(1.0, ln(1 + prominence * 50) / ln(200001)) + 0.16 * (len(links) / 4.0) + 0.12 * (date IS NOT NULL)::INTEGER, 5) AS w FROM published WHERE kind <> 'event' AND links IS NOT NULL AND prominence IS NOT NULL""")
def t02_person_weight(t):
    """Weights of births and deaths by their first subject."""
    return t.published.where("kind <> 'event' and links is not null and prominence is not null").select("row_id", S.person_weight(F.col("prominence") * 50, F.size("links") / 4.0, F.col("date").isNotNull()).alias("w"))


@R.add("""SELECT row_id, round(0.55 * ln(1 + prominence) / ln(401) + 0.25 * (date IS NOT NULL)::INTEGER + 0.20 * CASE WHEN length(text) BETWEEN 70 AND 260 THEN 1.0 WHEN length(text) <= 400 THEN 0.6 ELSE 0.35 END, 4) AS w FROM published WHERE text IS NOT NULL AND prominence IS NOT NULL""")
def t03_claim_weight(t):
    """The older weight of a claim."""
    return t.published.where("text is not null and prominence is not null").select("row_id", S.claim_weight(F.col("prominence"), F.col("date").isNotNull(), F.length("text")).alias("w"))


@R.add(f"""
SELECT row_id, year, section FROM (SELECT *, row_number() OVER (PARTITION BY year, section ORDER BY {W} DESC, row_id) AS place, count(*) OVER (PARTITION BY year, section) AS n FROM published WHERE section IS NOT NULL)
WHERE place <= CASE WHEN section IN ('Births', 'Deaths') THEN 6 ELSE 10 END AND n >= 2""")
def t04_top_per_section(t):
    """The best rows of every section of a year, fewer for births and deaths, of sections with two rows or more."""
    rows = weighted(t).where("section is not null").select("row_id", "year", "section", "w")
    size = rows.groupBy("year", "section").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").drop("n")
    best = S.top_per_group(rows, ["year", "section"], [F.desc("w"), F.asc("row_id")], 10)
    best = best.where(F.col("place") <= F.when(F.col("section").isin("Births", "Deaths"), 6).otherwise(10))
    return best.join(size, ["year", "section"], "left_semi").select("row_id", "year", "section")


@R.add(f"""
WITH top AS (SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY year, section ORDER BY {W} DESC, row_id) AS place FROM published WHERE section IS NOT NULL) WHERE place <= 3)
SELECT row_id, max(pinned) AS pinned FROM (SELECT row_id, false AS pinned FROM top UNION ALL SELECT row_id, true FROM published WHERE prominence >= 5 AND section IS NOT NULL) GROUP BY row_id""")
def t05_pins(t):
    """Section tops with pinned rows above the cap, each once."""
    rows = weighted(t).where("section is not null")
    top = S.top_per_group(rows, ["year", "section"], [F.desc("w"), F.asc("row_id")], 3).select("row_id", F.lit(False).alias("pinned"))
    pins = rows.where("prominence >= 5").select("row_id", F.lit(True).alias("pinned"))
    return top.unionByName(pins).groupBy("row_id").agg(F.max("pinned").alias("pinned"))


@R.add(f"""
WITH d AS (SELECT row_id, section, {W} AS w, row_number() OVER (PARTITION BY section, {COUNTRY} ORDER BY {W} DESC, row_id) AS depth FROM published WHERE section IS NOT NULL AND {COUNTRY} IS NOT NULL)
SELECT row_id, section, place FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY depth, w DESC, row_id)::INTEGER AS place FROM d) WHERE place <= 100""")
def t06_breadth_first(t):
    """A section's rows by round robin over its countries."""
    rows = weighted(t).withColumn("c", country()).where("section is not null and c is not null").select("row_id", "section", "c", "w")
    return S.breadth_first(rows, ["section"], "c", [F.desc("w"), F.asc("row_id")], 100).select("row_id", "section", "place")


@R.add(f"SELECT row_id, row_number() OVER (PARTITION BY page_id ORDER BY coalesce(m, 13), coalesce(d, 32), row_id)::INTEGER AS place FROM ({SQL_MD}) JOIN published p USING (row_id)")
def t07_calendar_order(t):
    """Rows of a page in calendar order, undated ones last."""
    rows = dated(t).select("row_id", "month", "day").join(t.published.select("row_id", "page_id"), "row_id")
    w = Window.partitionBy("page_id").orderBy(F.coalesce("month", F.lit(13)), F.coalesce("day", F.lit(32)), "row_id")
    return rows.select("row_id", F.row_number().over(w).alias("place"))


@R.add("""
WITH x AS (SELECT page_id, row_id, row_number() OVER (PARTITION BY page_id ORDER BY year, row_id) - 1 AS i, count(*) OVER (PARTITION BY page_id) AS n FROM published)
SELECT page_id, row_id FROM x WHERE n <= 8 OR i IN (SELECT unnest([floor(k * n / 8)::BIGINT FOR k IN range(8)]))""")
def t08_even_spread(t):
    """Eight rows of every page at even distances."""
    return S.even_spread(t.published.select("page_id", "row_id", "year"), ["page_id"], ["year", "row_id"], 8).select("page_id", "row_id")


@R.add("""
SELECT slug, place FROM (SELECT slug, row_number() OVER (ORDER BY (qid IS NOT NULL) DESC, last_year - first_year DESC, entries DESC, slug DESC)::INTEGER AS place FROM subjects WHERE qid IS NOT NULL OR last_year - first_year >= 6) WHERE place <= 300""")
def t09_protected_keep(t):
    """Subjects kept: the protected first, then by span and entries (a top-k report)."""
    span = F.col("last_year") - F.col("first_year")
    kept = t.subjects.where(F.col("qid").isNotNull() | (span >= 6)).orderBy(F.desc(F.col("qid").isNotNull()), F.desc(span), F.desc("entries"), F.desc("slug")).limit(300)
    order = Window.orderBy(F.desc(F.col("qid").isNotNull()), F.desc(span), F.desc("entries"), F.desc("slug"))
    return kept.select("slug", F.row_number().over(order).alias("place"))


@R.add("""
WITH f AS (SELECT year, links[1] AS person, max(prominence) AS size, min(row_id) AS row_id FROM published WHERE kind = 'birth' AND links IS NOT NULL AND len(links) > 0 AND prominence > 0 GROUP BY 1, 2)
SELECT year, person, row_id, place FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY size DESC, person)::INTEGER AS place FROM f) WHERE place <= 15""")
def t10_famous_births(t):
    """The fifteen best known people born in each year, each once."""
    f = t.published.where("kind = 'birth' and size(links) > 0 and prominence > 0").groupBy("year", F.get("links", 0).alias("person")).agg(F.max("prominence").alias("size"), F.min("row_id").alias("row_id"))
    return S.top_per_group(f, ["year"], [F.desc("size"), F.asc("person")], 15).select("year", "person", "row_id", "place")


@R.add("""
WITH x AS (SELECT row_id, section, year, md5('s1|' || row_id) AS r FROM published WHERE section IS NOT NULL), g AS (SELECT *, row_number() OVER (PARTITION BY section, year ORDER BY r, row_id) AS k FROM x)
SELECT row_id, section, place FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY CASE WHEN k <= 2 THEN 0 ELSE k END, r, row_id)::INTEGER AS place FROM g) WHERE place <= 60""")
def t11_stratified(t):
    """A seeded sample of sixty rows per section, at most two a year unless the section stays short."""
    return S.stratified(t.published.where("section is not null").select("row_id", "section", "year"), "section", "year", "row_id", "s1", 60, 2).select("row_id", "section", "place")


@R.add("""
WITH k AS (SELECT links[1] AS person, min(row_id) AS row_id FROM published WHERE links IS NOT NULL AND len(links) > 0 GROUP BY 1), x AS (SELECT k.*, p.section, md5('s2|' || k.row_id) AS r FROM k JOIN published p USING (row_id) WHERE p.section IS NOT NULL)
SELECT row_id, section, place FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY r, row_id)::INTEGER AS place FROM x) WHERE place <= 20""")
def t12_one_per_key(t):
    """A seeded sample per section that takes every person once."""
    first = t.published.where("size(links) > 0").groupBy(F.get("links", 0).alias("person")).agg(F.min_by(F.struct("row_id", "section"), "row_id").alias("x")).select("x.row_id", "x.section")
    rows = first.where("section is not null").withColumn("r", S.seeded_order("s2", F.col("row_id")))
    return S.top_per_group(rows, ["section"], [F.asc("r"), F.asc("row_id")], 20).select("row_id", "section", "place")


@R.add("""
WITH y AS (SELECT DISTINCT year FROM published WHERE year IS NOT NULL),
d AS (SELECT a.year AS a, b.year AS b, md5('s3|' || a.year || '|' || b.year) AS r, a.year > b.year AND ('0x' || left(md5('s3|back|' || a.year || '|' || b.year), 8))::BIGINT >= 0.2 * 4294967296 AS turned FROM y a JOIN y b ON abs(b.year - a.year) >= 5),
p AS (SELECT CASE WHEN turned THEN b ELSE a END AS a, CASE WHEN turned THEN a ELSE b END AS b, min(r) AS r FROM d GROUP BY 1, 2)
SELECT a, b, row_number() OVER (ORDER BY r, a, b)::INTEGER AS place FROM p ORDER BY r, a, b LIMIT 150""")
def t13_pairs(t):
    """A seeded sample of 150 pairs of years at least five apart, about a tenth of them backward (a sampling operator)."""
    return S.seeded_pairs(t.published.select("year").distinct(), "year", "s3", 5, 150)


@R.add(f"""
WITH x AS (SELECT row_id, year, ntile(3) OVER (PARTITION BY year ORDER BY {W} DESC, row_id) AS band, md5('s4|' || row_id) AS r FROM published WHERE kind = 'event' AND text IS NOT NULL)
SELECT year, row_id, band, place FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY band DESC, r, row_id)::INTEGER AS place FROM x) WHERE place <= 5""")
def t14_clue_schedule(t):
    """Five clues per year, from the band of low weights (hard) to that of high ones, in seeded order."""
    rows = weighted(t).where("kind = 'event' and text is not null")
    rows = rows.select("row_id", "year", F.ntile(3).over(Window.partitionBy("year").orderBy(F.desc("w"), "row_id")).alias("band"), S.seeded_order("s4", F.col("row_id")).alias("r"))
    return S.top_per_group(rows, ["year"], [F.desc("band"), F.asc("r"), F.asc("row_id")], 5).select("year", "row_id", "band", "place")


@R.add("SELECT section, least(greatest(count(*) // 10, 1), 50)::BIGINT AS shown FROM published GROUP BY section")
def t15_clamped_limit(t):
    """How many rows of a section are shown: a tenth, between 1 and 50."""
    return t.published.groupBy("section").agg(F.least(F.greatest(F.floor(F.count(F.lit(1)) / 10), F.lit(1)), F.lit(50)).cast("bigint").alias("shown"))


@R.add(f"""
WITH k AS (SELECT p.row_id, p.year, {W} AS w, coalesce(m, 13) AS m, coalesce(d, 32) AS d FROM published p JOIN ({SQL_MD}) md USING (row_id) WHERE p.kind = 'event' AND p.text IS NOT NULL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY w DESC, row_id) AS r FROM k) WHERE r <= 3)
SELECT year, string_agg(row_id::VARCHAR, ',' ORDER BY m, d, row_id) AS lead FROM b GROUP BY year""")
def t16_lead(t):
    """The three events of highest weight of each year, shown in calendar order."""
    rows = weighted(t).where("kind = 'event' and text is not null").select("row_id", "w").join(dated(t).select("row_id", "year", "month", "day"), "row_id")
    best = S.top_per_group(rows, ["year"], [F.desc("w"), F.asc("row_id")], 3)
    shown = F.array_sort(F.collect_list(F.struct(F.coalesce("month", F.lit(13)).alias("m"), F.coalesce("day", F.lit(32)).alias("d"), "row_id")))
    return best.groupBy("year").agg(F.array_join(F.transform(shown, lambda x: x.row_id.cast("string")), ",").alias("lead"))


# set operations and deduplication


@R.add("SELECT page_id, min(row_id) AS row_id FROM published WHERE text IS NOT NULL GROUP BY page_id, left(lower(text), 120)")
def d01_first_wins(t):
    """The first row of a page for each beginning of a text."""
    return t.published.where("text is not null").groupBy("page_id", F.left(F.lower("text"), F.lit(120)).alias("k")).agg(F.min("row_id").alias("row_id")).drop("k")


SQL_KEY = "trim(regexp_replace(regexp_replace(lower(text), '^(january|february|march|april|may|june|july|august|september|october|november|december) [0-9]+( [–—-]|,|:)? ', ''), '[^a-z0-9]+', ' ', 'g'))"


def twin_key():
    lead = r"^(january|february|march|april|may|june|july|august|september|october|november|december) [0-9]+( [–—-]|,|:)? "
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), lead, ""), "[^a-z0-9]+", " "))


@R.add(f"SELECT page_id, row_id FROM (SELECT page_id, row_id, row_number() OVER (PARTITION BY page_id, {SQL_KEY} ORDER BY length(text) DESC, row_id) AS k FROM published WHERE text IS NOT NULL) WHERE k = 1")
def d02_twin_fold(t):
    """Of a page's rows that differ only in a leading date or in signs, the longest."""
    rows = t.published.where("text is not null").select("page_id", "row_id", twin_key().alias("k"), F.length("text").alias("n"))
    return rows.groupBy("page_id", "k").agg(F.max_by("row_id", F.struct("n", -F.col("row_id"))).alias("row_id")).drop("k")


@R.add(f"SELECT page_id, {SQL_KEY} AS key, count(*) AS n FROM published WHERE text IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def d03_duplicates(t):
    """Normalised texts that occur more than once on a page."""
    return t.published.where("text is not null").groupBy("page_id", twin_key().alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@R.add("""
SELECT 'a' AS side, x.* FROM (SELECT year, kind FROM published WHERE prominence > 1 EXCEPT ALL SELECT year, kind FROM published WHERE date IS NOT NULL) x
UNION ALL SELECT 'b', x.* FROM (SELECT year, kind FROM published WHERE date IS NOT NULL EXCEPT ALL SELECT year, kind FROM published WHERE prominence > 1) x""")
def d04_multiset_difference(t):
    """Rows that one of two multisets has more often than the other, both ways."""
    a, b = (t.published.where(c).select("year", "kind") for c in ("prominence > 1", "date is not null"))
    side = lambda name, x: x.select(F.lit(name).alias("side"), "year", "kind")
    return side("a", a.exceptAll(b)).unionByName(side("b", b.exceptAll(a)))


@R.add("SELECT row_id, site, text FROM published WHERE site <> 'annals-ninax.example' UNION ALL SELECT row_id, site, upper(text) FROM published WHERE site = 'annals-ninax.example'")
def d05_replace_by_source(t):
    """All rows, those of one source replaced by a new delivery."""
    site = "annals-ninax.example"
    new = t.published.where(F.col("site") == site).select("row_id", "site", F.upper("text").alias("text"))
    return t.published.where(F.col("site") != site).select("row_id", "site", "text").unionByName(new)


@R.add("SELECT row_id FROM published WHERE contains(lower(text), 'council') INTERSECT SELECT row_id FROM published WHERE contains(lower(text), 'reign')")
def d06_intersect(t):
    """Rows of both of two searches."""
    hit = lambda w: t.published.where(F.contains(F.lower("text"), F.lit(w))).select("row_id")
    return hit("council").intersect(hit("reign"))


@R.add("SELECT year, lower(split_part(text, ',', 1)) AS name, min(row_id) AS row_id FROM published WHERE kind = 'birth' AND text IS NOT NULL GROUP BY 1, 2")
def d07_births_by_name(t):
    """Births, each name before the first comma once a year."""
    return t.published.where("kind = 'birth' and text is not null").groupBy("year", F.lower(F.split_part("text", F.lit(","), F.lit(1))).alias("name")).agg(F.min("row_id").alias("row_id"))


@R.add("SELECT DISTINCT claim_id, year, date FROM published")
def d08_statements(t):
    """Statements, each once by claim and time."""
    return t.published.select("claim_id", "year", "date").dropDuplicates()


@R.add("""
WITH alias AS (SELECT alias, min(label) AS target FROM (SELECT unnest(also_known_as) AS alias, label FROM subjects) WHERE alias NOT IN (SELECT label FROM subjects) GROUP BY alias)
SELECT DISTINCT row_id, coalesce(target, link) AS target FROM (SELECT row_id, unnest(links) AS link FROM published) LEFT JOIN alias ON alias = link""")
def d09_alias_merge(t):
    """Links resolved to their subjects, each once per row."""
    labels = t.subjects.select(F.col("label").alias("alias")).distinct()
    alias = t.subjects.select(F.explode("also_known_as").alias("alias"), "label").join(labels, "alias", "left_anti").groupBy("alias").agg(F.min("label").alias("target"))
    links = t.published.select("row_id", F.explode("links").alias("alias"))
    return links.join(alias, "alias", "left").select("row_id", F.coalesce("target", "alias").alias("target")).distinct()
