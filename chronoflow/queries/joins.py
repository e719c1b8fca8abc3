"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoflow.functions import timeaxis as T
from chronoflow.operators import joins as J
from chronoflow.queries.aggregates import COUNTRY, SQL_MD, country, dated
from chronoflow.queries.registry import Registry
from chronoflow.queries.scalars import SQL_DAYS

R = Registry()
QUERIES, SQL = R.queries, R.sql


@R.add("SELECT a.row_id, b.row_id AS twin FROM published a JOIN published b ON a.year = b.year AND a.text = b.text AND a.row_id < b.row_id")
def j01_inner(t):
    """Rows of one year with the same text."""
    a = t.published.select("year", "text", "row_id")
    return a.join(a.withColumnRenamed("row_id", "twin"), ["year", "text"]).where("row_id < twin").select("row_id", "twin")


@R.add("SELECT row_id, link, coalesce(entries, 1) AS prominence, coalesce(slug, link) AS target FROM (SELECT row_id, unnest(links) AS link FROM published) LEFT JOIN (SELECT label, max(entries) AS entries, min(slug) AS slug FROM subjects GROUP BY label) s ON s.label = link")
def j02_left_with_default(t):
    """Links with their subject's data, or defaults."""
    subjects = t.subjects.groupBy("label").agg(F.max("entries").alias("entries"), F.min("slug").alias("slug"))
    links = t.published.select("row_id", F.explode("links").alias("link"))
    return links.join(subjects, F.col("label") == F.col("link"), "left").select("row_id", "link", F.coalesce("entries", F.lit(1)).alias("prominence"), F.coalesce("slug", "link").alias("target"))


@R.add(f"SELECT DISTINCT {COUNTRY} AS place FROM published WHERE {COUNTRY} IS NOT NULL AND {COUNTRY} NOT IN (SELECT lower(place) FROM articles WHERE place IS NOT NULL)")
def j03_anti(t):
    """Countries with rows but no article."""
    places = t.articles.where("place is not null").select(F.lower("place").alias("place"))
    return t.published.select(country().alias("place")).where("place is not null").distinct().join(places, "place", "left_anti")


@R.add("SELECT row_id FROM published WHERE page_id IN (SELECT page_id FROM articles WHERE place IS NULL)")
def j04_semi(t):
    """Rows of plain year pages."""
    return t.published.join(t.articles.where("place is null").select("page_id"), "page_id", "left_semi").select("row_id")


@R.add("""
WITH a AS (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS period, count(*) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS period, count(*) AS v FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT coalesce(a.period, b.period)::INTEGER AS period, CASE WHEN b.v IS NULL THEN 'only left' WHEN a.v IS NULL THEN 'only right' WHEN a.v = b.v THEN 'same' ELSE 'different' END AS status FROM a FULL JOIN b ON a.period = b.period""")
def j05_agreement(t):
    """Two sources of one series: same, different, only in one."""
    of = lambda cond: t.orders.where(cond).groupBy((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("period")).agg(F.count(F.lit(1)).alias("v"))
    return J.agreement(of("o_orderstatus = 'F'"), of("o_orderstatus <> 'P'"), ["period"], "v")


SPANS = "SELECT term_id, continent, t[1] AS s, coalesce(t[2], 2026) AS e, i FROM (SELECT term_id, continent, unnest(terms) AS t, generate_subscripts(terms, 1) AS i FROM stateleaders WHERE continent IS NOT NULL) WHERE t[1] IS NOT NULL AND t[1] <= coalesce(t[2], 2026)"


def spans(t):
    rows = t.stateleaders.where("continent is not null").select("term_id", "continent", F.posexplode("terms").alias("i", "x"))
    out = rows.select("term_id", "continent", F.get("x", 0).alias("s"), F.coalesce(F.get("x", 1), F.lit(2026)).alias("e"), (F.col("i") + 1).cast("bigint").alias("i"))
    return out.where("s is not null and s <= e")


@R.add(f"""
WITH x AS ({SPANS}) SELECT a.term_id AS a, a.i AS ai, b.term_id AS b, b.i AS bi, greatest(a.s, b.s) AS first, least(a.e, b.e) AS last
FROM x a JOIN x b ON a.continent = b.continent AND a.term_id < b.term_id AND abs(a.s - b.s) <= 1 AND abs(a.e - b.e) <= 1 AND a.s <= b.e AND b.s <= a.e""")
def j06_interval(t):
    """Terms of one region both of whose ends are at most a year apart, with their common years."""
    x = spans(t)
    a, b = x.select("continent", F.col("term_id").alias("a"), F.col("i").alias("ai"), F.col("s").alias("s1"), F.col("e").alias("e1")), x.select("continent", F.col("term_id").alias("b"), F.col("i").alias("bi"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    # ends at most a year apart: the starts meet exactly once among a start and its neighbours
    near = b.withColumn("at", F.explode(F.array(F.col("s2") - 1, F.col("s2"), F.col("s2") + 1)))
    met = a.withColumn("at", F.col("s1")).join(near, ["continent", "at"]).where("a < b and abs(e1 - e2) <= 1 and s1 <= e2 and s2 <= e1")
    return met.select("a", "ai", "b", "bi", F.greatest("s1", "s2").alias("first"), F.least("e1", "e2").alias("last"))


AS_OF_LEFT = "SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'"
AS_OF_RIGHT = "SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2"


def sides(t):
    left = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return left, t.events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"))


@R.add(f"WITH l AS ({AS_OF_LEFT}), r AS ({AS_OF_RIGHT}) SELECT l.event_id, r.event_id AS view_id FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.ts")
def j07_as_of_forward(t):
    """Each purchase with the user's first view at or after it."""
    return J.as_of(*sides(t), ["user_id"], "ts", ["view_id"], forward=True).select("event_id", "view_id")


@R.add(f"WITH l AS ({AS_OF_LEFT}), r AS ({AS_OF_RIGHT}) SELECT l.event_id, CASE WHEN l.ts - r.ts <= INTERVAL 4 HOUR THEN r.event_id END AS view_id FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts")
def j08_as_of_tolerance(t):
    """Each purchase with the user's last view in the four hours before."""
    return J.as_of(*sides(t), ["user_id"], "ts", ["view_id"], tolerance=F.expr("ts - as_of <= interval 4 hours")).select("event_id", "view_id")


@R.add(f"WITH l AS ({AS_OF_LEFT}), r AS ({AS_OF_RIGHT}) SELECT l.event_id, r.event_id AS view_id FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts")
def j09_as_of_backward(t):
    """Each purchase with the user's last view before it."""
    return J.as_of(*sides(t), ["user_id"], "ts", ["view_id"]).select("event_id", "view_id")


@R.add(f"""
WITH x AS ({SPANS}), s AS (SELECT slug, first_year, last_year FROM subjects WHERE first_year <= last_year)
SELECT slug, count(*) AS terms, count(DISTINCT continent) AS regions FROM s JOIN x ON x.s <= s.last_year AND s.first_year <= x.e GROUP BY slug""")
def j10_overlap(t):
    """Terms that overlap the years of each subject."""
    s = t.subjects.where("first_year <= last_year").select("slug", "first_year", "last_year")
    return J.overlap_counts(s, spans(t), "continent", ("first_year", "last_year"), ("s", "e")).groupBy("slug").agg(F.sum("n").alias("terms"), F.count(F.lit(1)).alias("regions"))


@R.add(f"""
WITH {SQL_DAYS}, one AS (SELECT row_id, m AS month, d AS day FROM ({SQL_MD}) WHERE d IS NOT NULL AND row_id NOT IN (SELECT row_id FROM days)), both_ AS (SELECT * FROM days UNION ALL SELECT * FROM one)
SELECT month::INTEGER AS month, day::INTEGER AS day, count(DISTINCT row_id) AS rows FROM both_ GROUP BY 1, 2""")
def j11_day_containment(t):
    """Rows whose date, one day or a printed range of days, covers each day of the calendar."""
    x = t.published.select("row_id", T.span_days(F.col("date")).alias("span"), T.parse_date(F.col("date")).alias("one"))
    days = x.select("row_id", F.explode(F.when(F.size("span") > 0, F.col("span")).when(F.col("one.day").isNotNull(), F.array("one"))).alias("x")).select("row_id", "x.month", "x.day")
    return days.groupBy("month", "day").agg(F.count_distinct("row_id").alias("rows"))


@R.add("""
WITH x AS (SELECT DISTINCT row_id, link FROM (SELECT row_id, unnest(links) AS link FROM published)), p AS (SELECT a.link, b.link AS other, count(*) AS n FROM x a JOIN x b ON a.row_id = b.row_id AND a.link <> b.link GROUP BY 1, 2)
SELECT link, other, n, place FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY n DESC, other)::INTEGER AS place FROM p) WHERE place <= 12""")
def j12_co_occurrence(t):
    """The twelve subjects most often named together with each subject."""
    return J.co_occurrence(t.published.select("row_id", F.explode("links").alias("link")), "row_id", "link", 12)


SQL_WORDS = "list_distinct(regexp_extract_all(lower(%s), '[a-z]{4,}'))"


@R.add(f"""
WITH l AS (SELECT slug, first_year AS year, {SQL_WORDS % 'description'} AS w FROM subjects WHERE description IS NOT NULL), r AS (SELECT year, row_id, {SQL_WORDS % 'text'} AS w FROM published WHERE kind = 'birth'),
lt AS (SELECT slug, year, len(w) AS size, unnest(w) AS token FROM l), rt AS (SELECT year, row_id, unnest(w) AS token FROM r),
m AS (SELECT year, slug, size, row_id, count(*) AS shared FROM lt JOIN rt USING (year, token) GROUP BY 1, 2, 3, 4)
SELECT year, slug, row_id, shared, round(shared / size, 6) AS coverage FROM (SELECT *, row_number() OVER (PARTITION BY year, slug ORDER BY shared DESC, row_id) AS k FROM m) WHERE k = 1""")
def j13_best_overlap(t):
    """The birth of a subject's first year that shares most words with its description."""
    w = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{4,}"), F.lit(0)))
    left = t.subjects.where("description is not null").select("slug", F.col("first_year").alias("year"), w("description").alias("lw"))
    right = t.published.where("kind = 'birth'").select("row_id", "year", w("text").alias("rw"))
    return J.best_overlap(left, right, ["year"], "slug", "row_id", "lw", "rw")


@R.add(f"""
WITH y AS (SELECT DISTINCT year FROM published), e AS (SELECT year, count(*) AS rows FROM published GROUP BY 1), a AS (SELECT year, count(*) AS articles FROM articles GROUP BY 1),
h AS (SELECT year, count(*) AS holders FROM (SELECT unnest(years) AS year FROM stateleaders) GROUP BY 1), b AS (SELECT year, count(*) AS births FROM published WHERE kind = 'birth' GROUP BY 1)
SELECT y.year, e.rows, a.articles, h.holders, b.births FROM y LEFT JOIN e USING (year) LEFT JOIN a USING (year) LEFT JOIN h USING (year) LEFT JOIN b USING (year) WHERE coalesce(a.articles, h.holders, b.births) IS NOT NULL""")
def j14_star(t):
    """One record per year from several sources; absent parts stay null, records without any are dropped."""
    n = lambda df, name: df.groupBy("year").agg(F.count(F.lit(1)).alias(name))
    out = n(t.published, "rows").join(n(t.articles, "articles"), "year", "left").join(n(t.stateleaders.select(F.explode("years").alias("year")), "holders"), "year", "left").join(n(t.published.where("kind = 'birth'"), "births"), "year", "left")
    return out.where(F.coalesce("articles", "holders", "births").isNotNull())


@R.add("SELECT a.row_id, b.row_id AS whole FROM published a JOIN published b ON a.page_id = b.page_id AND a.row_id <> b.row_id AND length(trim(b.text)) > 0 AND length(a.text) > length(b.text) AND ends_with(a.text, b.text)")
def j15_suffix(t):
    """Rows whose text ends with another row's of the page (a date was put before it)."""
    # a proper suffix shares its last characters: the equi-join is on page and ending
    rows = t.published.where("length(trim(text)) > 0").select("page_id", "row_id", "text", F.right("text", F.lit(12)).alias("ending"), F.length("text").alias("n"))
    long = rows.where("n >= 12").select("page_id", "ending", F.col("row_id").alias("whole"), F.col("text").alias("other"), F.col("n").alias("m"))
    met = rows.join(long, ["page_id", "ending"]).where("row_id <> whole and n > m and endswith(text, other)").select("row_id", "whole")
    # texts under twelve characters are joined by their own length's ending
    tiny = rows.where("n < 12").select("page_id", F.col("text").alias("ending"), F.col("row_id").alias("whole"))
    sizes = rows.withColumn("ending", F.explode(F.transform(F.sequence(F.lit(1), F.lit(11)), lambda k: F.right("text", k))))
    short = sizes.where(F.length("ending") < F.col("n")).join(tiny, ["page_id", "ending"]).where("row_id <> whole").select("row_id", "whole")
    return met.unionByName(short).distinct()


@R.add("SELECT text, min(row_id) AS row_id FROM published WHERE text IS NOT NULL AND (contains(lower(text), 'bridge') OR contains(lower(text), 'canal')) GROUP BY text")
def j16_evidence_union(t):
    """The rows of two searches, each text once."""
    hit = lambda w: t.published.where(F.contains(F.lower("text"), F.lit(w))).select("text", "row_id")
    return hit("bridge").unionByName(hit("canal")).groupBy("text").agg(F.min("row_id").alias("row_id"))


@R.add(f"""
WITH md AS ({SQL_MD}), y AS (SELECT year, count(*) AS rows FROM published GROUP BY 1)
SELECT md.row_id, md.year, y.rows AS year_rows, (SELECT count(*) FROM stateleaders WHERE list_contains(years, md.year)) AS holders FROM md JOIN y USING (year) WHERE m = 7 AND d = 4""")
def j17_snapshot(t):
    """All rows of one day of the calendar with what is known of their years."""
    rows = dated(t).where("month = 7 and day = 4").select("row_id", "year")
    y = t.published.groupBy("year").agg(F.count(F.lit(1)).alias("year_rows"))
    h = t.stateleaders.select(F.explode(F.array_distinct("years")).alias("year")).groupBy("year").agg(F.count(F.lit(1)).alias("holders"))
    return rows.join(y, "year").join(h, "year", "left").select("row_id", "year", "year_rows", F.coalesce("holders", F.lit(0).cast("bigint")).alias("holders"))


@R.add("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name")
def j18_star_schema(t):
    """A five-way star join: revenue by nation of local suppliers."""
    x = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.supplier, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    x = x.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return x.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


