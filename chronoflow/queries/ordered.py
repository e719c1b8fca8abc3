"""Queries on order: windows, islands, packing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoflow.functions import timeaxis as T
from chronoflow.operators import ordered as O
from chronoflow.queries.aggregates import CENTURY, COUNTRY, DECADE, SQL_MD, country, dated
from chronoflow.queries.registry import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql


@R.add(f"SELECT decade, lag(decade) OVER (ORDER BY decade) AS prev, lead(decade) OVER (ORDER BY decade) AS next FROM (SELECT {DECADE} AS decade FROM published GROUP BY 1 HAVING count(*) >= 12)")
def w01_neighbours(t):
    """Previous and next decade among those with enough rows."""
    kept = t.published.select(T.decade(F.col("year")).alias("decade")).groupBy("decade").agg(F.count(F.lit(1)).alias("n")).where("n >= 12").drop("n")
    return O.neighbours(kept.withColumn("all", F.lit(0)), ["all"], "decade").drop("all")


@R.add("""
SELECT user_id, d, gap FROM (SELECT user_id, d, (d - lag(d) OVER (PARTITION BY user_id ORDER BY d))::INTEGER AS gap FROM (SELECT DISTINCT user_id, ts::DATE AS d FROM events))
WHERE gap IS NOT NULL AND gap <> 1""")
def w02_cadence(t):
    """Days on which a user's daily series breaks its cadence."""
    days = t.events.select("user_id", F.to_date("ts").alias("d")).distinct()
    w = Window.partitionBy("user_id").orderBy("d")
    return days.withColumn("gap", F.datediff("d", F.lag("d").over(w))).where("gap is not null and gap <> 1")


@R.add("SELECT claim_id, count(*) AS copies, count(*) FILTER (text IS NULL OR trim(text) = '') AS blank FROM published GROUP BY 1 HAVING count(*) > 1 OR count(*) FILTER (text IS NULL OR trim(text) = '') > 0")
def w03_repeats_and_blanks(t):
    """Repeated or empty entries of the series of claims."""
    return t.published.groupBy("claim_id").agg(F.count(F.lit(1)).alias("copies"), F.count_if(F.col("text").isNull() | (F.trim("text") == "")).alias("blank")).where("copies > 1 or blank > 0")


@R.add("""
WITH y AS (SELECT DISTINCT state_link, person, unnest(years) AS y FROM stateleaders WHERE state_link IS NOT NULL), i AS (SELECT *, y - row_number() OVER (PARTITION BY state_link, person ORDER BY y) AS g FROM y WHERE y IS NOT NULL)
SELECT state_link, person, min(y) AS first, max(y) AS last, count(*) AS n FROM i GROUP BY state_link, person, g""")
def w04_islands(t):
    """Consecutive years of each holder as spans."""
    return O.islands(t.stateleaders.where("state_link is not null").select("state_link", "person", F.explode("years").alias("y")), ["state_link", "person"], "y")


@R.add("SELECT row_id, last_value(date IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS date_in_force FROM published")
def w05_carried_dates(t):
    """The date in force at each row of a page: its own or the last given before."""
    return O.carried(t.published, ["page_id"], ["row_id"], F.col("date"), "date_in_force").select("row_id", "date_in_force")


@R.add(f"""
WITH k AS (SELECT md.row_id, p.page_id, coalesce(m, 13) * 100 + coalesce(d, 0) AS key FROM ({SQL_MD}) md JOIN published p USING (row_id))
SELECT row_id, prev AS before, key FROM (SELECT *, lag(key) OVER (PARTITION BY page_id ORDER BY row_id) AS prev FROM k) WHERE prev > key""")
def w06_order_violations(t):
    """Rows that stand after a later day of their page."""
    keyed = dated(t).join(t.published.select("row_id", "page_id"), "row_id").withColumn("key", F.coalesce("month", F.lit(13)) * 100 + F.coalesce("day", F.lit(0)))
    return O.order_violations(keyed.select("row_id", "page_id", "key"), ["page_id"], "row_id", "key").select("row_id", "before", "key")


@R.add("""
WITH d AS (SELECT year, ((row_number() OVER (ORDER BY year, page_id, row_id) - 1) // 256)::BIGINT AS shard FROM published)
SELECT shard, min(year) AS first_year, max(year) AS last_year, count(*) AS n FROM d GROUP BY shard""")
def w07_shard_spans(t):
    """Span of years of each shard of 256 rows, rows numbered densely by year."""
    d = dense_ids(t.published.select("year", "page_id", "row_id"), ["year", "page_id", "row_id"])
    return d.groupBy(F.floor(F.col("docid") / 256).alias("shard")).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("n"))


def dense_ids(df, order):
    """Dense numbers from 0 in a total order without a single-task window.

    Rows are range-partitioned and numbered within their partition; the partitions' counts (one row
    each) give the offsets.
    """
    from chronoflow.plans.staging import Stage

    stage = Stage(df.sparkSession, "dense")
    parts = stage.write(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "parts")
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    return parts.join(F.broadcast(offsets), "part").withColumn("docid", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1 + F.col("offset")).drop("part", "offset")


@R.add("""
SELECT term_id, state_link, dense_rank() OVER (PARTITION BY state_link ORDER BY first) AS k FROM (SELECT term_id, state_link, min(term_id) OVER (PARTITION BY state_link, office) AS first FROM stateleaders WHERE state_link IS NOT NULL)""")
def w08_transitions(t):
    """The posts of a state numbered in the order in which they first occur."""
    rows = t.stateleaders.where("state_link is not null")
    first = rows.select("term_id", "state_link", F.min("term_id").over(Window.partitionBy("state_link", "office")).alias("first"))
    return first.select("term_id", "state_link", F.dense_rank().over(Window.partitionBy("state_link").orderBy("first")).cast("bigint").alias("k"))


HOLDER_YEARS = "SELECT DISTINCT state_link, office, person, unnest(years) AS year FROM stateleaders WHERE state_link IS NOT NULL"


def holder_years(t):
    return t.stateleaders.where("state_link is not null").select("state_link", "office", "person", F.explode("years").alias("year")).where("year is not null").distinct()


@R.add(f"""
WITH h AS (SELECT * FROM ({HOLDER_YEARS}) WHERE year IS NOT NULL), s AS (SELECT state_link, quantile_disc(year, 0.1) AS founded, quantile_disc(year, 0.9) AS dissolved FROM h GROUP BY 1),
n AS (SELECT person, year, count(DISTINCT state_link) AS states FROM h GROUP BY 1, 2)
SELECT h.* FROM h JOIN s USING (state_link) JOIN n USING (person, year) WHERE h.year BETWEEN founded AND dissolved OR states = 1""")
def w09_lifespan_trim(t):
    """Holder years within a state's lifespan, and those outside it that no other state has."""
    h = holder_years(t)
    span = h.groupBy("state_link").agg(F.expr("percentile_disc(0.1) within group (order by year)").cast("int").alias("founded"), F.expr("percentile_disc(0.9) within group (order by year)").cast("int").alias("dissolved"))
    n = h.groupBy("person", "year").agg(F.count_distinct("state_link").alias("states"))
    return h.join(span, "state_link").join(n, ["person", "year"]).where(F.col("year").between(F.col("founded"), F.col("dissolved")) | (F.col("states") == 1)).select("state_link", "office", "person", "year")


@R.add("""
WITH h AS (SELECT DISTINCT link, row_id FROM (SELECT unnest(links) AS link, row_id FROM published)), n AS (SELECT link, count(*) AS c FROM h GROUP BY 1),
m AS (SELECT a.link AS small, b.link AS large, count(*) AS c FROM h a JOIN h b ON a.row_id = b.row_id AND a.link <> b.link GROUP BY 1, 2)
SELECT DISTINCT small AS link FROM m JOIN n ON n.link = m.small AND n.c = m.c""")
def w10_subset_suppression(t):
    """Subjects all of whose rows are also another subject's."""
    h = t.published.select(F.explode("links").alias("link"), "row_id").distinct()
    n = h.groupBy("link").agg(F.count(F.lit(1)).alias("c"))
    m = h.join(h.withColumnRenamed("link", "large"), "row_id").where("link <> large").groupBy("link", "large").agg(F.count(F.lit(1)).alias("shared"))
    return m.join(n, "link").where("shared = c").select("link").distinct()


@R.add("""
SELECT term_id, row_number() OVER (PARTITION BY state_link ORDER BY first, start NULLS LAST, term_id) AS place
FROM (SELECT term_id, state_link, min(term_id) OVER (PARTITION BY state_link, office) AS first, terms[1][1] AS start FROM stateleaders WHERE state_link IS NOT NULL)""")
def w11_holder_order(t):
    """Holders of a state by post as first seen, then by the start of their term."""
    rows = t.stateleaders.where("state_link is not null").select("term_id", "state_link", F.min("term_id").over(Window.partitionBy("state_link", "office")).alias("first"), F.get(F.get("terms", 0), 0).alias("start"))
    return rows.select("term_id", F.row_number().over(Window.partitionBy("state_link").orderBy("first", F.asc_nulls_last("start"), "term_id")).cast("bigint").alias("place"))


@R.add("""
WITH s AS (SELECT page_id, list(text ORDER BY row_id) AS l FROM published WHERE trim(text) <> '' GROUP BY page_id),
f AS (SELECT page_id, list_reduce(l, lambda a, x: CASE WHEN length(a.open) + length(x) + (a.open <> '')::INTEGER >= 700 THEN {'done': list_append(a.done, a.open || CASE WHEN a.open = '' THEN '' ELSE ' ' END || x), 'open': ''} ELSE {'done': a.done, 'open': a.open || CASE WHEN a.open = '' THEN '' ELSE ' ' END || x} END, {'done': []::VARCHAR[], 'open': ''}) AS r FROM s),
p AS (SELECT page_id, CASE WHEN r.open = '' THEN r.done ELSE list_append(r.done, r.open) END AS ps FROM f)
SELECT page_id, unnest(range(len(ps)))::INTEGER AS place, unnest(ps) AS paragraph FROM p""")
def w12_paragraphs(t):
    """A page's sentences packed into paragraphs of at least 700 characters."""
    return O.packed_paragraphs(t.published.where("trim(text) <> ''").select("page_id", "row_id", "text"), ["page_id"], "row_id", "text", 700)


@R.add(f"""
WITH c AS (SELECT {CENTURY} AS century FROM published GROUP BY 1 HAVING count(*) >= 20), d AS (SELECT {DECADE} AS decade FROM published GROUP BY 1 HAVING count(*) >= 12)
SELECT year, d.decade, c.century FROM (SELECT DISTINCT year, {DECADE} AS dk, {CENTURY} AS ck FROM published) y LEFT JOIN d ON d.decade = dk LEFT JOIN c ON c.century = ck""")
def w13_parents(t):
    """The decade and century page above each year, null where there is none."""
    rows = t.published.select("year", T.decade(F.col("year")).alias("dk"), T.century(F.col("year")).alias("ck"))
    keep = lambda k, n, name: rows.groupBy(k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= n).select(k, F.col(k).alias(name))
    return rows.distinct().join(keep("dk", 12, "decade"), "dk", "left").join(keep("ck", 20, "century"), "ck", "left").select("year", "decade", "century")


@R.add("SELECT upper(left(label, 1)) AS letter, count(*) AS subjects, min(label) AS first_label, max(entries) AS most FROM subjects GROUP BY 1")
def w14_letters(t):
    """Subjects by their first letter."""
    return t.subjects.groupBy(F.upper(F.left("label", F.lit(1))).alias("letter")).agg(F.count(F.lit(1)).alias("subjects"), F.min("label").alias("first_label"), F.max("entries").alias("most"))


@R.add(f"""
SELECT page_id, section, row_id FROM (SELECT page_id, section, row_id, row_number() OVER (PARTITION BY page_id, section ORDER BY row_id) AS k FROM published WHERE section IS NOT NULL AND {COUNTRY} IS NOT NULL) WHERE k = 1""")
def w14_first_items(t):
    """The first item with a country of every section of a page."""
    rows = t.published.where(F.col("section").isNotNull() & country().isNotNull())
    return rows.groupBy("page_id", "section").agg(F.min("row_id").alias("row_id"))


