"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoflow.functions import timeaxis as T
from chronoflow.operators import aggregates as A
from chronoflow.queries.registry import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

CENTURY = "(CASE WHEN year > 0 THEN year // 100 + 1 ELSE -((1 - year) // 100 + 1) END)::INTEGER"
DECADE = "(CASE WHEN year > 0 THEN year // 10 * 10 ELSE -((1 - year) // 10 * 10 + 10) END)::INTEGER"
COUNTRY = "nullif(lower(trim(country)), '')"


def country():
    name = F.lower(F.trim("country"))
    return F.when(name != "", name)


@R.add("SELECT l AS link, count(DISTINCT year) AS prominence FROM (SELECT unnest(links) AS l, year FROM published) WHERE NOT regexp_matches(l, '^[0-9]') GROUP BY l")
def a01_prominence(t):
    """Distinct years per linked subject, date-like links left out."""
    return A.prominence(t.published, "links", "year", ~F.col("link").rlike("^[0-9]"))


@R.add("SELECT section, kind, count(*) AS n FROM published GROUP BY section, kind")
def a02_theme_counts(t):
    """Rows per theme and kind."""
    return t.published.groupBy("section", "kind").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"SELECT kind, count(*) AS n, count(DISTINCT {COUNTRY}) AS countries, min(year) AS first_year, max(year) AS last_year FROM published GROUP BY kind")
def a03_totals(t):
    """Totals by kind: rows, countries, span."""
    return t.published.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(country()).alias("countries"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


@R.add(f"""
WITH d AS (SELECT {DECADE} AS decade, {CENTURY} AS century, count(*) AS entries FROM published GROUP BY 1, 2 HAVING count(*) >= 12),
c AS (SELECT {CENTURY} AS century FROM published GROUP BY 1 HAVING count(*) >= 20)
SELECT decade, entries, c.century AS parent FROM d LEFT JOIN c USING (century)""")
def a04_decade_hubs(t):
    """Decades with at least 12 rows; the century above only if it has at least 20."""
    rows = t.published.select(T.decade(F.col("year")).alias("decade"), T.century(F.col("year")).alias("century"))
    centuries = A.with_floor(rows, ["century"], 20).select("century", F.col("century").alias("parent"))
    return A.with_floor(rows, ["decade", "century"], 12).join(centuries, "century", "left").select("decade", "entries", "parent")


@R.add(f"SELECT section, {CENTURY} AS century, count(*) AS entries FROM published WHERE section IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 8")
def a04_topic_centuries(t):
    """Topic and century pages with at least 8 rows."""
    return A.with_floor(t.published.where("section is not null").withColumn("century", T.century(F.col("year"))).select("section", "century"), ["section", "century"], 8)


@R.add(f"SELECT {COUNTRY} AS place, count(*) AS entries, count(DISTINCT year) AS years FROM published WHERE {COUNTRY} IS NOT NULL GROUP BY 1 HAVING count(*) >= 12")
def a04_places(t):
    """Countries with at least 12 rows."""
    return A.with_floor(t.published.withColumn("place", country()).where("place is not null"), ["place"], 12, F.count_distinct("year").alias("years"))


@R.add(f"""
SELECT {CENTURY} AS century, {DECADE} AS decade, count(*) AS entries FROM published GROUP BY ROLLUP (1, 2)""")
def a04_rollup(t):
    """Rows by century and decade with subtotals."""
    return t.published.select(T.century(F.col("year")).alias("century"), T.decade(F.col("year")).alias("decade")).rollup("century", "decade").agg(F.count(F.lit(1)).alias("entries"))


MONTH_ARRAY = "['January','February','March','April','May','June','July','August','September','October','November','December']"
SQL_MD = f"""SELECT row_id, kind, year,
  list_position({MONTH_ARRAY}, coalesce(nullif(regexp_extract(trim(date), '^([A-Z][a-z]+)\\s+(\\d{{1,2}})\\b', 1), ''), nullif(regexp_extract(trim(date), '^(\\d{{1,2}})\\s+([A-Z][a-z]+)\\b', 2), ''), regexp_extract(trim(date), '^([A-Z][a-z]+)\\b', 1))) AS m,
  CASE WHEN list_position({MONTH_ARRAY}, regexp_extract(trim(date), '^([A-Z][a-z]+)\\s+(\\d{{1,2}})\\b', 1)) > 0 THEN try_cast(regexp_extract(trim(date), '^([A-Z][a-z]+)\\s+(\\d{{1,2}})\\b', 2) AS INTEGER)
       WHEN list_position({MONTH_ARRAY}, regexp_extract(trim(date), '^(\\d{{1,2}})\\s+([A-Z][a-z]+)\\b', 2)) > 0 THEN try_cast(regexp_extract(trim(date), '^(\\d{{1,2}})\\s+([A-Z][a-z]+)\\b', 1) AS INTEGER) END AS d
  FROM published"""


def dated(t):
    return t.published.select("row_id", "kind", "year", T.parse_date(F.col("date")).alias("x")).select("row_id", "kind", "year", "x.month", "x.day")


@R.add(f"""
WITH days AS (SELECT month(x)::INTEGER AS month, day(x)::INTEGER AS day FROM (SELECT unnest(generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS x)),
md AS ({SQL_MD})
SELECT days.month, days.day, count(*) FILTER (kind = 'event') AS events, count(*) FILTER (kind = 'birth') AS births, count(*) FILTER (kind = 'death') AS deaths, count(DISTINCT year) AS years
FROM days LEFT JOIN md ON md.m = days.month AND md.d = days.day GROUP BY 1, 2""")
def a05_calendar_days(t):
    """All 366 days of a year with their events, births and deaths, empty days too."""
    days = t.spark.sql("select month(x) as month, day(x) as day from (select explode(sequence(date'2000-01-01', date'2000-12-31')) as x)")
    of = lambda k: F.count_if(F.col("kind") == k).alias(f"{k}s")
    return days.join(dated(t), ["month", "day"], "left").groupBy("month", "day").agg(of("event"), of("birth"), of("death"), F.count_distinct("year").alias("years"))


def monthly(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.round(F.avg("o_totalprice"), 4).alias("value"), F.count(F.lit(1)).alias("orders"))


SQL_MONTHLY = "SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, round(avg(o_totalprice), 4) AS value, count(*) AS orders FROM orders GROUP BY 1, 2"


@R.add(f"SELECT year, count(value) AS n, round(avg(value::DECIMAL(20,6)), 2)::DOUBLE AS mean FROM ({SQL_MONTHLY}) GROUP BY year HAVING count(value) >= 11")
def a06_annual_mean(t):
    """Annual means of a monthly series that may miss one month."""
    return A.complete_mean(monthly(t), "year", "value", 11, 2)


@R.add(f"SELECT year, count(value) AS n, round(avg(value::DECIMAL(20,6)), 1)::DOUBLE AS mean FROM ({SQL_MONTHLY}) WHERE year < 2001 GROUP BY year HAVING count(value) = 12")
def a07_complete_years(t):
    """Annual means of exactly twelve months, before the current year."""
    return A.complete_mean(monthly(t).where("year < 2001"), "year", "value", 12, 1, exact=True)


@R.add("""
SELECT year(d)::INTEGER AS year, count(*) AS days, round(avg(v), 3) AS mean FROM (SELECT o_orderdate::DATE AS d, avg(o_totalprice) AS v FROM orders GROUP BY 1)
GROUP BY year(d) HAVING NOT (year(min(d)) = (SELECT min(year(o_orderdate)) FROM orders) AND dayofyear(min(d)) > 10)""")
def a08_daily_mean(t):
    """Means of daily values per year; a first year that starts after 10 January is left out."""
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.avg("o_totalprice").alias("v"))
    per = days.groupBy(F.year("d").alias("year")).agg(F.count(F.lit(1)).alias("days"), F.round(F.avg("v"), 3).alias("mean"), F.min("d").alias("start"))
    first = t.orders.agg(F.min(F.year("o_orderdate"))).scalar()
    return per.where(~((F.col("year") == first) & (F.dayofyear("start") > 10))).drop("start")


@R.add("""
SELECT year, title, weeks, row_number() OVER (PARTITION BY year ORDER BY first, title)::INTEGER AS place
FROM (SELECT year(o_orderdate)::INTEGER AS year, o_orderpriority AS title, count(*) AS weeks, min(o_orderdate) AS first FROM orders GROUP BY 1, 2)""")
def a09_runs_in_first_seen_order(t):
    """Counts per title and year, numbered in the order in which they first occur."""
    from pyspark.sql import Window

    per = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("title")).agg(F.count(F.lit(1)).alias("weeks"), F.min("o_orderdate").alias("first"))
    return per.withColumn("place", F.row_number().over(Window.partitionBy("year").orderBy("first", "title"))).drop("first")


@R.add("""
WITH x AS (SELECT unnest(links) AS link, year, coalesce(section, '') AS section FROM published), s AS (SELECT link, section, count(*) AS c FROM x GROUP BY 1, 2)
SELECT a.link, a.entries, a.years, a.first_year, a.last_year, b.topics FROM
 (SELECT link, count(*) AS entries, count(DISTINCT year) AS years, min(year) AS first_year, max(year) AS last_year FROM x GROUP BY link) a
 JOIN (SELECT link, string_agg(section || ':' || c, '|' ORDER BY c DESC, section) AS topics FROM s GROUP BY link) b USING (link)""")
def a10_entity_rollup(t):
    """Entries, years, span and topic histogram of every linked entity."""
    x = t.published.select(F.explode("links").alias("link"), "year", F.coalesce("section", F.lit("")).alias("section"))
    topics = x.groupBy("link", "section").agg(F.count(F.lit(1)).alias("c"))
    topics = topics.groupBy("link").agg(F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("n"), "section"))).alias("h"))
    topics = topics.select("link", F.array_join(F.transform("h", lambda s: F.concat(s.section, F.lit(":"), (-s.n).cast("string"))), "|").alias("topics"))
    return x.groupBy("link").agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("year").alias("years"), F.min("year").alias("first_year"), F.max("year").alias("last_year")).join(topics, "link")


@R.add(f"""
SELECT key, label, n FROM (SELECT {COUNTRY} AS key, country AS label, count(*) AS n, row_number() OVER (PARTITION BY {COUNTRY} ORDER BY count(*) DESC, country) AS r
FROM published WHERE {COUNTRY} IS NOT NULL GROUP BY 1, 2) WHERE r = 1""")
def a11_stand_in_label(t):
    """The most frequent spelling of each country."""
    return A.most_frequent(t.published.withColumn("k", country()).where("k is not null"), F.col("k"), "country")


SQL_NORM = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"


@R.add(f"SELECT {SQL_NORM} AS norm, count(DISTINCT year) AS years FROM published WHERE {SQL_NORM} <> '' GROUP BY 1 HAVING count(DISTINCT year) > 1")
def a12_cross_year_duplicates(t):
    """Normalised texts that occur in more than one year."""
    norm = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    return t.published.select(norm.alias("norm"), "year").where("norm <> ''").groupBy("norm").agg(F.count_distinct("year").alias("years")).where("years > 1")


SQL_TOKENS = "SELECT row_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{3,}'))) AS token FROM published WHERE text IS NOT NULL"


def tokens(t):
    return t.published.select("row_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]{3,}"), F.lit(0)))).alias("token"))


@R.add(f"SELECT token, count(*) AS df FROM ({SQL_TOKENS}) GROUP BY token HAVING count(*) <= (SELECT count(*) // 5 FROM published)")
def a13_document_frequency(t):
    """Documents per token, of tokens in at most a fifth of all."""
    most = t.published.agg(F.floor(F.count(F.lit(1)) / 5)).scalar()
    return tokens(t).groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= most)


@R.add(f"SELECT token, round(ln((SELECT count(*) FROM published)::DOUBLE / (1 + count(*))), 6) AS idf FROM ({SQL_TOKENS}) GROUP BY token")
def a14_idf(t):
    """ln(n / (1 + df)) of every token."""
    n = t.published.agg(F.count(F.lit(1))).scalar()
    return tokens(t).groupBy("token").agg(F.count(F.lit(1)).alias("df")).select("token", F.round(F.log(n / (1 + F.col("df"))), 6).alias("idf"))


SQL_EXPECTED = "CASE section WHEN 'Births' THEN 'birth' WHEN 'Deaths' THEN 'death' ELSE 'event' END"


@R.add(f"SELECT {SQL_EXPECTED} AS expected, kind AS got, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY {SQL_EXPECTED}), 6) AS share FROM published WHERE section IS NOT NULL GROUP BY 1, 2")
def a15_confusion(t):
    """Kinds expected from the heading against those recorded, with shares."""
    from pyspark.sql import Window

    expected = F.when(F.col("section") == "Births", "birth").when(F.col("section") == "Deaths", "death").otherwise("event")
    n = t.published.where("section is not null").groupBy(expected.alias("expected"), F.col("kind").alias("got")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("expected")), 6))


@R.add(f"SELECT {COUNTRY} AS country, count(*) AS n FROM published WHERE {COUNTRY} IS NOT NULL GROUP BY 1 ORDER BY n DESC, country LIMIT 20")
def a16_top_countries(t):
    """The twenty countries with most rows (a top-k report)."""
    return t.published.select(country().alias("country")).where("country is not null").groupBy("country").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "country").limit(20)


@R.add("""
WITH a AS (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS period, count(*)::DOUBLE AS value FROM orders GROUP BY 1),
b AS (SELECT year(l_shipdate) * 100 + month(l_shipdate) AS period, count(*) / 4.0::DOUBLE AS value FROM lineitem GROUP BY 1),
j AS (SELECT period, round(abs(a.value - b.value), 6) AS d FROM a JOIN b USING (period))
SELECT count(*) AS n, max(d) AS max_diff, (SELECT min(period) FROM j WHERE d = (SELECT max(d) FROM j))::INTEGER AS worst, count(*) FILTER (d > 20 + 1e-12) AS beyond, count(*) > 0 AND count(*) FILTER (d > 20 + 1e-12) = 0 AS passed FROM j""")
def a17_cross_check(t):
    """Two monthly series held against each other within a tolerance."""
    period = lambda c: (F.year(c) * 100 + F.month(c)).alias("period")
    a = t.orders.groupBy(period("o_orderdate")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    b = t.lineitem.groupBy(period("l_shipdate")).agg((F.count(F.lit(1)) / 4.0).alias("value"))
    return A.cross_check(a, b, "period", "value", 20)


@R.add(f"WITH m AS ({SQL_MONTHLY}) SELECT year, month, round(value - avg(CASE WHEN year BETWEEN 1996 AND 1998 THEN value END) OVER (PARTITION BY month), 4) AS anomaly FROM m")
def a18_rebaseline(t):
    """A monthly series as differences from its calendar month's mean over the base years."""
    return A.rebaselined(monthly(t), F.col("month"), "value", F.col("year").between(1996, 1998), ["month"]).select("year", "month", "anomaly")


@R.add(f"""
WITH m AS ({SQL_MONTHLY}), y AS (SELECT year, avg(value) AS v FROM m GROUP BY year)
SELECT year, round(min((value - v) / v * 100), 4) AS least, round(max((value - v) / v * 100), 4) AS most FROM m JOIN y USING (year) GROUP BY year""")
def a19_percent_range(t):
    """Least and greatest percent difference of a year's months from its mean."""
    m = monthly(t)
    y = m.groupBy("year").agg(F.avg("value").alias("v"))
    d = (F.col("value") - F.col("v")) / F.col("v") * 100
    return m.join(y, "year").groupBy("year").agg(F.round(F.min(d), 4).alias("least"), F.round(F.max(d), 4).alias("most"))


@R.add("""
WITH have AS (SELECT DISTINCT year, (row_id % 12 + 1)::INTEGER AS month FROM published), grid AS (SELECT year, m AS month FROM (SELECT DISTINCT year FROM have), (SELECT unnest(generate_series(1, 12)) AS m))
SELECT year, string_agg(month::VARCHAR, ',' ORDER BY month) AS missing FROM grid ANTI JOIN have USING (year, month) GROUP BY year""")
def a20_missing_months(t):
    """The months without data of every year with some."""
    return A.missing_periods(t.published.select("year", (F.col("row_id") % 12 + 1).cast("int").alias("month")), "year", "month")


@R.add("""
WITH x AS (SELECT year, kind, try_cast(regexp_extract(source_title, '^(\\d+)', 1) AS INTEGER) AS guess FROM published), e AS (SELECT kind, (guess = year)::INTEGER AS ok, abs(guess - year) AS err, (abs(guess - year) <= 1)::INTEGER AS near FROM x WHERE guess IS NOT NULL)
SELECT round(avg(ok), 6) AS accuracy, (SELECT round(avg(a), 6) FROM (SELECT avg(ok) AS a FROM e GROUP BY kind)) AS macro, round(avg(near), 6) AS within_one, median(err)::DOUBLE AS median_error, round(avg(err), 6) AS mean_error FROM e""")
def a22_metrics(t):
    """Accuracy over all items and as the mean of the types', within one, median and mean error."""
    guess = F.regexp_extract("source_title", r"^(\d+)", 1).try_cast("int")
    e = t.published.select("kind", "year", guess.alias("guess")).where("guess is not null")
    e = e.select("kind", (F.col("guess") == F.col("year")).cast("int").alias("ok"), F.abs(F.col("guess") - F.col("year")).alias("err"))
    macro = e.groupBy("kind").agg(F.avg("ok").alias("a")).agg(F.round(F.avg("a"), 6)).scalar()
    one = e.agg(F.round(F.avg("ok"), 6).alias("accuracy"), F.round(F.avg((F.col("err") <= 1).cast("int")), 6).alias("within_one"), F.median("err").alias("median_error"), F.round(F.avg("err"), 6).alias("mean_error"))
    return one.withColumn("macro", macro)


@R.add("SELECT date_trunc('month', ts)::DATE AS month, user_id, sum(round(value * 1000000)::BIGINT)::BIGINT AS micros, count(*) AS calls FROM events GROUP BY 1, 2")
def a23_spend(t):
    """Monthly spend per user in millionths."""
    return t.events.groupBy(F.trunc(F.to_date("ts"), "month").alias("month"), "user_id").agg(F.sum(F.round(F.col("value") * 1000000).cast("bigint")).alias("micros"), F.count(F.lit(1)).alias("calls"))


@R.add("SELECT source.site AS site, min(year) AS first_year, max(year) AS last_year, round(avg(year), 4) AS mean_year, epoch_us(max(source.retrieved)) AS newest FROM articles GROUP BY 1")
def a24_spans(t):
    """Span of years and newest retrieval of every site."""
    return t.articles.groupBy(F.col("source.site").alias("site")).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.round(F.avg("year"), 4).alias("mean_year"), F.unix_micros(F.max("source.retrieved")).alias("newest"))


@R.add("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def a25_pricing_summary(t):
    """Sums and means of a large fact table by two flags."""
    p = F.col("l_extendedprice")
    return (
        t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(p), 2).alias("sum_price"), F.round(F.sum(p * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))
    )
