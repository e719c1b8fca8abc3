"""Queries through sources, sinks and streams: each writes in the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoflow.functions.timeaxis import ordinal, typed_statement
from chronoflow.plans.staging import Stage
from chronoflow.queries.aggregates import SQL_MD, dated
from chronoflow.queries.registry import Registry
from chronoflow.sources import files as X
from chronoflow.sources.batched import BatchedLookup
from chronoflow.streaming import limits as L

R = Registry()
QUERIES, SQL = R.queries, R.sql


@R.add("SELECT year AS key, row_id, text FROM published WHERE kind = 'birth'")
def s01_json_per_key(t):
    """Births written as one JSON folder per year and read back with the key from the path (s01, k01)."""
    path = Stage(t.spark, "io").path("pages")
    X.write_json_per_key(t.published.where("kind = 'birth'").select("year", "row_id", "text"), path, "year")
    return X.json_per_key(t.spark, path, "row_id bigint, text string").select("key", "row_id", "text")


_NTH = "({0})::VARCHAR || CASE WHEN ({0}) % 100 BETWEEN 11 AND 13 THEN 'th' WHEN ({0}) % 10 = 1 THEN 'st' WHEN ({0}) % 10 = 2 THEN 'nd' WHEN ({0}) % 10 = 3 THEN 'rd' ELSE 'th' END"
SQL_ORD, SQL_MIL = _NTH.format("(-year) // 100 + 1"), _NTH.format("(1 - year) // 1000")


@R.add(f"""
WITH y AS (SELECT DISTINCT year FROM published), c AS (SELECT year, CASE WHEN year BETWEEN 1 AND 9 THEN [year || ' (year)', 'AD ' || year, '0s'] WHEN year < 1 THEN [(1 - year) || ' BC', {SQL_ORD} || ' century BC'] || CASE WHEN (1 - year) % 1000 = 0 THEN [{SQL_MIL} || ' millennium BC'] ELSE [] END WHEN year < 100 THEN ['AD ' || year, year::VARCHAR] ELSE [year::VARCHAR, 'AD ' || year] END AS t FROM y)
SELECT year, unnest(range(len(t)))::INTEGER AS rank, unnest(t) AS title FROM c""")
def s02_candidate_titles(t):
    """Titles under which a year's article may stand, best first."""
    y, s = F.col("year"), F.col("year").cast("string")
    ad = F.concat(F.lit("AD "), s)
    titles = (
        F.when(y.between(1, 9), F.array(F.concat(s, F.lit(" (year)")), ad, F.lit("0s")))
        .when(y < 1, F.concat(F.array(F.concat((1 - y).cast("string"), F.lit(" BC")), F.concat(ordinal(F.floor(-y / 100) + 1), F.lit(" century BC"))), F.when((1 - y) % 1000 == 0, F.array(F.concat(ordinal(F.floor((1 - y) / 1000)), F.lit(" millennium BC")))).otherwise(F.array().cast("array<string>"))))
        .when(y < 100, F.array(ad, s))
        .otherwise(F.array(s, ad))
    )
    return t.published.select("year").distinct().select("year", F.posexplode(titles).alias("rank", "title"))


@R.add("SELECT alias AS key, min(label) AS resolved, min(entries)::VARCHAR AS value, 1 AS hops FROM (SELECT unnest(also_known_as) AS alias, label, entries FROM (SELECT * FROM subjects WHERE label IN (SELECT label FROM subjects GROUP BY label HAVING count(*) = 1))) WHERE alias NOT IN (SELECT label FROM subjects) GROUP BY alias HAVING count(*) = 1")
def s07_batched_lookup(t):
    """Aliases looked up fifty at a time, redirects followed (s03, s07)."""
    t.spark.dataSource.register(BatchedLookup)
    stage = Stage(t.spark, "io")
    once = t.subjects.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("entries").alias("entries"), F.first("also_known_as").alias("also_known_as")).where("n = 1")
    alias = once.select(F.explode("also_known_as").alias("key"), "label").join(t.subjects.select(F.col("label").alias("key")), "key", "left_anti")
    alias = alias.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("target")).where("n = 1")
    store = once.select(F.col("label").alias("key"), F.lit(None).cast("string").alias("target"), F.col("entries").cast("string").alias("value")).unionByName(alias.select("key", "target", F.lit(None).cast("string").alias("value")))
    return t.spark.read.format("batched_lookup").option("path", stage.write_path(store, "store")).option("keys", stage.write_path(alias.select("key"), "keys")).option("batch", "50").load()


_FL = "floor(({0})::DOUBLE / {1})::BIGINT"
_JDN = "(d + " + _FL.format(f"153 * (m + 12 * {_FL.format('14 - m', 12)} - 3) + 2", 5) + f" + 365 * y0 + {_FL.format('y0', 4)} - {_FL.format('y0', 100)} + {_FL.format('y0', 400)} - 32045)"
SQL_STATEMENTS = f"""
WITH x AS (SELECT DISTINCT links[1] AS name, p.kind, p.year AS y, coalesce(m, 0) AS m, coalesce(d, 0) AS d, CASE WHEN d IS NOT NULL THEN 11 WHEN m IS NOT NULL THEN 10 ELSE 9 END AS precision FROM published p JOIN ({SQL_MD}) USING (row_id) WHERE p.kind IN ('birth', 'death') AND len(links) > 0 AND p.year IS NOT NULL AND links[1] IS NOT NULL),
j AS (SELECT *, precision = 11 AND y < 1583 AS julian, y + 4800 - {_FL.format('14 - m', 12)} AS y0 FROM x),
c AS (SELECT *, {_JDN} + 32082 AS c FROM j), e AS (SELECT *, {_FL.format('4 * c + 3', 1461)} AS dd FROM c), f AS (SELECT *, c - {_FL.format('1461 * dd', 4)} AS ee FROM e), g AS (SELECT *, {_FL.format('5 * ee + 2', 153)} AS mm FROM f)
SELECT DISTINCT name, kind, (CASE WHEN julian THEN dd - 4800 + {_FL.format('mm', 10)} ELSE y END)::INTEGER AS year, (CASE WHEN julian THEN mm + 3 - 12 * {_FL.format('mm', 10)} ELSE m END)::INTEGER AS month, (CASE WHEN julian THEN ee - {_FL.format('153 * mm + 2', 5)} + 1 ELSE d END)::INTEGER AS day, precision FROM g"""


@R.add(SQL_STATEMENTS)
def s08_statements(t):
    """Births and deaths as typed statements: signed year, precision, days before the reform in the Julian calendar; repeated ones once."""
    x = dated(t).where("kind in ('birth', 'death') and year is not null").join(t.published.select("row_id", F.get("links", 0).alias("name")), "row_id").where("name is not null")
    two = lambda c: F.lpad(F.coalesce(F.col(c), F.lit(0)).cast("string"), 2, "0")
    value = F.concat(F.when(F.col("year") < 0, "-").otherwise("+"), F.lpad(F.abs("year").cast("string"), 4, "0"), F.lit("-"), two("month"), F.lit("-"), two("day"), F.lit("T00:00:00Z"))
    precision = F.when(F.col("day").isNotNull(), 11).when(F.col("month").isNotNull(), 10).otherwise(9)
    return x.select("name", "kind", typed_statement(value, precision, F.col("year") < 1583).alias("s")).where("s is not null").select("name", "kind", "s.*").distinct()


@R.add("SELECT slug, label, ((row_number() OVER (ORDER BY slug) - 1) // 50)::INTEGER AS page FROM subjects")
def s09_pages(t):
    """Subjects read fifty a page, all of them or an error."""
    from chronoflow.sources.batched import Paged, counted

    t.spark.dataSource.register(Paged)
    store = Stage(t.spark, "io").write_path(t.subjects.select("slug", "label").orderBy("slug").coalesce(1), "store")
    pages = counted(t.spark.read.format("paged").option("path", store).option("limit", "50").load())
    return pages.select(F.get_json_object("body", "$.slug").alias("slug"), F.get_json_object("body", "$.label").alias("label"), "page")


@R.add("SELECT strftime(o_orderdate, '%Y-%m') AS period, round(avg(o_totalprice), 2) AS value FROM orders WHERE month(o_orderdate) <> 6 GROUP BY 1")
def s10_csv_series(t):
    """A monthly series through CSV; months given as a dot are missing."""
    path = Stage(t.spark, "io").path("csv")
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.month("o_orderdate").alias("m")).agg(F.round(F.avg("o_totalprice"), 2).alias("v"))
    m.select("period", F.when(F.col("m") == 6, ".").otherwise(F.col("v").cast("string")).alias("value")).write.option("header", "true").csv(path)
    return X.csv_series(t.spark, path)


@R.add("SELECT year(ts)::INTEGER AS year, event_type AS kind, count(*) AS n FROM events WHERE value > 20 GROUP BY 1, 2")
def s12_geojson(t):
    """Large events through GeoJSON with repeated features, counted per year and kind."""
    path = Stage(t.spark, "io").path("geo")
    e = t.events.where("value > 20").select(F.col("event_id").cast("string").alias("id"), F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), F.col("event_type").alias("kind"), F.col("value").alias("size")).alias("properties"), (F.col("event_id") % 4).alias("part"))
    f = e.unionByName(e.where("part < 2")).groupBy("part", F.floor(F.col("id").cast("bigint") / 5000).alias("file")).agg(F.collect_list(F.struct("id", "properties")).alias("features"))
    f.write.partitionBy("part", "file").json(path)  # a feed's file is one document
    return X.geojson(t.spark, path).groupBy(F.year(F.timestamp_millis("time")).alias("year"), "kind").agg(F.count(F.lit(1)).alias("n"))


@R.add("SELECT row_id, claim_id, year, section, weight FROM published WHERE weight IS NOT NULL AND NOT isnan(weight)")
def s13_gz_ndjson(t):
    """Rows through compressed NDJSON (s13, k03)."""
    path = Stage(t.spark, "io").path("dump")
    t.published.where("weight is not null and not isnan(weight)").select("row_id", "claim_id", "year", "section", "weight").write.option("compression", "gzip").json(path)
    return t.spark.read.schema("row_id bigint, claim_id string, year int, section string, weight double").json(path)


@R.add("SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS norm FROM embeddings")
def s14_vector_cache(t):
    """Vectors cached as Parquet with their version; a cache of another version isn't read."""
    stage = Stage(t.spark, "io")
    cache = stage.write(t.embeddings.withColumn("version", F.lit("v1")), "vectors", ["version"])
    kept = cache.where("version = 'v1'")
    return kept.select("vec_id", "label", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")), 4).alias("norm"))


@R.add("SELECT doc_id, kind, md5('s15|' || doc_id) AS r FROM documents ORDER BY r LIMIT 100")
def s15_sample(t):
    """A seeded sample of a hundred documents (a sampling operator)."""
    return t.documents.select("doc_id", "kind", F.md5(F.concat(F.lit("s15|"), F.col("doc_id").cast("string"))).alias("r")).orderBy("r").limit(100)


@R.add("SELECT left(slug, 1) AS bucket, count(*) AS subjects FROM subjects WHERE left(slug, 1) IN ('b', 'k') GROUP BY 1")
def s16_partition_pruning(t):
    """Subjects in folders by first letter, of which only those asked for are read."""
    cache = Stage(t.spark, "io").write(t.subjects.select("slug", F.left("slug", F.lit(1)).alias("bucket")), "subjects", ["bucket"])
    return cache.where("bucket in ('b', 'k')").groupBy("bucket").agg(F.count(F.lit(1)).alias("subjects"))


@R.add("SELECT row_id, link FROM (SELECT row_id, unnest(links) AS link FROM published)")
def k04_export(t):
    """The join table of rows and subjects through zstd Parquet."""
    return Stage(t.spark, "io").write(t.published.select("row_id", F.explode("links").alias("link")), "subject_events")


@R.add("SELECT left(lower(person), 1) AS letter, count(DISTINCT person) AS people, count(*) AS lines FROM stateleaders WHERE person IS NOT NULL GROUP BY 1")
def k07_name_shards(t):
    """Holders sharded by the first letter of their name."""
    rows = t.stateleaders.where("person is not null").select("person", "term_id", F.left(F.lower("person"), F.lit(1)).alias("letter"))
    return Stage(t.spark, "io").write(rows, "holders", ["letter"]).groupBy("letter").agg(F.count_distinct("person").alias("people"), F.count(F.lit(1)).alias("lines"))


@R.add("SELECT ts::DATE AS day, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY 1")
def k08_pivot(t):
    """Daily series side by side."""
    return t.events.groupBy(F.to_date("ts").alias("day")).pivot("event_type", ["view", "click", "purchase"]).count().na.fill(0)


@R.add("SELECT '/timeline/' || slug || '/' AS loc, entries FROM subjects WHERE entries >= 20 UNION ALL SELECT '/' || year, count(*)::INTEGER FROM published GROUP BY year")
def k09_sitemap(t):
    """Addresses of all pages that exist; thin timelines are left out."""
    a = t.subjects.where("entries >= 20").select(F.concat(F.lit("/timeline/"), "slug", F.lit("/")).alias("loc"), "entries")
    return a.unionByName(t.published.groupBy("year").agg(F.count(F.lit(1)).cast("int").alias("entries")).select(F.concat(F.lit("/"), F.col("year").cast("string")).alias("loc"), "entries"))


@R.add("SELECT alias, slug FROM (SELECT alias, slug, entries, row_number() OVER (PARTITION BY alias ORDER BY entries DESC, slug) AS r FROM (SELECT unnest(also_known_as) AS alias, slug, entries FROM subjects)) WHERE r = 1 ORDER BY entries DESC, alias LIMIT 2000")
def k10_redirects(t):
    """The redirect table: aliases of the best covered subjects (a table with a size limit)."""
    return X.redirects(t.subjects.select(F.explode("also_known_as").alias("alias"), "slug", "entries"), "alias", "slug", "entries", 2000)


@R.add("SELECT user_id, arg_max(event_id, (event_type <> 'error')::INTEGER * 1000000000 + event_id) AS event_id FROM events GROUP BY 1")
def k13_latest_ok(t):
    """Of an appended log the last successful entry per key, else the last."""
    stage = Stage(t.spark, "io")
    path = stage.path("log")
    rows = t.events.select("user_id", "event_id", (F.col("event_type") != "error").alias("ok"))
    for part in (0, 1):
        rows.where(F.col("event_id") % 2 == part).write.mode("append").json(path)
    return X.latest_ok(t.spark.read.schema("user_id bigint, event_id bigint, ok boolean").json(path), "user_id", "event_id", "ok").select("user_id", "event_id")


# streams

SQL_LIMIT = "SELECT date_trunc('{0}', ts)::TIMESTAMP AS start, user_id, count(*) AS n, count(*) > {1} AS over FROM events GROUP BY 1, 2"


@R.add(SQL_LIMIT.format("day", 3))
def z01_rate_limit(t):
    """Events per user and day, and whether they exceed the limit."""
    return L.counted(t.events, "ts", "user_id", "1 day", "3 minutes", 3)


@R.add(SQL_LIMIT.format("hour", 2))
def z01_rate_limit_stream(t):
    """The same per hour as a stream in three runs over arriving files; the result is complete when the stream is drained."""
    stage = Stage(t.spark, "stream")
    arriving, out, state = stage.path("arriving"), stage.path("out"), stage.path("state")
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_id")
    schema = rows.schema
    edges = [0, 0.4, 0.8, 1.0]
    marks = rows.select(F.percentile_approx("event_id", edges[1:-1], 1000)).first()[0] or [0, 0]
    bounds = [-1, *marks, 2**62]
    for a, b in zip(bounds, bounds[1:]):
        rows.where((F.col("event_id") > a) & (F.col("event_id") <= b)).write.mode("append").parquet(arriving)
        stream = t.spark.readStream.schema(schema).parquet(arriving)
        query = L.counted(stream, "ts", "user_id", "1 hour", "30 days", 2).writeStream.outputMode("update").option("checkpointLocation", state)
        # each run writes the windows it changed; the last state of a window counts
        query.foreachBatch(lambda df, n: df.withColumn("run", F.lit(n)).write.mode("append").parquet(out)).trigger(availableNow=True).start().awaitTermination()
    done = t.spark.read.parquet(out)
    last = done.groupBy("start", "user_id").agg(F.max_by(F.struct("n", "over"), "run").alias("x"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "user_id", "x.n", "x.over")


@R.add("""
WITH x AS (SELECT event_id, user_id, value, sum(round(value, 2)::DECIMAL(20,2)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spent FROM events)
SELECT event_id, coalesce(spent, 0) < 500 AS allowed FROM x""")
def z02_budget_gate(t):
    """Whether each call still falls within its user's budget."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    spent = F.sum(F.round("value", 2).cast("decimal(20,2)")).over(w)
    return t.events.select("event_id", (F.coalesce(spent, F.lit(0)) < 500).alias("allowed"))


@R.add()
def z03_answer_cache(t):
    """Hits and misses of an answer cache with a time to live, as a stateful stream."""
    stage = Stage(t.spark, "stream")
    arriving, out = stage.write_path(t.events.select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "event_id"), "arriving"), stage.path("out")
    stream = t.spark.readStream.schema(t.spark.read.parquet(arriving).schema).parquet(arriving)
    L.drained(L.cached(stream, "ts", ["user_id", "event_type"], 6 * 3600), out, stage.path("state"))
    return t.spark.read.parquet(out)
