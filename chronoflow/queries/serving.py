"""Queries on serving, rendering and acceptance: what is shown, mirrored, dispatched and accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoflow.functions import text as X
from chronoflow.functions.timeaxis import MONTHS
from chronoflow.operators import ordered as O
from chronoflow.functions.text import claim_tokens
from chronoflow.operators.claims import coverage, disagreements
from chronoflow.operators.joins import best_overlap
from chronoflow.plans.staging import Stage
from chronoflow.queries.aggregates import SQL_MD, country, dated
from chronoflow.queries.checks import SQL_COVERAGE, SQL_LEDGER
from chronoflow.queries.registry import Registry, Tables
from chronoflow.operators.search import search, stored_postings, write_index
from chronoflow.queries.search import SQL_INDEX, index, sql_norm, sql_search

R = Registry()
QUERIES, SQL = R.queries, R.sql
_M = "|".join(MONTHS)


@R.add("SELECT term_id, CASE WHEN regexp_matches(quote, '\\([^()]*[0-9]{3,4}') THEN try_cast(regexp_extract(quote, '\\([^()]*?([0-9]{3,4})', 1) AS INTEGER) END AS year FROM stateleaders WHERE quote IS NOT NULL")
def f17_statement_years(t):
    """The year of each quoted statement, if it is given to the year."""
    year = F.regexp_extract("quote", r"\([^()]*?([0-9]{3,4})", 1).try_cast("int")
    return t.stateleaders.where("quote is not null").select("term_id", F.when(F.col("quote").rlike(r"\([^()]*[0-9]{3,4}"), year).alias("year"))


@R.add(f"SELECT term_id, array_to_string(list_transform(string_split({sql_norm('person')}, ' '), lambda w: CASE w WHEN '1st' THEN 'i' WHEN '2nd' THEN 'ii' WHEN '3rd' THEN 'iii' ELSE w END), ' ') AS tokens FROM stateleaders WHERE person IS NOT NULL")
def f27_name_tokens(t):
    """Names as tokens, ordinals as Roman numbers."""
    roman = lambda w: F.when(w == "1st", "i").when(w == "2nd", "ii").when(w == "3rd", "iii").otherwise(w)
    return t.stateleaders.where("person is not null").select("term_id", F.array_join(F.transform(F.split(X.norm(F.col("person")), " "), roman), " ").alias("tokens"))


@R.add("SELECT DISTINCT state_link, trim(regexp_replace(regexp_replace(state_link, '\\s*\\([^)]*\\)', '', 'g'), '^(the|The) ', '')) AS phrase FROM stateleaders WHERE state_link IS NOT NULL")
def f28_state_phrases(t):
    """Names of states without brackets and article."""
    phrase = F.trim(F.regexp_replace(F.regexp_replace("state_link", r"\s*\([^)]*\)", ""), "^(the|The) ", ""))
    return t.stateleaders.where("state_link is not null").select("state_link", phrase.alias("phrase")).distinct()


@R.add("SELECT term_id, coalesce(nullif(trim(name), ''), person, state_link, 'unknown') AS shown, coalesce('/entity/' || qid, '/wiki/' || replace(person, ' ', '_')) AS url FROM stateleaders")
def f29_coalesced_names(t):
    """The best name and address there is for each holder."""
    return t.stateleaders.select("term_id", F.coalesce(F.nullif(F.trim("name"), F.lit("")), "person", "state_link", F.lit("unknown")).alias("shown"), F.coalesce(F.concat(F.lit("/entity/"), "qid"), F.concat(F.lit("/wiki/"), F.replace("person", F.lit(" "), F.lit("_")))).alias("url"))


@R.add()
def g19_prose(t):
    """Year pages as prose: date-led sentences packed into paragraphs of 700 characters per section."""
    body = X.as_sentence(X.strip_date_prefix(F.col("text")))
    led = F.when(F.col("date").rlike(rf"^({_M}) [0-9]{{1,2}}$"), F.concat(F.lit("On "), "date", F.lit(", "), body)).otherwise(body)
    rows = t.published.where("section is not null and length(trim(text)) > 0").select("page_id", "section", "row_id", led.alias("said"))
    return O.packed_paragraphs(rows, ["page_id", "section"], "row_id", "said", 700)


@R.add("SELECT slug, label, entries, first_year, last_year FROM subjects")
def k02_mirror(t):
    """A byte-for-byte mirror of the subjects' index, read back."""
    return Stage(t.spark, "io").write(t.subjects.select("slug", "label", "entries", "first_year", "last_year"), "mirror")


@R.add(f"WITH {SQL_INDEX} SELECT left(token, 1) AS bucket, count(DISTINCT token) AS tokens, count(*) AS postings FROM idx GROUP BY 1")
def k05_index_files(t):
    """The index's files by bucket, as written and read back: tokens and postings in each."""
    path = Stage(t.spark, "io").path("index")
    write_index(*index(t), path)
    return stored_postings(t.spark, path).groupBy("bucket").agg(F.count_distinct("token").alias("tokens"), F.sum(F.size("docs").cast("bigint")).alias("postings"))


@R.add("SELECT slug, label, description, entries, last_year - first_year AS span FROM subjects WHERE label IS NOT NULL ORDER BY entries DESC, slug")
def k06_subject_rows(t):
    """Rows of the subject search, weightiest first."""
    return t.subjects.where("label is not null").select("slug", "label", "description", "entries", (F.col("last_year") - F.col("first_year")).alias("span")).orderBy(F.desc("entries"), "slug")


@R.add()
def k11_manifest(t):
    """A manifest of the exported tables: columns and types as a schema inferred from the rows themselves."""
    tables = {"subjects": t.subjects, "published": t.published.select("row_id", "year", "section", "links"), "stateleaders": t.stateleaders.select("term_id", "terms", "years")}
    out = None
    for name, df in tables.items():
        one = df.select(F.parse_json(F.to_json(F.struct(*df.columns))).alias("v")).agg(F.schema_of_variant_agg("v").alias("schema")).select(F.lit(name).alias("name"), "schema")
        out = one if out is None else out.unionByName(one)
    return out


@R.add("SELECT slug, '# ' || label || chr(10) || coalesce(description, '') || chr(10) || entries || ' entries' AS body FROM subjects WHERE label IS NOT NULL")
def k12_plain_artefacts(t):
    """Plain-text pages of subjects."""
    return t.subjects.where("label is not null").select("slug", F.concat(F.lit("# "), "label", F.lit("\n"), F.coalesce("description", F.lit("")), F.lit("\n"), F.col("entries").cast("string"), F.lit(" entries")).alias("body"))


#: Words by which themes are told, in order.
RULES = (("war", "siege|army|truce|garrison|riders"), ("faith", "pilgrims|synod|abbot|shrine"), ("building", "bridge|canal|walls"), ("trade", "merchants|mint|lending"), ("health", "plague|physician|infirmary"), ("disaster", "earthquake|floods|fire in"))


@R.add("SELECT row_id, theme FROM (SELECT row_id, unnest(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '(^|[^a-z])({w})([^a-z]|$)') THEN '{n}' END" for n, w in RULES) + "], lambda x: x IS NOT NULL)) AS theme FROM published WHERE text IS NOT NULL)")
def filter09_lexical_rules(t):
    """All themes whose words each row holds."""
    low = F.lower("text")
    hits = F.array_compact(F.array(*[F.when(low.rlike(f"(^|[^a-z])({w})([^a-z]|$)"), n) for n, w in RULES]))
    return t.published.where("text is not null").select("row_id", F.explode(hits).alias("theme"))


@R.add("""
WITH r AS (SELECT site, 'User-agent: *' || chr(10) || CASE length(site) % 3 WHEN 0 THEN 'Disallow:' WHEN 1 THEN 'Disallow: /w/' ELSE 'Content-Signal: ai-train=no' END AS robots FROM sites)
SELECT site, regexp_matches(robots, '(^|\\n)Disallow:[ ]*[^ \\n]') OR regexp_matches(robots, 'ai-(train|input)=no') AS denied FROM r""")
def filter14_robots(t):
    """Sites whose rules for crawlers deny anything or refuse use for training."""
    k = F.length("site") % 3
    robots = F.concat(F.lit("User-agent: *\n"), F.when(k == 0, "Disallow:").when(k == 1, "Disallow: /w/").otherwise("Content-Signal: ai-train=no"))
    return t.sites.select("site", (robots.rlike(r"(^|\n)Disallow:[ ]*[^ \n]") | robots.rlike("ai-(train|input)=no")).alias("denied"))


def year_facts(t: Tables, year: int) -> DataFrame:
    """One row: entries by kind, holders and the price index of a year; nothing for a year without any."""
    rows = t.published.where(F.col("year") == year).agg(*(F.count_if(F.col("kind") == k).alias(f"{k}s") for k in ("event", "birth", "death")))
    held = t.stateleaders.where(F.array_contains("years", year)).agg(F.count(F.lit(1)).alias("holders"))
    price = t.orders.where(F.year("o_orderdate") == year).agg(F.round(F.avg("o_totalprice"), 2).alias("price"))
    return rows.select(F.lit(year).alias("year"), "*", held.scalar().alias("holders"), price.scalar().alias("price")).where("events + births + deaths + holders > 0 or price is not null")


def in_force(t: Tables, day: str) -> DataFrame:
    """The first issue on or after a day: here of views, the least of its day."""
    issues = t.events.where("event_type = 'view'").where(F.to_date("ts") >= F.to_date(F.lit(day)))
    return issues.agg(F.min(F.struct(F.to_date("ts").alias("issue"), "event_id")).alias("x")).where("x is not null").select("x.*")


def converted(t: Tables, amount: float, of: int, to: int) -> DataFrame:
    """An amount of one year in another's prices; nothing if either year has no price."""
    p = t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.avg("o_totalprice").alias("v")).where(F.col("y").isin(of, to))
    both = p.agg(F.max(F.when(F.col("y") == of, F.col("v"))).alias("a"), F.max(F.when(F.col("y") == to, F.col("v"))).alias("b"))
    return both.where("a is not null and b is not null").select(F.round(amount * F.col("b") / F.col("a"), 2).alias("amount"))


def official_series(t: Tables, status: str) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus") == status).groupBy(F.year("o_orderdate").alias("year")).agg(F.round(F.avg("o_totalprice"), 2).alias("value"))


#: The catalogue: tools by name. Prizes have no table here.
TOOLS = {
    "search_history": lambda t, q, limit=25, first=None, last=None: search(*index(t), {"q": q}, min(max(limit, 1), 200), first, last).select("doc", "score", "place"),
    "get_year": lambda t, year: t.published.where(F.col("year") == year).select("row_id", "section", "text"),
    "get_day": lambda t, month, day: dated(t).where((F.col("month") == month) & (F.col("day") == day)).select("row_id", "year"),
    "get_timeline": lambda t, label: t.published.where(F.array_contains("links", label)).select("row_id", "year", "text"),
    "get_country": lambda t, name: t.published.withColumn("c", country()).where(F.col("c") == name.lower()).select("row_id", "year", "text"),
    "get_year_facts": year_facts,
    "get_leaders": lambda t, year: t.stateleaders.where(F.array_contains("years", year)).select("term_id", "state_link", "name"),
    "get_number_one_song": in_force,
    "convert_dollars": converted,
    "get_world_on_date": lambda t, year, month, day: dated(t).where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)).select("row_id", "kind"),
    "check_claim": lambda t, said: coverage(t.spark.createDataFrame([("c", said)], "claim string, said string").select("claim", claim_tokens(F.col("said"), F.lit(None).cast("int"), F.lit(None).cast("int")).alias("tokens")), t.published.select("row_id", "text")),
    "get_official_series": official_series,
    "get_disagreements": lambda t: disagreements(t.stateleaders),
    "list_subjects": lambda t, least=1: t.subjects.where(F.col("entries") >= least).select("slug", "label", "entries"),
    "list_countries": lambda t: t.countries.select("country", "continent"),
}


def call(t: Tables, tool: str, limit: int | None = None, **given) -> DataFrame:
    """One of the catalogue's tools by name; an unknown name or argument is refused. ``limit`` is clamped to 1..200."""
    if tool not in TOOLS:
        raise ValueError(f"no tool {tool!r}; there are {sorted(TOOLS)}")
    out = TOOLS[tool](t, **given)
    return out if limit is None else out.limit(min(max(limit, 1), 200))


CALLS = (
    ("search_history", {"q": "bridge of stone"}), ("get_year", {"year": 1604}), ("get_day", {"month": 7, "day": 4}), ("get_timeline", {"label": "Zeitam Thaetiath"}), ("get_country", {"name": "Sternrouthland"}), ("get_year_facts", {"year": 1937}),
    ("get_leaders", {"year": 1500}), ("get_number_one_song", {"day": "2024-01-09"}), ("convert_dollars", {"amount": 100.0, "of": 1996, "to": 2000}), ("get_world_on_date", {"year": 1937, "month": 11, "day": 15}), ("check_claim", {"said": "A mint strikes its first silver coin"}),
    ("get_official_series", {"status": "F"}), ("get_disagreements", {}), ("list_subjects", {"least": 10}), ("list_countries", {}),
)


@R.add(f"""
SELECT 'search_history' AS tool, count(*) AS n FROM ({sql_search(25)}) WHERE q = 'bridge' UNION ALL SELECT 'get_year', count(*) FROM published WHERE year = 1604 UNION ALL SELECT 'get_day', count(*) FROM ({SQL_MD}) WHERE m = 7 AND d = 4
UNION ALL SELECT 'get_timeline', count(*) FROM published WHERE list_contains(links, 'Zeitam Thaetiath') UNION ALL SELECT 'get_country', count(*) FROM published WHERE lower(trim(country)) = 'sternrouthland'
UNION ALL SELECT 'get_year_facts', CASE WHEN EXISTS (SELECT 1 FROM published WHERE year = 1937 AND kind IN ('event', 'birth', 'death')) OR EXISTS (SELECT 1 FROM stateleaders WHERE list_contains(years, 1937)) OR EXISTS (SELECT 1 FROM orders WHERE year(o_orderdate) = 1937) THEN 1 ELSE 0 END
UNION ALL SELECT 'get_leaders', count(*) FROM stateleaders WHERE list_contains(years, 1500) UNION ALL SELECT 'get_number_one_song', least(count(*), 1) FROM events WHERE event_type = 'view' AND ts::DATE >= DATE '2024-01-09'
UNION ALL SELECT 'convert_dollars', CASE WHEN count(DISTINCT year(o_orderdate)) = 2 THEN 1 ELSE 0 END FROM orders WHERE year(o_orderdate) IN (1996, 2000) UNION ALL SELECT 'get_world_on_date', count(*) FROM ({SQL_MD}) WHERE year = 1937 AND m = 11 AND d = 15
UNION ALL SELECT 'check_claim', count(*) FROM ({SQL_COVERAGE}) WHERE claim = 'coin' UNION ALL SELECT 'get_official_series', count(DISTINCT year(o_orderdate)) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'get_disagreements', count(*) FROM ({SQL_LEDGER})
UNION ALL SELECT 'list_subjects', count(*) FROM subjects WHERE entries >= 10 UNION ALL SELECT 'list_countries', count(*) FROM countries""")
def q09_tools(t):
    """How many rows each tool of the catalogue returns for one call."""
    out = None
    for tool, given in CALLS:
        n = call(t, tool, **given).agg(F.count(F.lit(1)).alias("n")).select(F.lit(tool).alias("tool"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@R.add(f"""
WITH x AS (SELECT md.row_id, md.m, md.d, kind = 'event' AS e FROM ({SQL_MD}) md WHERE m IS NOT NULL AND d IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY m, d ORDER BY e DESC, row_id) - 1 AS i, count(*) OVER (PARTITION BY m, d) AS n FROM x)
SELECT m::INTEGER AS month, d AS day, row_id FROM r WHERE i % greatest(1, n // 8) = 0 AND i // greatest(1, n // 8) < 8""")
def q13_on_this_day(t):
    """Eight rows of each day of the calendar at even strides, events first."""
    x = dated(t).where("month is not null and day is not null")
    w = Window.partitionBy("month", "day")
    r = x.withColumn("i", F.row_number().over(w.orderBy(F.desc(F.col("kind") == "event"), "row_id")) - 1).withColumn("stride", F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(w) / 8)))
    return r.where((F.col("i") % F.col("stride") == 0) & (F.floor(F.col("i") / F.col("stride")) < 8)).select("month", "day", "row_id")


@R.add("""
WITH x AS (SELECT doc_id, source, year, text, row_number() OVER (PARTITION BY year ORDER BY length(text) DESC, doc_id) AS k FROM documents WHERE kind = 'year' AND year IS NOT NULL AND length(text) > 500 AND NOT contains(lower(left(text, 200)), 'may refer to'))
SELECT year, doc_id FROM x WHERE k = 1""")
def s04_accepted_source(t):
    """The article accepted for each year: long enough, no disambiguation, the longest."""
    good = t.documents.where("kind = 'year' and year is not null and length(text) > 500 and not contains(lower(left(text, 200)), 'may refer to')")
    return good.groupBy("year").agg(F.max_by("doc_id", F.struct(F.length("text"), -F.col("doc_id"))).alias("doc_id"))


@R.add("SELECT year, 'year' AS kind, count(*) AS n FROM published WHERE kind = 'death' AND date IS NULL GROUP BY year UNION ALL SELECT year, 'month', count(*) FROM published WHERE kind = 'death' AND date IS NOT NULL AND year NOT IN (SELECT year FROM published WHERE kind = 'death' AND date IS NULL) GROUP BY year")
def s05_deaths_lists(t):
    """Deaths from the year's own list, and by month where a year has none."""
    deaths = t.published.where("kind = 'death'")
    whole = deaths.where("date is null").groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    months = deaths.where("date is not null").join(whole.select("year"), "year", "left_anti").groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    kind = lambda df, k: df.select("year", F.lit(k).alias("kind"), "n")
    return kind(whole, "year").unionByName(kind(months, "month"))


@R.add("SELECT page_id, regexp_matches(source.title, '^.+ in .+$') AND ends_with(source.title, place) AS shape FROM articles WHERE place IS NOT NULL")
def s06_manifest_shape(t):
    """Whether a country article kept the shape its manifest asks for."""
    title = F.col("source.title")
    return t.articles.where("place is not null").select("page_id", (title.rlike("^.+ in .+$") & F.endswith(title, "place")).alias("shape"))


@R.add("SELECT (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS yyyymm, count(*) AS value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def s11_agency_formats(t):
    """A series through a whitespace table with comments and thousands commas."""
    path = Stage(t.spark, "io").path("agency")
    n = t.orders.where("o_orderstatus = 'F'").groupBy((F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("v"))
    n.select(F.concat(F.lit("  "), F.col("p").cast("string"), F.lit("   "), F.format_number("v", 0), F.lit("  # final")).alias("value")).write.text(path)
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    parts = F.split(line, r"\s+")
    return t.spark.read.text(path).where(~F.startswith("value", F.lit("#"))).select(F.get(parts, 0).cast("int").alias("yyyymm"), F.replace(F.get(parts, 1), F.lit(","), F.lit("")).cast("bigint").alias("value"))


@R.add(f"SELECT section, count(*) AS n, round(avg((CASE section WHEN 'Births' THEN 'birth' WHEN 'Deaths' THEN 'death' ELSE 'event' END = kind)::INTEGER), 6) AS agreement FROM published WHERE section IS NOT NULL GROUP BY section")
def v06_theme_agreement(t):
    """Share of rows per heading whose kind agrees with it."""
    expected = F.when(F.col("section") == "Births", "birth").when(F.col("section") == "Deaths", "death").otherwise("event")
    return t.published.where("section is not null").groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((expected == F.col("kind")).cast("int")), 6).alias("agreement"))


WORDS = "list_distinct(regexp_extract_all(lower(text), '[a-z]{5,}'))"


@R.add(f"""
WITH x AS (SELECT page_id, row_id, {WORDS} AS w, coalesce(weight, 0) < 0.2 AS dropped FROM published WHERE text IS NOT NULL AND NOT isnan(coalesce(weight, 0))),
l AS (SELECT page_id, row_id, len(w) AS size, unnest(w) AS token FROM x WHERE dropped), r AS (SELECT page_id, row_id AS best, unnest(w) AS token FROM x WHERE NOT dropped),
m AS (SELECT page_id, row_id, size, best, count(*) AS shared FROM l JOIN r USING (page_id, token) GROUP BY 1, 2, 3, 4), k AS (SELECT *, row_number() OVER (PARTITION BY page_id, row_id ORDER BY shared DESC, best) AS k FROM m)
SELECT row_id, best, shared, round(shared / size, 6) AS coverage FROM k WHERE k = 1 AND shared >= 2 AND shared / size >= 0.3""")
def v07_caption_coverage(t):
    """Rows left out of a page that a published row of it covers by two words and three tenths."""
    x = t.published.where("text is not null and not isnan(coalesce(weight, 0))").select("page_id", "row_id", F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))).alias("w"), (F.coalesce("weight", F.lit(0)) < 0.2).alias("dropped"))
    left = x.where("dropped").select("page_id", "row_id", F.col("w").alias("lw"))
    right = x.where("not dropped").select("page_id", F.col("row_id").alias("best"), F.col("w").alias("rw"))
    return best_overlap(left, right, ["page_id"], "row_id", "best", "lw", "rw").where("shared >= 2 and coverage >= 0.3").select("row_id", "best", "shared", "coverage")


@R.add("SELECT 'dump' AS part, 0::BIGINT AS missing, 0::BIGINT AS extra, count(*) AS n FROM published UNION ALL SELECT 'index', 0, 0, count(DISTINCT w) FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS w FROM published)")
def v09_machine_surface(t):
    """The dump and the index as written against the record: rows missing and extra."""
    stage = Stage(t.spark, "io")
    rows = t.published.select("row_id", "year", "text")
    dump = stage.write(rows, "dump")
    words = rows.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))).alias("w")).distinct()
    kept = stage.write(words, "words")
    gone = lambda a, b: a.exceptAll(b).agg(F.count(F.lit(1))).scalar()
    check = lambda part, a, b: b.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), gone(a, b).alias("missing"), gone(b, a).alias("extra"), "n")
    return check("dump", rows, dump).unionByName(check("index", words, kept))


@R.add("SELECT row_id, trim(regexp_replace(regexp_replace(source_title, '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM published WHERE source_title IS NOT NULL")
def x14_visible_titles(t):
    """Titles without what is in brackets."""
    return t.published.where("source_title is not null").select("row_id", F.trim(F.regexp_replace(F.regexp_replace("source_title", r"\([^)]*\)", " "), r"\s+", " ")).alias("title"))



