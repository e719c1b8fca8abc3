"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoflow.functions import text as X
from chronoflow.functions import timeaxis as T
from chronoflow.queries.aggregates import CENTURY, DECADE, SQL_MD, dated
from chronoflow.queries.registry import Registry
from chronoflow.queries.search import A, B, STOPS, sql_norm, sql_tokens

R = Registry()
QUERIES, SQL = R.queries, R.sql

ASCII = f"regexp_replace(translate(lower(replace(coalesce(label, ''), '&', ' and ')), '{A}', '{B}'), '[^\\x00-\\x7f]', '', 'g')"


@R.add(f"SELECT slug, regexp_replace(left(regexp_replace(regexp_replace({ASCII}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 80), '-+$', '') AS made FROM subjects")
def f01_slugs(t):
    """Slugs of all subjects' labels."""
    return t.subjects.select("slug", X.slugify(F.col("label")).alias("made"))


@R.add(f"SELECT row_id, {sql_norm('text')} AS flat FROM published")
def f02_norm(t):
    """Texts in small plain letters."""
    return t.published.select("row_id", X.norm(F.col("text")).alias("flat"))


_A = A + "".join(x + x.upper() * (x != "ı") for x in X.SPECIAL)
_B = B + "".join(y + y.upper() * (x != "ı") for x, y in X.SPECIAL.items())


def sql_plain_letters(c: str) -> str:
    for x, y in X.DOUBLE.items():
        c = f"replace({c}, '{x}', '{y}')"
    return f"translate({c}, '{_A}', '{_B}')"


@R.add(f"SELECT slug, {sql_plain_letters('label')} AS plain FROM subjects")
def f03_fold(t):
    """Labels without marks, special letters spelt plainly."""
    return t.subjects.select("slug", X.fold(F.col("label"), special=True).alias("plain"))


@R.add(f"SELECT row_id, array_to_string(list_sort({sql_tokens('text')}), ' ') AS tokens FROM published")
def f04_index_tokens(t):
    """Index tokens of every row."""
    return t.published.select("row_id", F.array_join(F.array_sort(X.index_tokens(F.col("text"))), " ").alias("tokens"))


@R.add(f"SELECT row_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z]{{4,}}')), lambda w: NOT list_contains([{STOPS}], w))), ' ') AS words FROM published")
def f05_content_words(t):
    """Content words of every row."""
    return t.published.select("row_id", F.array_join(F.array_sort(X.content_words(F.col("text"))), " ").alias("words"))


def sql_stem(w: str) -> str:
    cases = " ".join(f"WHEN {w} LIKE '%{s}' AND length({w}) >= {len(s) + 3} THEN left({w}, -{len(s)}){chr(124) * 2 + chr(39) + 'y' + chr(39) if s in ('ied', 'ies') else ''}" for s in ("ings", "ing", "ied", "ies", "ed", "es", "s"))
    table = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in X.IRREGULAR.items())
    return f"coalesce(CASE {w} {table} END, CASE {cases} ELSE {w} END)"


@R.add(f"SELECT word, {sql_stem('word')} AS stem FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM published WHERE text IS NOT NULL)")
def f06_stems(t):
    """Stems of all words."""
    words = t.published.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    return words.select("word", X.stem(F.col("word")).alias("stem"))


MONTHS = ",".join(f"'{m.lower()}'" for m in T.MONTHS)
CSTOP = ",".join(f"'{w}'" for w in [*X.CLAIM_STOP, "bce", "ad", "bc"])
ROMAN = "^(ii|iii|iv|vi|vii|viii|ix|xi|xii|xiii|xiv|xv|xvi|xvii|xviii)$"


@R.add(f"""
SELECT row_id, array_to_string(list_sort(list_distinct(list_filter(string_split({sql_norm('text')}, ' '), lambda w: CASE WHEN regexp_matches(w, '^[0-9]+$') THEN length(w) <= 3 AND coalesce(try_cast(w AS INTEGER), 0) > 0 AND w <> year::VARCHAR AND w <> (1 - year)::VARCHAR
 ELSE regexp_matches(w, '{ROMAN}') OR (length(w) > 2 AND NOT list_contains([{CSTOP}], w) AND NOT list_contains([{MONTHS}], w)) END))), ' ') AS words FROM published""")
def f07_claim_tokens(t):
    """Words of each row worth matching as a claim."""
    return t.published.select("row_id", F.array_join(F.array_sort(X.claim_tokens(F.col("text"), F.col("year"), F.lit(None).cast("int"))), " ").alias("words"))


@R.add(r"""
WITH s AS (SELECT row_id, regexp_replace(regexp_replace(trim(text), '^[\s,;:.–—-]+', ''), '[\s,:;–—-]+$', '') AS t FROM published), c AS (SELECT row_id, upper(left(t, 1)) || substr(t, 2) AS t FROM s)
SELECT row_id, CASE WHEN t = '' OR regexp_matches(t, '[.!?][”"'')]?$') THEN t ELSE t || '.' END AS sentence FROM c""")
def f08_sentences(t):
    """Texts as sentences."""
    return t.published.select("row_id", X.as_sentence(F.col("text")).alias("sentence"))


@R.add(r"""SELECT row_id, CASE WHEN regexp_matches(text, '^((January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2}|\d{1,2}\s+(January|February|March|April|May|June|July|August|September|October|November|December))\s*([–—-]|:|,)\s*\d') THEN text
 ELSE regexp_replace(text, '^((January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2}|\d{1,2}\s+(January|February|March|April|May|June|July|August|September|October|November|December))\s*([–—-]|:|,)\s*', '') END AS body FROM published""")
def f09_without_date(t):
    """Texts without the date printed before them."""
    return t.published.select("row_id", X.strip_date_prefix(F.col("text")).alias("body"))


_MONTHS = "|".join(T.MONTHS)
_MLIST = "[" + ", ".join(f"'{m}'" for m in T.MONTHS) + "]"
SQL_DAYS = rf"""t AS (SELECT row_id, trim(coalesce(date, '')) AS t FROM published),
p AS (SELECT row_id, regexp_extract(t, '^({_MONTHS})\s+(\d{{1,2}})\s*[-–—]\s*(?:({_MONTHS})\s+)?(\d{{1,2}})(.*)$', ['a', 'b', 'c', 'd', 'rest']) AS x FROM t),
q AS (SELECT row_id, list_position({_MLIST}, x.a) AS m, TRY_CAST(x.b AS INTEGER) AS d, list_position({_MLIST}, x.c) AS to_m, TRY_CAST(x.d AS INTEGER) AS to_d FROM p WHERE x.a <> '' AND NOT regexp_matches(x.rest, '^(\d|,|st|nd|rd|th)')),
s AS (SELECT row_id, to_m, TRY_CAST('2000-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE) AS a, TRY_CAST('2000-' || lpad(coalesce(to_m, m)::VARCHAR, 2, '0') || '-' || lpad(to_d::VARCHAR, 2, '0') AS DATE) AS b FROM q),
r AS (SELECT row_id, a, (CASE WHEN b < a AND to_m IS NOT NULL THEN b + INTERVAL 1 YEAR ELSE b END)::DATE AS b FROM s),
days AS (SELECT row_id, month(day)::INTEGER AS month, day(day)::INTEGER AS day FROM (SELECT row_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day FROM r WHERE b > a AND date_diff('day', a, b) <= 14))"""


@R.add(f"WITH {SQL_DAYS} SELECT * FROM days")
def f10_span_days(t):
    """The days that each printed range covers."""
    return t.published.select("row_id", F.explode(T.span_days(F.col("date"))).alias("x")).select("row_id", "x.month", "x.day")


ORD = "abs({0})::VARCHAR || CASE WHEN abs({0}) % 100 BETWEEN 11 AND 13 THEN 'th' WHEN abs({0}) % 10 = 1 THEN 'st' WHEN abs({0}) % 10 = 2 THEN 'nd' WHEN abs({0}) % 10 = 3 THEN 'rd' ELSE 'th' END"


@R.add(f"""
WITH y AS (SELECT DISTINCT year - x AS year FROM published, (SELECT unnest([0, 1000, 2000, 2026]) AS x)), k AS (SELECT year, {CENTURY} AS century, {DECADE} AS decade, (CASE WHEN year > 0 THEN (year - 1) // 100 + 1 ELSE -((-year) // 100 + 1) END)::INTEGER AS strict FROM y)
SELECT year, century, decade, strict, {ORD.format('century')} || ' century' || CASE WHEN century < 0 THEN ' BC' ELSE '' END AS century_label, CASE WHEN decade < 0 THEN (-decade - 10) || 's BC' ELSE decade || 's' END AS decade_label, CASE WHEN year > 0 THEN year::VARCHAR ELSE (1 - year) || ' BCE' END AS era FROM k""")
def f11_periods(t):
    """Century and decade of years on both sides of year 0, with their labels."""
    y = t.published.select(F.explode(F.transform(F.array(F.lit(0), F.lit(1000), F.lit(2000), F.lit(2026)), lambda x: F.col("year") - x)).alias("year")).distinct()
    y = y.withColumns({"century": T.century(F.col("year")), "decade": T.decade(F.col("year")), "strict": T.strict_century(F.col("year"))})
    return y.withColumns({"century_label": T.century_label(F.col("century")), "decade_label": T.decade_label(F.col("decade")), "era": T.era_label(F.col("year"))})


@R.add(r"""
WITH x AS (SELECT DISTINCT l FROM (SELECT year_label AS l FROM published UNION SELECT (year % 700) || 'BC' FROM published UNION SELECT 'AD ' || year FROM published UNION SELECT date FROM published)), y AS (SELECT l, lower(trim(l)) AS t FROM x)
SELECT l, CASE WHEN regexp_matches(t, '^\d{1,5}\s*(bce|bc)$') THEN 1 - nullif(regexp_extract(t, '^(\d{1,5})', 1)::INTEGER, 0) WHEN regexp_matches(t, '^(ad\s*)?\d{1,5}\s*(ce|ad)?$') THEN nullif(regexp_extract(t, '(\d{1,5})', 1)::INTEGER, 0) END AS year FROM y""")
def f12_year_input(t):
    """Typed years read, in all their forms; what is no year gives null."""
    p = t.published
    labels = p.select(F.col("year_label").alias("l")).union(p.select(F.concat((F.col("year") % 700).cast("string"), F.lit("BC")))).union(p.select(F.concat(F.lit("AD "), F.col("year").cast("string")))).union(p.select("date")).distinct()
    return labels.select("l", T.year_of(F.col("l")).alias("year"))


@R.add(f"SELECT row_id, CASE WHEN m IS NOT NULL AND d IS NOT NULL AND year BETWEEN 1583 AND 9999 THEN dayname(try_cast(lpad(year::VARCHAR, 4, '0') || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') AS DATE)) END AS weekday FROM ({SQL_MD})")
def f13_weekdays(t):
    """Weekdays of dated rows from 1583 on; dates that don't exist give null."""
    x = dated(t).where("true")
    day = F.try_make_timestamp("year", "month", "day", F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return x.select("row_id", F.when(F.col("year").between(1583, 9999), F.date_format(day, "EEEE")).alias("weekday"))


@R.add(f"SELECT row_id, lower(['January','February','March','April','May','June','July','August','September','October','November','December'][m]) || '-' || d AS slug FROM ({SQL_MD}) WHERE m IS NOT NULL AND d BETWEEN 1 AND 31")
def f14_day_slugs(t):
    """Slugs of the calendar days of dated rows."""
    name = F.lower(F.element_at(F.array(*map(F.lit, T.MONTHS)), F.col("month")))
    return dated(t).where("month is not null and day between 1 and 31").select("row_id", F.concat(name, F.lit("-"), F.col("day").cast("string")).alias("slug"))


@R.add("""
WITH d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders), j AS (SELECT d, (d - DATE '2000-01-01') + 2451545 AS jdn FROM d), c AS (SELECT d, jdn, jdn + 32082 AS c FROM j), e AS (SELECT *, (4 * c + 3) // 1461 AS dd FROM c), f AS (SELECT *, c - 1461 * dd // 4 AS e FROM e), g AS (SELECT *, (5 * e + 2) // 153 AS m FROM f)
SELECT d, jdn::BIGINT AS jdn, (dd - 4800 + m // 10)::INTEGER AS year, (m + 3 - 12 * (m // 10))::INTEGER AS month, (e - (153 * m + 2) // 5 + 1)::INTEGER AS day FROM g""")
def f15_julian(t):
    """Order dates in the Julian calendar."""
    d = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    y, m, k = F.year("d"), F.month("d"), F.dayofmonth("d")
    return d.select("d", T.julian_day(y, m, k).alias("jdn"), T.to_julian(y, m, k).alias("x")).select("d", "jdn", "x.*")


START = "[0,31,59,90,120,151,181,212,243,273,304,334]"


@R.add(f"""
WITH x AS (SELECT row_id, m, d, lag(m) OVER w AS pm, lag(d) OVER w AS pd FROM ({SQL_MD}) WHERE m IS NOT NULL AND d IS NOT NULL WINDOW w AS (ORDER BY row_id)), g AS (SELECT row_id, abs({START}[m] + d - {START}[pm] - pd) AS g FROM x WHERE pm IS NOT NULL)
SELECT row_id, least(g, 365 - g)::INTEGER AS days, least(g, 365 - g) BETWEEN 10 AND 13 AS calendar FROM g""")
def f16_day_distance(t):
    """Days between each dated row and the one before, the shorter way round the year."""
    from chronoflow.queries.ordered import dense_ids

    x = dense_ids(dated(t).where("month is not null and day is not null").select("row_id", "month", "day"), ["row_id"])
    before = x.select((F.col("docid") + 1).alias("docid"), F.col("month").alias("pm"), F.col("day").alias("pd"))
    days = T.day_distance(F.col("month"), F.col("day"), F.col("pm"), F.col("pd"))
    return x.join(before, "docid").select("row_id", days.alias("days"), days.between(10, 13).alias("calendar"))


@R.add(r"""
WITH x AS (SELECT term_id, unnest(regexp_extract_all(regexp_extract(quote, '\(([^()]*)\)\s*$', 1), '\d{1,4}\s*[–-]\s*(?:\d{1,4})?')) AS r FROM stateleaders WHERE quote IS NOT NULL)
SELECT term_id, r AS range, regexp_extract(r, '^(\d+)', 1)::INTEGER AS first, coalesce(try_cast(nullif(regexp_extract(r, '[–-]\s*(\d+)', 1), '') AS INTEGER), 9999) AS last FROM x""")
def f18_tenures(t):
    """Ranges of years in the closing parenthesis of each quote; an open end is 9999."""
    inside = F.regexp_extract("quote", r"\(([^()]*)\)\s*$", 1)
    r = t.stateleaders.where("quote is not null").select("term_id", F.explode(F.regexp_extract_all(inside, F.lit(r"\d{1,4}\s*[–-]\s*(?:\d{1,4})?"), F.lit(0))).alias("range"))
    last = F.nullif(F.regexp_extract("range", r"[–-]\s*(\d+)", 1), F.lit("")).cast("int")
    return r.select("term_id", "range", F.regexp_extract("range", r"^(\d+)", 1).cast("int").alias("first"), F.coalesce(last, F.lit(9999)).alias("last"))


@R.add(r"SELECT row_id, coalesce(source_title, '') || '#' || replace(list_last(string_split(source_section, ' › ')), ' ', '_') AS cite, regexp_matches(coalesce(text, ''), '^((January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}|\d{1,2} (January|February|March|April|May|June|July|August|September|October|November|December))\b') AS printed FROM published WHERE source_section IS NOT NULL")
def f19_citations(t):
    """Anchors of the cited sections, and whether the text prints its date."""
    months = "|".join(T.MONTHS)
    anchor = F.replace(F.element_at(F.split("source_section", " › "), -1), F.lit(" "), F.lit("_"))
    return t.published.where("source_section is not null").select("row_id", F.concat(F.coalesce("source_title", F.lit("")), F.lit("#"), anchor).alias("cite"), F.coalesce("text", F.lit("")).rlike(rf"^((?:{months}) \d{{1,2}}|\d{{1,2}} (?:{months}))\b").alias("printed"))


@R.add("SELECT slug, CASE WHEN entries BETWEEN 0 AND 12 THEN ['zero','one','two','three','four','five','six','seven','eight','nine','ten','eleven','twelve'][entries + 1] ELSE entries::VARCHAR END AS word FROM subjects")
def f20_number_words(t):
    """Small numbers in words."""
    return t.subjects.select("slug", X.number_word(F.col("entries")).alias("word"))


@R.add(r"SELECT row_id, CASE WHEN length(text) <= 100 THEN text ELSE regexp_replace(regexp_replace(left(text, 99), '\s+\S*$', ''), '[\s,;:.]+$', '') || '…' END AS short FROM published")
def f21_trimmed(t):
    """Texts of at most a hundred characters, cut between words."""
    return t.published.select("row_id", X.trim_to(F.col("text"), 100).alias("short"))


@R.add(r"SELECT row_id, regexp_replace(regexp_replace(text, '\(b\. ', '(born ', 'g'), '\(d\. ', '(died ', 'g') AS shown, regexp_replace(text, '\(born ', '(b. ', 'g') AS brief FROM published")
def f22_shorthand(t):
    """Shorthand for births and deaths spelt out, and back."""
    return t.published.select("row_id", F.regexp_replace(F.regexp_replace("text", r"\(b\. ", "(born "), r"\(d\. ", "(died ").alias("shown"), F.regexp_replace("text", r"\(born ", "(b. ").alias("brief"))


@R.add("SELECT o_orderkey, '$' || CASE WHEN o_totalprice >= 1e6 THEN round(o_totalprice / 1e6, 1)::DECIMAL(20,1) || ' million' ELSE format('{:,}', round(o_totalprice)::BIGINT) END AS money, strftime(o_orderdate, '%B %Y') AS month FROM orders")
def f23_display(t):
    """Prices and months as they are shown."""
    price = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.concat(F.lit("$"), F.when(price >= 1e6, F.concat(F.round(price / 1e6, 1).cast("decimal(20,1)").cast("string"), F.lit(" million"))).otherwise(F.format_number(F.round(price).cast("bigint"), 0))).alias("money"), F.date_format("o_orderdate", "MMMM yyyy").alias("month"))


@R.add("""
WITH p AS (SELECT year(o_orderdate)::INTEGER AS year, avg(o_totalprice) AS cpi FROM orders GROUP BY 1), l AS (SELECT max(year) AS last FROM p)
SELECT p.year, round(100 * q.cpi / p.cpi, 2) AS hundred_now, round(q.cpi / p.cpi, 4) AS factor FROM p, p q, l WHERE q.year = last""")
def f24_conversion(t):
    """What a hundred of each year is in the last, by a price series."""
    p = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.avg("o_totalprice").alias("cpi"))
    now = p.agg(F.max_by("cpi", "year")).scalar()
    return p.select("year", F.round(100 * now / F.col("cpi"), 2).alias("hundred_now"), F.round(now / F.col("cpi"), 4).alias("factor"))


@R.add("SELECT l_orderkey, l_linenumber, round((l_extendedprice * l_discount)::DECIMAL(20,4), 1)::DOUBLE AS half_up, length(split_part(rtrim(l_extendedprice::DECIMAL(20,4)::VARCHAR, '0'), '.', 2))::INTEGER AS decimals FROM lineitem")
def f25_rounding(t):
    """Decimal rounding half up, and the number of decimals of a figure."""
    shown = F.regexp_replace(F.col("l_extendedprice").cast("decimal(20,4)").cast("string"), "0+$", "")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round((F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(20,4)"), 1).cast("double").alias("half_up"), F.length(F.split_part(shown, F.lit("."), F.lit(2))).alias("decimals"))


@R.add(f"SELECT page_id, unnest(list_distinct([{sql_norm('label')}, {sql_norm('source.title')}, regexp_replace({sql_norm("source.title")}, '^(the|a|an) ', ''), {sql_norm('label')} || ' ' || coalesce(lower(place), '')])) AS variant FROM articles")
def f26_title_variants(t):
    """Accepted spellings of every article's title."""
    label, title = X.norm(F.col("label")), X.norm(F.col("source.title"))
    return t.articles.select("page_id", F.explode(F.array_distinct(F.array(label, title, F.regexp_replace(title, "^(the|a|an) ", ""), F.concat(label, F.lit(" "), F.coalesce(F.lower("place"), F.lit("")))))).alias("variant"))


@R.add("SELECT state_link, office, string_agg(name, ', then ' ORDER BY first, name) AS line FROM (SELECT state_link, office, name, min(term_id) AS first FROM stateleaders WHERE state_link IS NOT NULL AND office IS NOT NULL AND name IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2")
def f30_post_lines(t):
    """The holders of a post in one line, in the order of the list."""
    h = t.stateleaders.where("state_link is not null and office is not null and name is not null").groupBy("state_link", "office", "name").agg(F.min("term_id").alias("first"))
    return h.groupBy("state_link", "office").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "name"))), lambda x: x["name"]), ", then ").alias("line"))


@R.add("SELECT row_id, CASE WHEN g = 0 THEN 'exact' WHEN abs(g) <= 10 THEN 'close' WHEN abs(g) <= 50 THEN 'near' ELSE 'far' END AS mark, CASE WHEN g > 0 THEN 'later' WHEN g < 0 THEN 'earlier' END AS direction FROM (SELECT row_id, year - 1500 AS g FROM published)")
def f31_guess(t):
    """How a guess of 1500 fares against each row's year."""
    g = F.col("year") - 1500
    return t.published.select("row_id", F.when(g == 0, "exact").when(F.abs(g) <= 10, "close").when(F.abs(g) <= 50, "near").otherwise("far").alias("mark"), F.when(g > 0, "later").when(g < 0, "earlier").alias("direction"))


@R.add("SELECT row_id, left(sha256(coalesce(text, '')), 24) AS key, left(sha1(coalesce(text, '')), 12) AS id FROM published")
def f32_hashes(t):
    """Short identifiers of texts."""
    text = F.coalesce("text", F.lit(""))
    return t.published.select("row_id", F.left(F.sha2(text, 256), F.lit(24)).alias("key"), F.left(F.sha1(text), F.lit(12)).alias("id"))


@R.add("SELECT slug, 'https://example.org/wiki/' || replace(label, ' ', '_') AS wiki, 'https://example.org/entity/' || qid AS entity, '/timeline/' || slug || '/' AS canonical FROM subjects")
def f33_urls(t):
    """Addresses of subjects."""
    return t.subjects.select("slug", F.concat(F.lit("https://example.org/wiki/"), F.replace("label", F.lit(" "), F.lit("_"))).alias("wiki"), F.concat(F.lit("https://example.org/entity/"), F.col("qid")).alias("entity"), F.concat(F.lit("/timeline/"), F.col("slug"), F.lit("/")).alias("canonical"))


@R.add()
def f40_schema(t):
    """The merged schema of all JSON property texts."""
    return t.events.select(F.parse_json("props").alias("v")).agg(F.schema_of_variant_agg("v").alias("schema"))
