"""Queries on claims, benchmarks and gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoflow.functions.text import claim_tokens
from chronoflow.functions.timeaxis import MONTHS
from chronoflow.operators import benchmark as B
from chronoflow.operators import claims as C
from chronoflow.operators import gates as V
from chronoflow.queries.registry import Registry
from chronoflow.queries.scalars import CSTOP, ROMAN, sql_plain_letters, sql_stem
from chronoflow.queries.scalars import MONTHS as SQL_MONTHS
from chronoflow.queries.search import sql_norm

R = Registry()
QUERIES, SQL = R.queries, R.sql

_M = "|".join(m.lower() for m in MONTHS)
MARR = "[" + ",".join(f"'{m.lower()}'" for m in MONTHS) + "]"


def pick(p: str, i: int) -> str:
    return f"nullif(regexp_extract(low, '{p}', {i}), '')"


E_ = r"(?:^|[^\p{L}\p{N}])"
Z_ = r"(?:[^\p{L}\p{N}]|$)"
ISO, MDY, DMY = rf"{E_}(\d{{4}})-(\d{{2}})-(\d{{2}}){Z_}", rf"{E_}({_M})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{3,4}}){Z_}", rf"{E_}(\d{{1,2}})(?:st|nd|rd|th)?\s+({_M}),?\s+(\d{{3,4}}){Z_}"
BCE, FOUR, SAID = rf"{E_}(\d{{1,4}})\s*(?:bc|bce){Z_}", rf"{E_}(1\d{{3}}|20\d{{2}}){Z_}", rf"{E_}(?:in|ad|year)\s+([1-9]\d{{1,2}}){Z_}"
CLAIM = "coalesce(date, '') || CASE row_id % 4 WHEN 0 THEN ', ' || year WHEN 1 THEN ' ' || (year % 900) || ' BC' WHEN 2 THEN ' in ' || (year % 900) ELSE '' END || ': ' || coalesce(text, '')"


def claim_text():
    k = F.col("row_id") % 4
    tail = F.when(k == 0, F.concat(F.lit(", "), F.col("year").cast("string"))).when(k == 1, F.concat(F.lit(" "), (F.col("year") % 900).cast("string"), F.lit(" BC"))).when(k == 2, F.concat(F.lit(" in "), (F.col("year") % 900).cast("string"))).otherwise("")
    return F.concat(F.coalesce("date", F.lit("")), tail, F.lit(": "), F.coalesce("text", F.lit("")))


@R.add(f"""
WITH x AS (SELECT row_id, lower({CLAIM}) AS low FROM published)
SELECT row_id, (CASE WHEN {pick(ISO, 1)} IS NOT NULL THEN {pick(ISO, 1)}::INTEGER WHEN {pick(MDY, 1)} IS NOT NULL THEN {pick(MDY, 3)}::INTEGER WHEN {pick(DMY, 1)} IS NOT NULL THEN {pick(DMY, 3)}::INTEGER
 WHEN {pick(BCE, 1)} IS NOT NULL THEN 1 - {pick(BCE, 1)}::INTEGER WHEN {pick(FOUR, 1)} IS NOT NULL THEN {pick(FOUR, 1)}::INTEGER ELSE {pick(SAID, 1)}::INTEGER END)::INTEGER AS year,
 (CASE WHEN {pick(ISO, 1)} IS NOT NULL THEN {pick(ISO, 2)}::INTEGER WHEN {pick(MDY, 1)} IS NOT NULL THEN list_position({MARR}, {pick(MDY, 1)}) WHEN {pick(DMY, 1)} IS NOT NULL THEN list_position({MARR}, {pick(DMY, 2)}) END)::INTEGER AS month,
 (CASE WHEN {pick(ISO, 1)} IS NOT NULL THEN {pick(ISO, 3)}::INTEGER WHEN {pick(MDY, 1)} IS NOT NULL THEN {pick(MDY, 2)}::INTEGER WHEN {pick(DMY, 1)} IS NOT NULL THEN {pick(DMY, 1)}::INTEGER END)::INTEGER AS day FROM x""")
def c01_claim_dates(t):
    """The date that each claim names, in all its forms."""
    return t.published.select("row_id", C.claim_date(claim_text()).alias("x")).select("row_id", "x.year", "x.month", "x.day")


@R.add("""
WITH c AS (SELECT term_id, person, state_link, (terms[1][1] + term_id % 40 - 10)::INTEGER AS year FROM stateleaders WHERE person IS NOT NULL AND state_link IS NOT NULL AND terms[1][1] IS NOT NULL),
s AS (SELECT person, state_link, t[1] AS s, coalesce(t[2], 2026) AS e FROM (SELECT person, state_link, unnest(terms) AS t FROM stateleaders WHERE state_link IS NOT NULL AND person IS NOT NULL) WHERE t[1] <= coalesce(t[2], 2026)),
k AS (SELECT DISTINCT state_link, y AS year FROM (SELECT state_link, unnest(years) AS y FROM stateleaders WHERE state_link IS NOT NULL))
SELECT term_id, c.year, CASE WHEN max((s.s <= c.year AND c.year <= s.e)::INTEGER) = 1 THEN 'supported' WHEN max((s.e >= c.year - 15 AND s.s <= c.year + 15)::INTEGER) = 1 AND max((k.year IS NOT NULL)::INTEGER) = 1 THEN 'contradicted' ELSE 'unknown' END AS verdict
FROM c LEFT JOIN s USING (person, state_link) LEFT JOIN k ON k.state_link = c.state_link AND k.year = c.year GROUP BY term_id, c.year""")
def c02_leader_claims(t):
    """Claims that a person led a state in a year: supported, contradicted, or unknown."""
    rows = t.stateleaders.where("person is not null and state_link is not null")
    start = F.get(F.get("terms", 0), 0)
    c = rows.where(start.isNotNull()).select("term_id", "person", "state_link", (start + F.col("term_id") % 40 - 10).cast("int").alias("year"))
    s = rows.select("person", "state_link", F.explode("terms").alias("x")).select("person", "state_link", F.get("x", 0).alias("s"), F.coalesce(F.get("x", 1), F.lit(2026)).alias("e")).where("s <= e")
    known = t.stateleaders.where("state_link is not null").select("state_link", F.explode("years").alias("year")).distinct().withColumn("known", F.lit(1))
    x = c.join(s, ["person", "state_link"], "left").join(known, ["state_link", "year"], "left")
    on = F.max(F.col("year").between(F.col("s"), F.col("e")).cast("int")) == 1
    near = F.max(((F.col("e") >= F.col("year") - 15) & (F.col("s") <= F.col("year") + 15)).cast("int")) == 1
    return x.groupBy("term_id", "year").agg(F.when(on, "supported").when(near & (F.max("known") == 1), "contradicted").otherwise("unknown").alias("verdict"))


@R.add("""
WITH w AS (SELECT event_id, user_id, ts::DATE AS d FROM events WHERE event_type = 'view'), c AS (SELECT event_id, user_id, ts::DATE AS day FROM events WHERE event_type = 'purchase'),
f AS (SELECT c.event_id, min(w.d) AS issue FROM c JOIN w ON c.user_id = w.user_id AND w.d >= c.day GROUP BY 1)
SELECT c.event_id, CASE WHEN issue IS NULL THEN 'unknown' WHEN issue = day THEN 'supported' ELSE 'contradicted' END AS verdict FROM c LEFT JOIN f USING (event_id)""")
def c03_issue_claims(t):
    """Claims on a day against the first issue on or after it."""
    from chronoflow.operators.joins import as_of

    c = t.events.where("event_type = 'purchase'").select("event_id", "user_id", F.to_date("ts").alias("day"))
    w = t.events.where("event_type = 'view'").select("user_id", F.to_date("ts").alias("day"), F.lit(1).alias("issue")).distinct()
    found = as_of(c, w, ["user_id"], "day", ["issue"], forward=True)
    return found.select("event_id", F.when(F.col("as_of").isNull(), "unknown").when(F.col("as_of") == F.col("day"), "supported").otherwise("contradicted").alias("verdict"))


@R.add("""
WITH q AS (SELECT slug, list_filter(string_split(lower(label), ' '), lambda w: length(w) > 1) AS who, first_year AS year FROM subjects WHERE label IS NOT NULL),
p AS (SELECT DISTINCT q.slug FROM q JOIN published p ON p.year = q.year AND list_bool_and(list_transform(who, lambda w: contains(lower(p.text), w))))
SELECT slug, (slug IN (SELECT slug FROM p)) AS supported FROM q""")
def c04_all_words(t):
    """Whether a row of the year holds all words of a subject's name."""
    q = t.subjects.where("label is not null").select("slug", F.filter(F.split(F.lower("label"), " "), lambda w: F.length(w) > 1).alias("who"), F.col("first_year").alias("year"))
    rows = t.published.where("text is not null").select("year", F.lower("text").alias("low"))
    found = q.join(rows, "year").where(F.forall("who", lambda w: F.contains("low", w))).select("slug").distinct().withColumn("supported", F.lit(True))
    return q.select("slug").join(found, "slug", "left").select("slug", F.coalesce("supported", F.lit(False)).alias("supported"))


CLAIMS = {
    "bridge": "Work started on a bridge to plans drawn by a master in 1604",
    "siege": "The garrison surrendered after defenders were captured",
    "plague": "Plague returned and the gates were closed to travellers in 1937",
    "coin": "A mint strikes its first silver coin",
}


def sql_claims() -> str:
    return "(VALUES " + ",".join(f"('{k}', '{v}')" for k, v in CLAIMS.items()) + ") AS v(claim, said)"


SQL_COVERAGE = f"""
WITH c AS (SELECT claim, list_distinct(list_filter(string_split({sql_norm('said')}, ' '), lambda w: CASE WHEN regexp_matches(w, '^[0-9]+$') THEN length(w) <= 3 AND coalesce(try_cast(w AS INTEGER), 0) > 0 ELSE regexp_matches(w, '{ROMAN}') OR (length(w) > 2 AND NOT list_contains([{CSTOP}], w) AND NOT list_contains([{SQL_MONTHS}], w)) END)) AS tokens FROM {sql_claims()}),
t AS (SELECT claim, len(tokens) AS tokens, unnest(tokens) AS token FROM c), tm AS (SELECT *, {sql_stem('token')} AS meet FROM t),
w AS (SELECT DISTINCT row_id, {sql_stem('word')} AS meet FROM (SELECT row_id, unnest(list_distinct(string_split({sql_norm('text')}, ' '))) AS word FROM published))
SELECT claim, row_id, count(DISTINCT token) AS covered, any_value(tokens) AS tokens FROM w JOIN tm USING (meet) GROUP BY 1, 2 HAVING count(DISTINCT token) >= any_value(tokens) * 0.5"""


def claims_df(t):
    return t.spark.createDataFrame(list(CLAIMS.items()), "claim string, said string").select("claim", claim_tokens(F.col("said"), F.lit(None).cast("int"), F.lit(None).cast("int")).alias("tokens"))


@R.add(SQL_COVERAGE)
def c05_coverage(t):
    """Rows that hold at least half the words of each of a few claims."""
    return C.coverage(claims_df(t), t.published.select("row_id", "text"))


@R.add(f"WITH k AS ({SQL_COVERAGE}) SELECT v.claim, CASE WHEN max(covered) IS NULL THEN 'no_evidence' WHEN max((covered = tokens)::INTEGER) = 0 THEN 'partial_matches' WHEN max((covered = tokens AND p.year = regexp_extract(said, '([0-9]{{4}})', 1)::INTEGER)::INTEGER) = 1 THEN 'matched_same_year' WHEN regexp_extract(said, '([0-9]{{4}})', 1) = '' THEN 'evidence_only' ELSE 'matched_other_years' END AS verdict FROM {sql_claims()} LEFT JOIN k ON k.claim = v.claim LEFT JOIN published p USING (row_id) GROUP BY v.claim, said".replace("regexp_extract(said, '([0-9]{4})', 1)::INTEGER", "try_cast(regexp_extract(said, '([0-9]{4})', 1) AS INTEGER)"))
def c05_verdicts(t):
    """What the record says to each claim."""
    said = t.spark.createDataFrame(list(CLAIMS.items()), "claim string, said string").select("claim", C.claim_date(F.col("said")).year.alias("when"))
    k = C.coverage(claims_df(t), t.published.select("row_id", "text")).join(t.published.select("row_id", "year"), "row_id")
    whole = F.col("covered") == F.col("tokens")
    best = k.join(F.broadcast(said), "claim").groupBy("claim").agg(F.max(whole.cast("int")).alias("whole"), F.max((whole & (F.col("year") == F.col("when"))).cast("int")).alias("same"))
    x = said.join(best, "claim", "left")
    return x.select("claim", F.when(F.col("whole").isNull(), "no_evidence").when(F.col("whole") == 0, "partial_matches").when(F.col("same") == 1, "matched_same_year").when(F.col("when").isNull(), "evidence_only").otherwise("matched_other_years").alias("verdict"))


SQL_LEDGER = """
WITH t AS (SELECT term_id, min(x[1]) AS s, max(coalesce(x[2], 2026)) AS e FROM (SELECT term_id, unnest(terms) AS x FROM stateleaders) WHERE x[1] <= coalesce(x[2], 2026) GROUP BY 1),
y AS (SELECT term_id, min(v) AS s, max(v) AS e FROM (SELECT term_id, unnest(years) AS v FROM stateleaders) GROUP BY 1)
SELECT term_id, greatest(abs(t.s - y.s), abs(t.e - y.e))::INTEGER AS gap, CASE WHEN greatest(abs(t.s - y.s), abs(t.e - y.e)) >= 25 THEN 'note' ELSE 'gap' END AS class FROM t JOIN y USING (term_id) WHERE greatest(abs(t.s - y.s), abs(t.e - y.e)) > 1"""


@R.add(SQL_LEDGER)
def c07_disagreements(t):
    """Holders whose terms and confirmed years differ by more than a year."""
    return C.disagreements(t.stateleaders)


# benchmark

ANSWER = "CASE row_id % 3 WHEN 0 THEN 'It was in ' || source_title WHEN 1 THEN 'About ' || (year + row_id % 5) || ', I think' ELSE 'no idea' || coalesce(date, '') END"


def answer():
    k = F.col("row_id") % 3
    return F.when(k == 0, F.concat(F.lit("It was in "), "source_title")).when(k == 1, F.concat(F.lit("About "), (F.col("year") + F.col("row_id") % 5).cast("string"), F.lit(", I think"))).otherwise(F.concat(F.lit("no idea"), F.coalesce("date", F.lit(""))))


#: Items of each type, and how many of one group (a year, a person, a title) a type may take.
QUOTAS = {"event_year": (400, 2), "number_one": (200, 1), "leader": (250, 1), "cpi": (150, 1)}


def sql_quota(kind: str) -> str:
    n, most = QUOTAS[kind]
    return f"SELECT type, item, row_number() OVER (ORDER BY r, item)::INTEGER AS place FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY r, item) AS k FROM i WHERE type = '{kind}') WHERE k <= {most} QUALIFY place <= {n}"


def sql_items() -> str:
    from chronoflow.queries import corpus, selection

    return f"""
WITH e AS ({corpus.SQL['filter05_questions']}), l AS ({corpus.SQL['filter06_unambiguous']}), c AS ({selection.SQL['t13_pairs']}),
i AS (SELECT 'event_year' AS type, row_id::VARCHAR AS item, year::VARCHAR AS grp, md5('b1|event_year|' || row_id) AS r FROM e JOIN published USING (row_id)
 UNION ALL SELECT 'number_one', page_id::VARCHAR, source.title, md5('b1|number_one|' || page_id) FROM articles WHERE source.title IS NOT NULL
 UNION ALL SELECT 'leader', term_id || ':' || l.year, person, md5('b1|leader|' || term_id || ':' || l.year) FROM l JOIN stateleaders USING (term_id) WHERE person IS NOT NULL
 UNION ALL SELECT 'cpi', a || ':' || b, a || ':' || b, md5('b1|cpi|' || a || ':' || b) FROM c)
{' UNION ALL '.join(f'SELECT * FROM ({sql_quota(k)})' for k in QUOTAS)}"""


def b01_items(t):
    """Benchmark items of four types, each with its quota and so many of a group, drawn in seeded order."""
    from chronoflow.operators.selection import seeded_order, top_per_group
    from chronoflow.queries import corpus, selection

    run = lambda q: q(t.spark, t.sf_dir)
    pair = F.concat_ws(":", "a", "b")
    parts = {
        "event_year": run(corpus.QUERIES["filter05_questions"]).join(t.published.select("row_id", "year"), "row_id").select(F.col("row_id").cast("string").alias("item"), F.col("year").cast("string").alias("grp")),
        "number_one": t.articles.where("source.title is not null").select(F.col("page_id").cast("string").alias("item"), F.col("source.title").alias("grp")),
        "leader": run(corpus.QUERIES["filter06_unambiguous"]).join(t.stateleaders.where("person is not null").select("term_id", "person"), "term_id").select(F.concat_ws(":", "term_id", "year").alias("item"), F.col("person").alias("grp")),
        "cpi": run(selection.QUERIES["t13_pairs"]).select(pair.alias("item"), pair.alias("grp")),
    }
    out = None
    for kind, df in parts.items():
        n, most = QUOTAS[kind]
        drawn = df.withColumn("type", F.lit(kind)).withColumn("r", seeded_order(f"b1|{kind}", F.col("item")))
        few = top_per_group(drawn, ["grp"], [F.asc("r"), F.asc("item")], most).drop("place")
        some = top_per_group(few, ["type"], [F.asc("r"), F.asc("item")], n).select("type", "item", "place")
        out = some if out is None else out.unionByName(some)
    return out


R.add(sql_items())(b01_items)


@R.add("SELECT row_id, CASE row_id % 4 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN coalesce(text, '') || coalesce(country, '') WHEN 2 THEN '' ELSE coalesce(text, '') END AS said FROM published")
def b06_answer_texts(t):
    """The text of model responses: the field for it, else the text parts of all messages joined; responses without any are empty."""
    x, k = F.coalesce("text", F.lit("")), F.col("row_id") % 4
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    item = lambda kind, *parts: F.struct(F.lit(kind).alias("type"), F.array(*parts).alias("content"))
    none = F.lit(None).cast("string")
    messages = F.to_json(F.struct(none.alias("output_text"), F.array(item("reasoning", part("text", F.lit("hidden"))), item("message", part("output_text", x), part("refusal", F.lit("no"))), item("message", part("text", F.coalesce("country", F.lit(""))))).alias("output")))
    plain = F.to_json(F.struct(x.alias("output_text")))
    short = F.to_json(F.struct(F.array(item("message", part("text", x))).alias("output")))
    response = F.when(k == 0, plain).when(k == 1, messages).when(k == 2, "{}").otherwise(short)
    return t.published.select("row_id", B.response_text(response).alias("said"))


@R.add(f"""
WITH a AS (SELECT row_id, year, {ANSWER} AS said FROM published), n AS (SELECT *, try_cast(nullif(regexp_extract(said, '(?:^|\\D)(\\d{{3,4}})(?:\\D|$)', 1), '') AS INTEGER) * CASE WHEN regexp_matches(said, '(?:^|\\W)BCE?(?:\\W|$)') THEN -1 ELSE 1 END AS guess FROM a)
SELECT row_id, guess, coalesce(guess = year, false) AS exact, coalesce(abs(guess - year) <= 1, false) AS near FROM n""")
def b02_year_scores(t):
    """Years read from answers, exact or within one."""
    a = t.published.select("row_id", "year", B.year_answer(answer()).alias("guess"))
    return a.select("row_id", "guess", F.coalesce(F.col("guess") == F.col("year"), F.lit(False)).alias("exact"), F.coalesce(F.abs(F.col("guess") - F.col("year")) <= 1, F.lit(False)).alias("near"))


def sql_title(c: str) -> str:
    """A title without what is in brackets, in small plain letters."""
    c = rf"regexp_replace(regexp_replace(lower({sql_plain_letters(c)}), '^medley: *', ''), '[\(\[][^\)\]]*[\)\]]', ' ', 'g')"
    return f"trim(regexp_replace(regexp_replace(replace({c}, '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


SQL_SAID = "CASE page_id % 4 WHEN 0 THEN 'It was “' || source.title || '” by ' || coalesce(place, 'nobody') WHEN 1 THEN source.title || ' - ' || source.site WHEN 2 THEN 'I think the page ' || source.title || ' fits' ELSE label END"


@R.add(rf"""
WITH a AS (SELECT page_id, source.title AS t, label, trim(coalesce({SQL_SAID}, '')) AS said FROM articles),
f AS (SELECT *, [said, split_part(said, chr(10), 1)] || regexp_extract_all(said, '["“”]([^"“”]+)["“”]', 1) || regexp_extract_all(said, '\*\*([^*]+)\*\*', 1) AS found FROM a),
e AS (SELECT *, list_distinct(list_transform(flatten(list_transform(found, lambda x: [x, regexp_replace(x, '(?s)\s+by\s+.*$', ''), regexp_replace(x, '(?s)\s+[–—-]\s+.*$', ''), regexp_replace(x, '(?s)\s*,\s*by\s+.*$', ''), regexp_replace(x, '(?s)\s*—\s*.*$', '')])), lambda x: {sql_title('x')})) AS readings FROM f),
g AS (SELECT *, list_filter([{sql_title('t')}, {sql_title('label')}], lambda x: x IS NOT NULL AND x <> '') AS titles, ' ' || {sql_title('said')} || ' ' AS plain FROM e)
SELECT page_id, coalesce(list_has_any(titles, readings) OR len(list_filter(titles, lambda x: len(string_split(x, ' ')) >= 3 AND contains(plain, ' ' || x || ' '))) > 0, false) AS accepted FROM g""")
def b03_title_scores(t):
    """Answers in which an accepted title is found: as all of it, quoted, before "by" or a dash, or within it if long enough."""
    k, title = F.col("page_id") % 4, F.col("source.title")
    said = F.when(k == 0, F.concat(F.lit("It was “"), title, F.lit("” by "), F.coalesce("place", F.lit("nobody")))).when(k == 1, F.concat(title, F.lit(" - "), "source.site")).when(k == 2, F.concat(F.lit("I think the page "), title, F.lit(" fits"))).otherwise(F.col("label"))
    return t.articles.select("page_id", B.title_accepted(F.array(title, F.col("label")), said).alias("accepted"))


def sql_names(c: str) -> str:
    """Words of a name as score_names takes them."""
    marks = "translate({}, chr(8217) || chr(8216) || chr(699) || chr(700), chr(39) || chr(39))"
    folded = sql_plain_letters(f"coalesce({c}, '')")
    plain = marks.format(f"lower({folded})")
    words = rf"list_filter(list_transform(regexp_split_to_array(regexp_replace({plain}, '\b([0-9]+)(?:st|nd|rd|th)\b', '\1', 'g'), '[^a-z0-9\x27]+'), lambda w: trim(w, chr(39))), lambda w: w <> '')"
    known = {**{str(i + 1): r for i, r in enumerate(B.NUMERALS)}, **{w: row.split()[0] for row in B.SPELLINGS for w in row.split()[1:]}}
    table = "MAP {" + ", ".join("'{}': '{}'".format(k.replace("'", "''"), v) for k, v in known.items()) + "}"
    return f"list_transform({words}, lambda w: coalesce({table}[w], w))"


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SQL_NAMES = rf"""
WITH w AS (SELECT term_id, {sql_names('person')} AS g, {sql_names('quote')} AS r, {sql_list(B.NUMERALS)} AS numerals, {sql_list(B.PARTICLES)} AS particles, {sql_list(B.COMMON_GIVEN)} AS given FROM stateleaders),
n AS (SELECT *, list_filter(g[2:], lambda x: list_contains(numerals, x)) AS numbers FROM w),
p AS (SELECT *, list_filter(g, lambda x: NOT list_contains(particles, x) AND NOT list_contains(numbers, x) AND length(x) >= 2) AS parts FROM n),
o AS (SELECT *, parts[-1] AS last, list_filter(parts, lambda x: list_contains(r, x)) AS hits, list_position(r, parts[1]) AS first_at, list_position(r, parts[-1]) AS last_at FROM p),
b AS (SELECT *, CASE WHEN last_at > 1 THEN r[last_at - 1] END AS before FROM o)
SELECT term_id, CASE WHEN len(parts) = 0 THEN 'none'
 WHEN len(numbers) > 0 AND first_at IS NOT NULL AND list_has_any(numbers, r[first_at + 1:]) THEN 'regnal'
 WHEN len(numbers) > 0 AND (len(parts) = 1 OR len(list_filter(r, lambda x: list_contains(numerals, x) AND NOT list_contains(numbers, x) AND x <> 'i')) > 0) THEN 'none'
 WHEN last_at IS NOT NULL AND len(parts) > 1 AND first_at IS NULL AND regexp_full_match(coalesce(before, ''), '[a-z]{{2,}}') AND NOT list_contains(particles, before) AND NOT list_contains(g, before) AND NOT list_contains(numerals, before) THEN 'none'
 WHEN last_at IS NOT NULL AND (len(parts) > 1 OR length(last) >= 4) THEN 'surname'
 WHEN len(hits) >= 2 AND len(list_filter(hits, lambda x: NOT list_contains(given, x))) > 0 THEN 'two parts'
 WHEN len(parts) >= 3 AND first_at IS NOT NULL AND NOT list_contains(given, parts[1]) AND length(parts[1]) >= 4 THEN 'first of several' ELSE 'none' END AS rule FROM b"""


@R.add(SQL_NAMES)
def b04_name_rules(t):
    """The rule by which a holder's line is accepted as naming the holder, likeness of spelling aside."""
    return B.score_names(t.stateleaders.select("term_id", "person", "quote"), "person", "quote", near=False).select("term_id", "rule")


@R.add()
def b04_name_scores(t):
    """The same with surnames spelt nearly alike."""
    return B.score_names(t.stateleaders.select("term_id", "person", "quote"), "person", "quote").select("term_id", "rule")


@R.add(r"""
WITH x AS (SELECT row_id, year, prominence, list_transform(regexp_extract_all(text, '[0-9][0-9.,]*'), lambda r: regexp_replace(r, '[.,]+$', '')) AS runs FROM published WHERE text IS NOT NULL),
y AS (SELECT *, list_filter(list_transform(flatten(list_transform(runs, lambda r: CASE WHEN regexp_full_match(r, '[0-9]{1,3}(,[0-9]{3})+([.][0-9]+)?') THEN [replace(r, ',', '')] ELSE string_split(r, ',') END)), lambda p: TRY_CAST(p AS DOUBLE)), lambda v: v IS NOT NULL) AS v FROM x),
z AS (SELECT row_id, prominence, coalesce(list_filter(v, lambda z: z <> year AND z <> 2026 AND z <> 100)[1], v[1]) AS amount FROM y)
SELECT row_id, amount, coalesce(CASE WHEN prominence <> 0 THEN abs(amount - prominence) / abs(prominence) END <= 0.25, false) AS near FROM z""")
def b05_amounts(t):
    """The first amount of each text that is none of the years asked about, and whether it is within a quarter of the answer."""
    x = t.published.where("text is not null").select("row_id", "prominence", B.amount_answer(F.col("text"), F.col("year"), F.lit(2026)).alias("amount"))
    return x.select("row_id", "amount", F.coalesce(B.relative_error(F.col("amount"), F.col("prominence")) <= 0.25, F.lit(False)).alias("near"))


# gates

_LED = rf"^((?:{'|'.join(MONTHS)}) [0-9]{{1,2}})[ ]*[–—-]"
#: Words on which no sentence ends.
DANGLERS = "the|a|an|of|and|or|to|in|on|at|by|for|with|from|as|but|that|which|who"
#: Classes of failures a row can show by itself: name and condition, alike in both dialects but for the names of functions.
SQL_CLASSES = {
    "RESIDUE": "contains(text, '{{') OR contains(text, '}}') OR contains(text, '[[')",
    "PAIR": "length(text) - length(replace(text, '(', '')) <> length(text) - length(replace(text, ')', ''))",
    "DANGLE": rf"regexp_matches(text, '[,;:&/–-]$') OR regexp_matches(lower(text), '(^|[ ])({DANGLERS})$')",
    "TRUNC": r"regexp_matches(text, '(…|[.]{3}|\[more\]|\[…\])[ ]*$')",
    "DATE": rf"regexp_matches(text, '{_LED}') AND regexp_matches(date, '^({'|'.join(MONTHS)}) [0-9]{{1,2}}$') AND regexp_extract(text, '{_LED}', 1) <> date",
    "BLANK": "trim(text) = ''",
    "ERA": "year_label IS NULL",
    "SHORT": "length(text) < 30",
    "DUP": "k > 1",
    "DEAD": "dead",
    "THIN": "shown < 3",
}
SQL_RESIDUE = f"""SELECT row_id, list_filter([{', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in SQL_CLASSES.items())}], lambda c: c IS NOT NULL) AS cs FROM (
 SELECT *, row_number() OVER (PARTITION BY page_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), text IS NULL ORDER BY row_id) * (trim(text) <> '')::INTEGER AS k, count(*) OVER (PARTITION BY page_id) AS shown,
  row_id IN (SELECT row_id FROM (SELECT row_id, unnest(links) AS l FROM published) WHERE l NOT IN (SELECT label FROM subjects WHERE label IS NOT NULL)) AS dead FROM published)"""


def integrity(t):
    """Failures of rows by class: markup left, unpaired, dangling, cut, misdated, blank, without era, short, repeated on a page, with a dead link, on a thin page."""
    x = F.col("text")
    n = lambda s: F.length(x) - F.length(F.replace(x, F.lit(s), F.lit("")))
    flat = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    again = t.published.where("trim(text) <> ''").select("row_id", F.row_number().over(Window.partitionBy("page_id", flat).orderBy("row_id")).alias("k")).where("k > 1")
    dead = t.published.select("row_id", F.explode("links").alias("label")).join(t.subjects.select("label"), "label", "left_anti").where("label is not null").select("row_id", F.lit(True).alias("dead")).distinct()
    shown = t.published.groupBy("page_id").agg(F.count(F.lit(1)).alias("shown"))
    rows = t.published.select("row_id", "page_id", "text", "date", "year_label").join(again, "row_id", "left").join(dead, "row_id", "left").join(shown, "page_id")
    classes = {
        "RESIDUE": F.contains(x, F.lit("{{")) | F.contains(x, F.lit("}}")) | F.contains(x, F.lit("[[")),
        "PAIR": n("(") != n(")"),
        "DANGLE": x.rlike("[,;:&/–-]$") | F.lower(x).rlike(f"(^|[ ])({DANGLERS})$"),
        "TRUNC": x.rlike(r"(…|[.]{3}|\[more\]|\[…\])[ ]*$"),
        "DATE": x.rlike(_LED) & F.col("date").rlike(f"^({'|'.join(MONTHS)}) [0-9]{{1,2}}$") & (F.regexp_extract(x, _LED, 1) != F.col("date")),
        "BLANK": F.trim(x) == "",
        "ERA": F.col("year_label").isNull(),
        "SHORT": F.length(x) < 30,
        "DUP": F.col("k") > 1,
        "DEAD": F.col("dead"),
        "THIN": F.col("shown") < 3,
    }
    return V.gate(rows, "integrity", "row_id", classes)


@R.add()
def v01_provenance(t):
    """Rows whose cited revision is not among the page's, or whose year differs from it."""
    known = t.articles.select("page_id", F.col("source.revid").alias("source_revid"), F.col("year").alias("article_year"))
    x = t.published.join(known, ["page_id", "source_revid"], "left")
    return x.where(F.col("article_year").isNull() | (F.col("article_year") != F.col("year"))).select("row_id", F.when(F.col("article_year").isNull(), "revision").otherwise("year").alias("class"))


SQL["v01_provenance"] = "SELECT row_id, CASE WHEN a.year IS NULL THEN 'revision' ELSE 'year' END AS class FROM published p LEFT JOIN articles a ON a.page_id = p.page_id AND a.source.revid = p.source_revid WHERE a.year IS NULL OR a.year <> p.year"


@R.add("""
WITH c AS (SELECT * FROM (VALUES ('siege', 'siege of|garrison of'), ('birth', 'born at|born near'), ('plague', 'plague returns'), ('comet', 'comet seen')) AS c(c, phrases)) SELECT c AS case_name, count(*) AS rows, count(*) > 0 AS found FROM c JOIN published ON list_bool_or(list_transform(string_split(phrases, '|'), lambda p: contains(lower(text), p))) GROUP BY c""")
def v02_fixed_cases(t):
    """Fixed cases that the record must hold, with the number of rows that do."""
    cases = {"siege": "siege of|garrison of", "birth": "born at|born near", "plague": "plague returns", "comet": "comet seen"}
    low = F.lower("text")
    hits = F.array_compact(F.array(*[F.when(F.exists(F.split(F.lit(p), r"\|"), lambda s: F.contains(low, s)), F.lit(c)) for c, p in cases.items()]))
    return t.published.select(F.explode(hits).alias("case_name")).groupBy("case_name").agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) > 0).alias("found"))


@R.add("SELECT page_id, count(*) AS rows, count(DISTINCT section) AS sections, count(*) FILTER (kind NOT IN ('event', 'birth', 'death')) AS bad_kind, count(*) >= 3 AS filled, sum(coalesce(length(text), 0))::BIGINT <= 19400 AS in_budget FROM published GROUP BY page_id")
def v03_surface(t):
    """Each page's shape: rows, sections, kinds, and whether it keeps its budget."""
    return t.published.groupBy("page_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("section").alias("sections"), F.count_if(~F.col("kind").isin("event", "birth", "death")).alias("bad_kind"), (F.count(F.lit(1)) >= 3).alias("filled"), (F.sum(F.coalesce(F.length("text"), F.lit(0))) <= 19400).alias("in_budget"))


@R.add(f"""WITH f AS (SELECT row_id, unnest(cs) AS class FROM ({SQL_RESIDUE})), k AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY row_id) AS k FROM f)
SELECT 'integrity' AS gate, class, count(*) AS n, string_agg(row_id::VARCHAR, ',' ORDER BY row_id) FILTER (k <= 5) AS examples FROM k GROUP BY class""")
def v04_integrity(t):
    """Failures of integrity by class, with the first examples (v04, k15)."""
    return V.report(integrity(t))


@R.add("""
WITH a AS (SELECT term_id, list_filter(list_distinct(flatten(list_transform(terms, lambda x: CASE WHEN x[1] IS NOT NULL AND x[1] <= coalesce(x[2], 2026) THEN range(x[1], coalesce(x[2], 2026) + 1) ELSE [] END))), lambda y: y IS NOT NULL) AS ys, years FROM stateleaders WHERE years IS NOT NULL AND terms IS NOT NULL)
SELECT term_id, len(list_filter(list_distinct(years), lambda y: y IS NOT NULL AND NOT list_contains(ys, y::BIGINT)))::INTEGER AS outside FROM a""")
def v05_second_source(t):
    """Confirmed years of each holder that lie outside the terms."""
    inside = lambda y: F.exists("terms", lambda x: F.coalesce((F.get(x, 0) <= y) & (y <= F.coalesce(F.get(x, 1), F.lit(2026))), F.lit(False)))
    return t.stateleaders.where("years is not null and terms is not null").select("term_id", F.size(F.filter(F.array_distinct("years"), lambda y: y.isNotNull() & ~inside(y))).alias("outside"))


@R.add(f"""
WITH f AS (SELECT unnest(cs) AS class FROM ({SQL_RESIDUE})), n AS (SELECT class, count(*) AS n FROM f GROUP BY 1), b AS (SELECT * FROM (VALUES ('PAIR', 100), ('DANGLE', 3), ('OLD', 7)) AS v(class, accepted))
SELECT coalesce(n.class, b.class) AS class, coalesce(n, 0)::BIGINT AS n, coalesce(accepted, 0)::BIGINT AS accepted, CASE WHEN coalesce(n, 0) > coalesce(accepted, 0) THEN 'worse' WHEN coalesce(n, 0) < coalesce(accepted, 0) THEN 'better' ELSE 'same' END AS verdict FROM n FULL JOIN b ON n.class = b.class""")
def v08_ratchet(t):
    """Counts of failures against the accepted ones."""
    n = integrity(t).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return V.ratchet(n, t.spark.createDataFrame([("PAIR", 100), ("DANGLE", 3), ("OLD", 7)], "class string, n bigint"))


@R.add("SELECT DISTINCT link FROM (SELECT unnest(links) AS link FROM published) WHERE link NOT IN (SELECT label FROM subjects WHERE label IS NOT NULL)")
def v10_dead_links(t):
    """Links that lead to no subject."""
    return t.published.select(F.explode("links").alias("link")).distinct().join(t.subjects.select(F.col("label").alias("link")), "link", "left_anti")


@R.add("""
SELECT DISTINCT state_link, office, year FROM (SELECT state_link, office, unnest(years) AS year FROM stateleaders WHERE state_link IS NOT NULL AND office IS NOT NULL) y WHERE year IS NOT NULL AND NOT EXISTS (
 SELECT 1 FROM (SELECT state_link, office, unnest(terms) AS x FROM stateleaders) s WHERE s.state_link = y.state_link AND s.office = y.office AND x[1] <= y.year AND y.year <= coalesce(x[2], 2026))""")
def v11_range_anti(t):
    """Confirmed years of a post that no term of it covers."""
    y = t.stateleaders.where("state_link is not null and office is not null").select("state_link", "office", F.explode("years").alias("year")).where("year is not null").distinct()
    s = t.stateleaders.where("state_link is not null and office is not null").select("state_link", "office", F.explode("terms").alias("x")).select("state_link", "office", F.get("x", 0).alias("s"), F.coalesce(F.get("x", 1), F.lit(2026)).alias("e")).where("s <= e")
    from chronoflow.operators.joins import overlapping

    met = overlapping(y.withColumn("y1", F.col("year")), s, ["state_link", "office"], ("year", "y1"), ("s", "e"), 64).select("state_link", "office", "year")
    return y.join(met, ["state_link", "office", "year"], "left_anti")

