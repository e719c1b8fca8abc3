"""Search queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from chronoflow.functions import text as X
from chronoflow.operators import search as S
from chronoflow.plans.staging import Stage
from chronoflow.queries.registry import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

SOUGHT = {"bridge": "bridge of stone", "silver": "first silver coin", "siege": "breaks the siege riders", "year": "1604", "plague": "plagues returns gates"}
SUBJECTS = {"poet": "poet of", "mark": "physicians", "name": "Zeitam Thaetiath", "judge": "judge from"}

A, B = X.fold_table()
STOPS = ",".join(f"'{w}'" for w in X.STOP)


def sql_norm(c: str) -> str:
    return f"trim(regexp_replace(translate(lower(coalesce({c}, '')), '{A}', '{B}'), '[^a-z0-9]+', ' ', 'g'))"


def sql_tokens(c: str) -> str:
    return f"""list_distinct(flatten(list_transform(list_filter(regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+'), lambda w: NOT list_contains([{STOPS}], w) AND (length(w) >= 3 OR (length(w) >= 2 AND regexp_matches(w, '[0-9]')))),
  lambda w: CASE WHEN length(w) > 4 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN [w, left(w, -1)] ELSE [w] END)))"""


SQL_INDEX = f"""t AS (SELECT row_id AS doc, unnest({sql_tokens('text')}) AS token FROM published), n AS (SELECT count(*) AS n FROM published),
idx AS (SELECT t.* FROM t JOIN (SELECT token FROM t GROUP BY token HAVING count(*) <= (SELECT n // 5 FROM n)) USING (token))"""


def index(t):
    docs = t.published.select(F.col("row_id").alias("doc"), "year", "text")
    return docs, S.tokens_of(docs, "doc", X.index_tokens(F.col("text")))


@R.add(f"WITH {SQL_INDEX} SELECT token, left(token, 1) AS bucket, (doc // 65536)::BIGINT AS shard, count(*) AS df, string_agg(doc::VARCHAR, ',' ORDER BY doc) AS docs FROM idx GROUP BY 1, 2, 3")
def q01_index(t):
    """Posting lists of every token in at most a fifth of the rows, in shards."""
    docs, tokens = index(t)
    return S.postings(tokens, docs.agg(F.count(F.lit(1))).scalar()).select("token", "bucket", "shard", F.size("docs").cast("bigint").alias("df"), F.array_join(F.col("docs").cast("array<string>"), ",").alias("docs"))


def sql_terms() -> str:
    rows = []
    for q, text in SOUGHT.items():
        n = 0
        for w in re.findall("[a-z0-9]+", text.lower()):
            if len(w) < (2 if re.search("[0-9]", w) else 3) or w in X.STOP:
                continue
            rows += [(q, n, w)] + ([(q, n, w[:-1])] if len(w) > 4 and w.endswith("s") and not w.endswith("ss") else [])
            n += 1
    return "(VALUES " + ",".join(f"('{q}', {n}, '{w}')" for q, n, w in rows) + ") AS terms(q, word, form)"


def sql_search(limit: int, where: str = "true") -> str:
    phrases = ",".join(f"('{q}', '{t}', {t if t.isdigit() else 'NULL'})" for q, t in SOUGHT.items())
    return f"""
WITH {SQL_INDEX}, h AS (SELECT DISTINCT q, word, doc FROM idx JOIN {sql_terms()} ON token = form),
i AS (SELECT q, word, ln((SELECT n FROM n)::DOUBLE / count(*)) AS idf FROM h GROUP BY 1, 2), k AS (SELECT q, count(*) AS words FROM i GROUP BY 1),
s AS (SELECT q, doc, sum(idf) AS score, count(*) AS hits FROM h JOIN i USING (q, word) GROUP BY 1, 2),
b AS (SELECT s.*, words, max(hits) OVER (PARTITION BY q) AS most FROM s JOIN k USING (q)),
p AS (SELECT q, {sql_norm('phrase')} AS phrase, as_year FROM (VALUES {phrases}) AS x(q, phrase, as_year)),
f AS (SELECT b.q, doc, d.year, score, phrase, as_year, {sql_norm('d.text')} AS flat FROM b JOIN p USING (q) JOIN published d ON d.row_id = doc WHERE (most < words OR hits = words) AND {where}),
r AS (SELECT q, doc, year, round(score + CASE WHEN phrase <> '' AND strpos(flat, phrase) > 0 THEN 1000 + 300 * (1 - (strpos(flat, phrase) - 1)::DOUBLE / greatest(length(flat), 1)) ELSE 0 END + CASE WHEN year = as_year THEN 2000 ELSE 0 END, 6) AS score FROM f)
SELECT q, doc, score, place FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, year, doc)::INTEGER AS place FROM r) WHERE place <= {limit}"""


@R.add(sql_search(25))
def q02_search(t):
    """Ranked search: rare words, all words first, phrases and bare years on top (q02, q03, q05, q06)."""
    return S.search(*index(t), SOUGHT, 25)


@R.add(sql_search(25))
def q02_search_stored(t):
    """The same over an index that is written once and of which only the buckets asked for are read."""
    stage = Stage(t.spark, "search")
    docs, tokens = index(t)
    path = stage.path("index")
    S.write_index(docs, tokens, path)
    return S.search_index(t.spark, path, SOUGHT, 25)


@R.add(sql_search(25, "d.year BETWEEN 1200 AND 1700"))
def q04_search_in_years(t):
    """The same within a span of years."""
    return S.search(*index(t), SOUGHT, 25, 1200, 1700)


SQL_SUBJECTS = f"""
WITH q AS (SELECT q, {sql_norm('phrase')} AS phrase FROM (VALUES {','.join(f"('{q}', '{t}')" for q, t in SUBJECTS.items())}) AS x(q, phrase)),
s AS (SELECT slug, entries, {sql_norm('label')} AS label, {sql_norm('description')} AS description FROM subjects),
w AS (SELECT q, slug, entries, label, phrase, description, unnest(list_filter(string_split(phrase, ' '), lambda t: length(t) > 1)) AS t FROM q, s),
p AS (SELECT q, slug, any_value(entries) AS entries, max(CASE WHEN label = phrase THEN 1000 WHEN starts_with(label, phrase) THEN 500 WHEN contains(label, phrase) THEN 250 ELSE 0 END)
 + sum(CASE WHEN list_contains(string_split(label, ' '), t) THEN 60 WHEN length(t) >= 4 AND NOT regexp_matches(t, '^[0-9]+$') AND contains(' ' || label, ' ' || t) THEN 25 ELSE 0 END
 + CASE WHEN length(t) >= 4 AND NOT regexp_matches(t, '^[0-9]+$') AND contains(' ' || description, ' ' || t) THEN 8 ELSE 0 END) AS points FROM w GROUP BY 1, 2),
r AS (SELECT q, slug, round(points + least(entries, 400) / 100, 4) AS score FROM p WHERE points > 0), b AS (SELECT *, max(score) OVER (PARTITION BY q) AS best FROM r)
SELECT q, slug, score, place FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, slug)::INTEGER AS place FROM b WHERE score >= greatest(best * 0.45, 20)) WHERE place <= 6"""


@R.add(SQL_SUBJECTS)
def q07_subjects(t):
    """Subjects ranked for a few queries."""
    return S.rank_subjects(t.subjects, SUBJECTS)


@R.add(f"SELECT q, count(*) AS entries, round(max(score), 4) AS best FROM ({sql_search(25)}) GROUP BY q")
def q08_totals(t):
    """Entries found and best score of each query."""
    return S.search(*index(t), SOUGHT, 25).groupBy("q").agg(F.count(F.lit(1)).alias("entries"), F.round(F.max("score"), 4).alias("best"))


@R.add(f"""
WITH e AS ({sql_search(8)}), y AS (SELECT e.q, e.doc, e.score, p.year FROM e JOIN published p ON p.row_id = e.doc), d AS (SELECT doc, min(q) AS q, max(score) AS score, any_value(year) AS year FROM y GROUP BY doc)
SELECT doc, q, year, row_number() OVER (ORDER BY year, doc)::INTEGER AS passage FROM d""")
def q10_passages(t):
    """Results of several queries merged and numbered chronologically."""
    from pyspark.sql import Window

    docs, tokens = index(t)
    found = S.search(docs, tokens, SOUGHT, 8).join(docs.select("doc", "year"), "doc")
    # at most the limit times the number of queries
    merged = found.groupBy("doc").agg(F.min("q").alias("q"), F.max("score").alias("score"), F.first("year").alias("year"))
    return merged.select("doc", "q", "year", F.row_number().over(Window.orderBy("year", "doc")).alias("passage"))


@R.add("""
WITH a AS (SELECT row_id AS answer, [x::INTEGER % 20 + 1 FOR x IN regexp_extract_all(text, '[0-9]+') IF length(x) < 6] AS cited FROM published WHERE text IS NOT NULL)
SELECT answer, c AS passage FROM (SELECT answer, unnest(list_distinct(cited)) AS c FROM a)""")
def q11_cited(t):
    """The passages that each answer cites by number."""
    numbers = F.filter(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)), lambda x: F.length(x) < 6)
    return t.published.where("text is not null").select(F.col("row_id").alias("answer"), F.explode(F.array_distinct(F.transform(numbers, lambda x: x.cast("int") % 20 + 1))).alias("passage"))
