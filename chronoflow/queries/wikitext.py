"""Queries on wikitext extraction."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F

from chronoflow.functions import wikitext as W
from chronoflow.functions.timeaxis import MONTHS
from chronoflow.operators import wikitext as X
from chronoflow.queries.aggregates import SQL_MD, dated
from chronoflow.queries.registry import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM documents WHERE kind = 'raw' AND text IS NOT NULL"
HEAD = "'^(={2,6})[ \\t]*(.*?)[ \\t]*(={2,6})[ \\t]*$'"


def raw(t):
    return t.documents.where("kind = 'raw' and text is not null")


def sql_plain(c: str) -> str:
    for pattern, to in ((r"<ref[^>/]*/>", ""), (r"<ref[^>]*>[^<]*</ref>", ""), (r"\{\{[^{}]*\}\}", ""), (r"\[\[[^\[\]|]*\|([^\[\]|]*)\]\]", r"\1"), (r"\[\[([^\[\]|]*)\]\]", r"\1"), ("''''+", ""), ("&ndash;", "–"), ("&nbsp;", " "), (r"^[*:# \x{00a0}]+|[ \x{00a0}]+$", "")):
        c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
    return c


@R.add(f"SELECT doc_id, n::INTEGER AS n, {sql_plain('line')} AS said, len(regexp_extract_all(line, '\\[\\[[^\\[\\]]+\\]\\]'))::INTEGER AS links FROM ({LINES}) WHERE starts_with(line, '*')")
def x01_plain_lines(t):
    """Bullets of raw texts as plain sentences, with the number of their links."""
    rows = X.lines(raw(t), "doc_id", "text").where("startswith(line, '*')")
    return rows.select("doc_id", "n", X.plain(F.col("line")).alias("said"), F.size(F.regexp_extract_all("line", F.lit(r"\[\[[^\[\]]+\]\]"), F.lit(0))).alias("links"))


@R.add(f"SELECT doc_id, n::INTEGER AS n, last_value(CASE WHEN regexp_matches(line, {HEAD}) THEN regexp_extract(line, {HEAD}, 2) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS heading FROM ({LINES})")
def x05_headings(t):
    """The heading that each line of a raw text stands under."""
    return X.lines(raw(t), "doc_id", "text").select("doc_id", "n", "heading")


HEADING = "'^(={2,6})\\s*(.+?)\\s*(={2,6})\\s*$'"


@R.add(f"""
WITH h AS (SELECT doc_id, n, length(regexp_extract(line, {HEADING}, 1)) AS level, regexp_extract(line, {HEADING}, 2) AS name FROM ({LINES}) WHERE regexp_matches(line, {HEADING})),
l AS (SELECT * FROM ({LINES}) WHERE NOT regexp_matches(line, {HEADING})),
t AS (SELECT l.doc_id, l.n, string_agg(h.name, ' › ' ORDER BY h.level) AS trail FROM l JOIN h ON h.doc_id = l.doc_id AND h.n < l.n AND NOT EXISTS (SELECT 1 FROM h o WHERE o.doc_id = h.doc_id AND o.n > h.n AND o.n < l.n AND o.level <= h.level) GROUP BY 1, 2)
SELECT doc_id, n::INTEGER AS n, coalesce(trail, '') AS trail FROM l LEFT JOIN t USING (doc_id, n)""")
def x05_trails(t):
    """The headings above each line of a raw text, one per level."""
    return X.sections(raw(t), "doc_id", "text").select("doc_id", "n", F.array_join("trail", " › ").alias("trail"))


_M = "|".join(MONTHS)


@R.add(rf"SELECT doc_id, n::INTEGER AS n, regexp_extract({sql_plain('line')}, '^({_M})( [0-9]{{1,2}})?( and ({_M}) [0-9]{{1,2}})?$', 0) AS header FROM ({LINES}) WHERE regexp_matches({sql_plain('line')}, '^({_M})( [0-9]{{1,2}})?( and ({_M}) [0-9]{{1,2}})?$')")
def x06_date_headers(t):
    """Lines that are only a date: headers of what is below them."""
    rows = X.lines(raw(t), "doc_id", "text").select("doc_id", "n", X.plain(F.col("line")).alias("header"))
    return rows.where(F.col("header").rlike(rf"^({_M})( [0-9]{{1,2}})?( and ({_M}) [0-9]{{1,2}})?$"))


@R.add(f"SELECT row_id, m::INTEGER AS month, d AS day FROM ({SQL_MD})")
def x07_leading_dates(t):
    """Month and day that each row's date names."""
    return dated(t).select("row_id", "month", "day")


_N = "CASE WHEN year > 0 THEN year ELSE abs(year) + 1 END"
SQL_TITLES = f"CASE WHEN year > 0 THEN [{_N} || '', 'AD ' || {_N}, {_N} || ' AD', {_N} || ' events'] ELSE [{_N} || ' BC', {_N} || ' BCE', {_N} || ' BC events'] END"


@R.add(rf"""
WITH x AS (SELECT row_id, year, source_title, coalesce(text, '') AS text, string_split(coalesce(source_section, ''), ' › ') AS trail, {SQL_TITLES} AS titles,
 '(?is)^(?:c\.|circa|ca\.)?\s*(?:AD\s+)?' || {_N} || CASE WHEN year > 0 THEN '(?:\s*(?:AD|CE))?' ELSE '\s*(?:BCE?)' END || '\s*[:–—-]\s*(.*)$' AS begins FROM published WHERE year IS NOT NULL)
SELECT row_id, coalesce(list_contains(titles, trim(source_title)), false) OR list_has_any(list_transform(titles, lambda s: lower(s)), list_transform(trail, lambda s: lower(trim(s))))
 OR (regexp_matches(text, begins) AND NOT regexp_matches(regexp_extract(text, begins, 1), '(?i)^\d{{1,4}}\s*(?:BCE?|AD)?\s*[:–—-]')) AS about FROM x""")
def x08_year_scope(t):
    """Whether a row is about its year: by its source's title, by a heading above it, or by how it begins."""
    x = t.published.where("year is not null")
    trail = F.split(F.coalesce("source_section", F.lit("")), " › ")
    return x.select("row_id", (F.coalesce(F.array_contains(X.titles_of(F.col("year")), F.trim("source_title")), F.lit(False)) | X.about_year(F.col("year"), trail, F.coalesce("text", F.lit("")))).alias("about"))


@R.add()
def x09_claims(t):
    """Claims of all raw texts with ids, trails and links."""
    return X.claims(raw(t), "doc_id", "text", "year")


@R.add(rf"SELECT doc_id, n::INTEGER AS n, trim(regexp_replace(regexp_replace(regexp_replace(line, '(?i)<ref[^>/]*/>', '', 'g'), '(?i)<ref[^>]*>[^<]*</ref>', '', 'g'), '\{{\{{[^{{}}]*\}}\}}', '', 'g')) AS said FROM ({LINES}) WHERE trim(line) <> ''")
def x02_templates(t):
    """Lines of raw texts with their templates, measures and media resolved (x02, x03, x04)."""

    def run(line: pd.Series) -> pd.Series:
        return line.map(lambda x: W.templates(re.sub(r"(?is)<ref[^>/]*/>|<ref[^>]*>.*?</ref>", "", W.without_media(x)))[0])

    rows = raw(t).select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).where("trim(line) <> ''")
    return rows.select("doc_id", "n", F.trim(F.pandas_udf(run, "string")("line")).alias("said"))


@R.add(r"""
WITH s AS (SELECT doc_id, split_part(text, chr(10) || chr(10), 1) AS lead FROM documents WHERE kind = 'year' AND text IS NOT NULL) SELECT doc_id, lead FROM s WHERE length(lead) > 80""")
def x10_highlights(t):
    """Leading paragraphs long enough to stand for their page."""
    lead = F.split_part("text", F.lit("\n\n"), F.lit(1))
    return t.documents.where("kind = 'year' and text is not null").select("doc_id", lead.alias("lead")).where("length(lead) > 80")


@R.add(f"""
WITH p AS (SELECT doc_id, n, {sql_plain('line')} AS said FROM ({LINES})), d AS (SELECT *, last_value(nullif(regexp_extract(said, '^((?:{_M}) [0-9]{{1,2}})', 1), '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS day FROM p)
SELECT doc_id, n::INTEGER AS n, day FROM d WHERE regexp_matches(said, 'aged [0-9]+|mourned by')""")
def x11_deaths(t):
    """Deaths listed in raw texts with the day in force at their line."""
    from chronoflow.operators.ordered import carried

    rows = X.lines(raw(t), "doc_id", "text").select("doc_id", "n", X.plain(F.col("line")).alias("said"))
    day = F.nullif(F.regexp_extract("said", rf"^((?:{_M}) [0-9]{{1,2}})", 1), F.lit(""))
    return carried(rows, ["doc_id"], ["n"], day, "day").where(F.col("said").rlike("aged [0-9]+|mourned by")).select("doc_id", "n", "day")


@R.add(f"SELECT row_id, coalesce(p.country, a.place) AS place, CASE WHEN date IS NULL AND source_section IS NOT NULL THEN list_last(string_split(source_section, ' › ')) ELSE date END AS day FROM published p JOIN articles a USING (page_id) WHERE a.place IS NOT NULL AND NOT regexp_matches(coalesce(text, ''), '^({_M}) [0-9]')")
def x12_place_claims(t):
    """Rows of country pages with their place and the month restored from the section."""
    a = t.articles.where("place is not null").select("page_id", "place")
    x = t.published.join(a, "page_id").where(~F.coalesce("text", F.lit("")).rlike(f"^({_M}) [0-9]"))
    month = F.element_at(F.split("source_section", " › "), -1)
    return x.select("row_id", F.coalesce("country", "place").alias("place"), F.when(F.col("date").isNull() & F.col("source_section").isNotNull(), month).otherwise(F.col("date")).alias("day"))


@R.add("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM documents WHERE kind = 'facts' AND text IS NOT NULL), c AS (SELECT doc_id, n, string_split(line, '|') AS c FROM l WHERE n > 0)
SELECT doc_id, n::INTEGER AS n, try_cast(c[1] AS INTEGER) AS year, try_cast(replace(c[2], ',', '') AS BIGINT) AS population, try_cast(c[3] AS DOUBLE) AS price, c[4] AS holder FROM c WHERE len(c) = 4 AND try_cast(c[1] AS INTEGER) IS NOT NULL""")
def x13_tables(t):
    """Rows of the fact tables, figures read."""
    rows = t.documents.where("kind = 'facts' and text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).where("n > 0")
    c = rows.select("doc_id", "n", F.split("line", r"\|").alias("c")).where("size(c) = 4")
    out = c.select("doc_id", "n", F.get("c", 0).try_cast("int").alias("year"), F.replace(F.get("c", 1), F.lit(","), F.lit("")).try_cast("bigint").alias("population"), F.get("c", 2).try_cast("double").alias("price"), F.get("c", 3).alias("holder"))
    return out.where("year is not null")


@R.add(f"WITH b AS (SELECT doc_id, n, length(regexp_extract(line, '^(\\*+)', 1)) AS depth FROM ({LINES}) WHERE starts_with(line, '*')) SELECT b.doc_id, b.n::INTEGER AS n, b.depth::INTEGER AS depth, max(a.n)::INTEGER AS parent FROM b LEFT JOIN b a ON a.doc_id = b.doc_id AND a.n < b.n AND a.depth < b.depth GROUP BY 1, 2, 3")
def x15_bullet_trees(t):
    """Bullets of raw texts with their parents."""
    return X.bullet_trees(raw(t), "doc_id", "text")


@R.add(r"""
SELECT term_id, trim(split_part(quote, ',', 1)) AS holder, trim(regexp_extract(quote, '^[^,]*,([^(]*)', 1)) AS post, len(regexp_extract_all(quote, '[0-9]{1,4}\s*[–-]'))::INTEGER AS ranges FROM stateleaders WHERE quote IS NOT NULL""")
def x16_holders(t):
    """Holder, post and number of ranges of each quoted line."""
    q = F.col("quote")
    return t.stateleaders.where("quote is not null").select("term_id", F.trim(F.split_part(q, F.lit(","), F.lit(1))).alias("holder"), F.trim(F.regexp_extract(q, r"^[^,]*,([^(]*)", 1)).alias("post"), F.size(F.regexp_extract_all(q, F.lit(r"[0-9]{1,4}\s*[–-]"), F.lit(0))).alias("ranges"))


@R.add()
def x13_wikitables(t):
    """Cells of the tables in raw texts, spans filled in."""
    return X.tables(raw(t), "doc_id", "text")


@R.add()
def x16_holder_terms(t):
    """Persons, post and terms of each quoted line, and what in it is too vague to be a term."""
    return X.holders(t.stateleaders.select("term_id", "quote"), "term_id", "quote")


@R.add(f"SELECT doc_id, count(*) FILTER (contains({sql_plain('line')}, '[[') OR contains({sql_plain('line')}, '{{{{'))::BIGINT AS residue, count(*) AS lines FROM ({LINES}) GROUP BY doc_id")
def x17_residue(t):
    """Lines of raw texts that still hold markup after a naive strip."""
    said = X.plain(F.col("line"))
    rows = raw(t).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return rows.groupBy("doc_id").agg(F.count_if(F.contains(said, F.lit("[[")) | F.contains(said, F.lit("{{"))).alias("residue"), F.count(F.lit(1)).alias("lines"))


@R.add("SELECT row_id, CASE WHEN contains(text, ' – ') THEN replace(text, ' – ', ' - ') ELSE text END AS text, year, site FROM published")
def x18_rerender(t):
    """Rows rendered again where they match, all other fields kept."""
    return t.published.select("row_id", F.when(F.contains("text", F.lit(" – ")), F.replace("text", F.lit(" – "), F.lit(" - "))).otherwise(F.col("text")).alias("text"), "year", "site")


@R.add()
def x19_main_text(t):
    """Content of pages: the documents wrapped as HTML with navigation and scripts, read back."""

    def run(page: pd.Series) -> pd.Series:
        return page.map(W.main_text)

    page = F.concat(F.lit("<html><script>x()</script><nav>menu</nav><article><p>"), F.replace(F.replace("text", F.lit("<"), F.lit("&lt;")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p></article><footer>f</footer></html>"))
    return t.documents.where("text is not null").select("doc_id", F.length(F.pandas_udf(run, "string")(page)).alias("chars"))


@R.add(r"SELECT page_id, regexp_extract(source.url, '[?&]oldid=([0-9]+)', 1) AS oldid, regexp_extract(source.url, '^https?://([^/]+)', 1) AS host FROM articles")
def x20_read_back(t):
    """Host and revision read back from articles' addresses."""
    return t.articles.select("page_id", F.regexp_extract("source.url", r"[?&]oldid=([0-9]+)", 1).alias("oldid"), F.regexp_extract("source.url", r"^https?://([^/]+)", 1).alias("host"))
