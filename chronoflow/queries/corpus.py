"""Queries on quality filters, vectors and filters on rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoflow.functions.timeaxis import MONTHS
from chronoflow.operators import corpus_filters as G
from chronoflow.operators.vectors import classify
from chronoflow.queries.registry import Registry

R = Registry()
QUERIES, SQL = R.queries, R.sql

SQL_BASE = r"""b AS (SELECT doc_id, kind, source, lang, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^ \t\r\n\f]+') AS w,
 list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_replace(s, '^[ \t\r\f]+|[ \t\r\f]+$', '', 'g')), lambda s: s <> '') AS l FROM documents),
c AS (SELECT *, len(w) AS n, len(l) AS m, list_distinct(l) AS d, list_filter(l, lambda s: NOT contains(lower(s), 'javascript') AND NOT regexp_matches(lower(s), 'terms of use|privacy policy|cookie policy|uses cookies|use of cookies|use cookies')) AS kept FROM b)"""


def share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(({part})::DOUBLE / {whole}, 6) END"


def removed(s: str) -> str:
    return f"(length(x) - length(replace(x, '{s}', '')))"


CHARS = "list_sum(list_transform({}, lambda s: length(s)))"
SQL_MEASURES = {
    "words": "n::INTEGER",
    "mean_word": share(CHARS.format("w"), "n"),
    "duplicate_lines": share("m - len(d)", "m"),
    "bullets": share("len(list_filter(l, lambda s: regexp_matches(s, '^[•‣*-]')))", "m"),
    "ellipses": share(r"len(list_filter(l, lambda s: regexp_matches(s, '(\.\.\.|…)$')))", "m"),
    "alphabetic": share(r"len(list_filter(w, lambda s: regexp_matches(s, '\p{L}')))", "n"),
    "common": "len(list_intersect(list_transform(w, lambda s: lower(s)), ['the','be','to','of','and','that','have','with']))::INTEGER",
    "hashes": share(removed("#"), "n"),
    "dots": share(f"{removed('...')} / 3 + {removed('…')}", "n"),
    "ended_lines": share("""len(list_filter(l, lambda s: regexp_matches(s, '[.!?"”]$')))""", "m"),
    "short_lines": share("len(list_filter(l, lambda s: length(s) <= 30))", "m"),
    "duplicate_line_chars": share(f"{CHARS.format('l')} - {CHARS.format('d')}", CHARS.format("l")),
    "line_breaks": "CASE WHEN n > 0 THEN round((length(x) - length(replace(x, chr(10), '')))::DOUBLE / n, 6) END",
    "lorem": "contains(lower(x), 'lorem ipsum')",
    "brace": "contains(x, '{')",
    "sentences": r"""len(regexp_extract_all(array_to_string(kept, chr(10)), '[.!?]+(?:[ \n”"]|$)'))::INTEGER""",
}
SQL_ALL = f"WITH {SQL_BASE}, g AS (SELECT doc_id, kind, lang, {', '.join(f'{e} AS {n}' for n, e in SQL_MEASURES.items())} FROM c)"
SQL_VERDICT = "CASE " + " ".join(f"WHEN {c.replace('endswith(', 'ends_with(')} THEN '{n}'" for n, c in G.WHOLE) + " ELSE 'pass' END"
#: n-grams of the words between white space; repeated ones are skipped as a whole, so the fold goes over the places where a gram stands again.
SQL_NGRAMS = r"""
nw AS (SELECT doc_id, regexp_extract_all(text, '[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+') AS w FROM documents WHERE text IS NOT NULL),
nt AS (SELECT doc_id, w, greatest(coalesce(list_sum(list_transform(w, lambda s: length(s))), 0), 1) AS total FROM nw),
np AS (SELECT doc_id, w, total, unnest(range(1, len(w) + 1)) AS i FROM nt),
ng AS (SELECT doc_id, total, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram, length(array_to_string(w[i:i + n - 1], '')) AS size FROM np, (SELECT unnest(range(2, 11)) AS n) WHERE i + n - 1 <= len(w)),
nc AS (SELECT doc_id, any_value(total) AS total, n, gram, any_value(size) AS size, count(*) AS c, list(i ORDER BY i) AS pos FROM ng GROUP BY doc_id, n, gram HAVING count(*) > 1),
top AS (SELECT doc_id, n, round(max_by(size, c * 1000000 + size) * max(c) / any_value(total), 6) AS share FROM nc WHERE n <= 4 GROUP BY doc_id, n),
again AS (SELECT doc_id, n, total, list({'i': i, 'size': size, 'pos': pos} ORDER BY i) AS seen FROM (SELECT doc_id, n, total, size, pos, unnest(pos[2:]) AS i FROM nc WHERE n > 4) GROUP BY doc_id, n, total),
folded AS (SELECT doc_id, n, round(list_reduce(seen, lambda a, x: CASE WHEN (len(a.s) = 0 OR a.s[-1] + n <= x.i) AND len(list_filter(x.pos, lambda j: j < x.i AND NOT list_bool_or(list_transform(a.s, lambda b: j > b AND j < b + n)) IS TRUE)) > 0 THEN {'s': list_append(a.s, x.i), 'c': a.c + x.size} ELSE a END, {'s': []::BIGINT[], 'c': 0::BIGINT}).c / total, 6) AS share FROM again),
wide AS (SELECT doc_id, """ + ", ".join(f"coalesce(max(share) FILTER (n = {n.split('_')[1]}), 0) AS {n}" for n, _ in G.NGRAMS) + """ FROM documents LEFT JOIN (SELECT * FROM top UNION ALL SELECT * FROM folded) USING (doc_id) GROUP BY doc_id)"""
SQL_WHOLE = f"{SQL_ALL.replace('SELECT doc_id, kind, lang,', 'SELECT doc_id, kind, lang, source,')}, {SQL_NGRAMS}, v AS (SELECT doc_id, kind, {SQL_VERDICT} AS verdict FROM g JOIN wide USING (doc_id))"


@R.add(f"{SQL_WHOLE} SELECT doc_id, verdict FROM v")
def g01_verdicts(t):
    """The first filter that each document fails."""
    return G.verdicts(t.documents, "text", G.WHOLE).select("doc_id", "verdict")


@R.add("SELECT doc_id, trim(coalesce(text, ''), chr(32) || chr(9) || chr(13) || chr(10) || chr(12)) = '' AS empty FROM documents")
def g02_empty(t):
    """Documents without text."""
    return t.documents.select("doc_id", F.expr("btrim(coalesce(text, ''), ' \\t\\r\\n\\f')").eqNullSafe("").alias("empty"))


@R.add("SELECT page_id, regexp_extract(source.url, '^https?://([^/]+)', 1) AS host FROM articles WHERE NOT ends_with(regexp_extract(source.url, '^https?://([^/]+)', 1), '.invalid')")
def g03_url_block(t):
    """Articles whose host is not on a block list."""
    return t.articles.select("page_id", F.parse_url("source.url", F.lit("HOST")).alias("host")).where(~F.endswith("host", F.lit(".invalid")))


@R.add("SELECT doc_id, CASE WHEN lower(lang) IN ('en','de','fr','es') THEN lower(lang) ELSE 'und' END AS lang, coalesce(lower(lang) = 'en', false) AS kept FROM documents")
def g04_language(t):
    """Documents by recorded language."""
    low = F.lower("lang")
    return t.documents.select("doc_id", F.when(low.isin("en", "de", "fr", "es"), low).otherwise("und").alias("lang"), F.coalesce(low == "en", F.lit(False)).alias("kept"))


def _measure(name: str, measure: str, condition: str, doc: str) -> None:
    def run(t):
        return G.measured(t.documents, "text").select("doc_id", measure, F.coalesce(F.expr(condition), F.lit(False)).alias("fails"))

    run.__name__, run.__doc__ = name, doc
    R.add(f"{SQL_ALL} SELECT doc_id, {measure}, coalesce({condition}, false) AS fails FROM g")(run)


for _name, _column, _condition, _doc in (
    ("g05_duplicate_lines", "duplicate_lines", "duplicate_lines > 0.30", "Share of repeated lines."),
    ("g08_word_count", "words", "words < 50 OR words > 100000", "Number of words."),
    ("g09_mean_word_length", "mean_word", "mean_word < 3 OR mean_word > 10", "Mean length of words."),
    ("g10_bullets", "bullets", "bullets > 0.90", "Share of lines that begin with a bullet."),
    ("g10_ellipses", "ellipses", "ellipses > 0.30", "Share of lines that end with an ellipsis."),
    ("g11_alphabetic", "alphabetic", "alphabetic < 0.80", "Share of words with a letter."),
    ("g12_common_words", "common", "common < 2", "Number of the most common words present."),
    ("g13_hashes", "hashes", "hashes > 0.1", "Hash signs per word."),
    ("g13_dots", "dots", "dots > 0.1", "Ellipses per word."),
    ("g14_ended_lines", "ended_lines", "ended_lines < 0.12", "Share of lines that end a sentence."),
    ("g15_short_lines", "short_lines", "short_lines > 0.67", "Share of short lines."),
    ("g16_duplicate_line_chars", "duplicate_line_chars", "duplicate_line_chars > 0.01", "Share of characters in repeated lines."),
    ("g17_line_breaks", "line_breaks", "line_breaks > 0.3", "Line breaks per word."),
    ("g18_sentences", "sentences", "lorem OR brace OR sentences < 3", "Sentences after lines on scripts and policies are dropped."),
):
    _measure(_name, _column, _condition, _doc)


SQL_STRICT = r"""len(regexp_extract_all(array_to_string(list_filter(kept, lambda s: regexp_matches(s, '[.!?"”]$')), chr(10)), '[.!?]+(?:[ \n”"]|$)'))::INTEGER"""


@R.add(f"WITH {SQL_BASE} SELECT doc_id, {SQL_STRICT} AS sentences, {SQL_STRICT} < 3 AS fails FROM c")
def g18_strict(t):
    """Sentences left when lines that end no sentence are dropped too (the strict rule)."""
    x = F.coalesce("text", F.lit(""))
    kept = F.filter(G.lines(x), lambda s: ~F.contains(F.lower(s), F.lit("javascript")) & ~F.lower(s).rlike(G.POLICY) & s.rlike(r"[.!?\"”]$"))
    n = F.size(F.regexp_extract_all(F.array_join(kept, "\n"), F.lit(r"[.!?]+(?:[ \n”\"]|$)"), F.lit(0)))
    return t.documents.select("doc_id", n.alias("sentences"), (n < 3).alias("fails"))


@R.add(f"WITH {SQL_NGRAMS} SELECT *, CASE {' '.join(f"WHEN {c} THEN '{n}'" for n, c in G.NGRAMS)} ELSE 'pass' END AS verdict FROM wide")
def g06_repetition(t):
    """Shares of characters in the most frequent and in repeated word n-grams (g06 and g07)."""
    return G.repetition(t.documents, "doc_id", "text")


@R.add(f"{SQL_WHOLE} SELECT kind, count(*) AS n, round(avg((verdict = 'pass')::INTEGER), 6) AS rate, mode(verdict ORDER BY verdict) FILTER (verdict <> 'pass') IS NOT NULL AS some_fail FROM v GROUP BY kind")
def a21_pass_rates(t):
    """Share of documents of each kind that pass all filters."""
    v = G.verdicts(t.documents, "text", G.WHOLE)
    return v.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("verdict") == "pass").cast("int")), 6).alias("rate"), (F.count_if(F.col("verdict") != "pass") > 0).alias("some_fail"))


@R.add(f"{SQL_WHOLE} SELECT verdict, count(*) AS n FROM v GROUP BY verdict")
def a21_failure_codes(t):
    """Documents per verdict."""
    return G.verdicts(t.documents, "text", G.WHOLE).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


PROTOTYPES = "SELECT label, embedding FROM (SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings) WHERE k <= 4"


def prototypes(t):
    """Four vectors per label: a small stated set."""
    w = Window.partitionBy("label").orderBy("vec_id")
    return [(r.label, r.embedding) for r in t.embeddings.withColumn("k", F.row_number().over(w)).where("k <= 4").select("label", "embedding").collect()]


SQL_SIMS = f"""p AS ({PROTOTYPES}), s AS (SELECT vec_id, e.label AS own, p.label AS theme, max(list_cosine_similarity(e.embedding::DOUBLE[], p.embedding::DOUBLE[])) AS s FROM embeddings e, p GROUP BY 1, 2, 3)"""


@R.add(f"WITH {SQL_SIMS} SELECT vec_id, theme, round(s, 4) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, theme) AS k FROM s) WHERE k = 1")
def e01_nearest_theme(t):
    """The theme whose prototypes each vector is nearest to."""
    return classify(t.embeddings, "vec_id", "embedding", prototypes(t))


SQL_RULES = """CASE WHEN kind = 'death' OR regexp_matches(lower(text), '(^|[^\\p{L}])(dies|mourned by)([^\\p{L}]|$)') THEN 'Deaths' WHEN kind = 'birth' THEN 'Births' WHEN section IS NOT NULL THEN section
 WHEN regexp_matches(lower(text), 'siege|army|truce|garrison') THEN 'War and Siege' WHEN regexp_matches(lower(text), 'bridge|canal|walls') THEN 'Building' WHEN regexp_matches(lower(text), 'elects|regency|warden|acclaimed') THEN 'Rule and Office' WHEN near IS NOT NULL THEN 'Topic ' || near ELSE 'Other' END"""
SQL_FROM = """CASE WHEN kind IN ('birth', 'death') OR regexp_matches(lower(text), '(^|[^\\p{L}])(dies|mourned by)([^\\p{L}]|$)') THEN 'rule' WHEN section IS NOT NULL THEN 'heading' WHEN regexp_matches(lower(text), 'siege|army|truce|garrison|bridge|canal|walls|elects|regency|warden|acclaimed') THEN 'words' WHEN near IS NOT NULL THEN 'vectors' ELSE 'none' END"""
SQL_NEAR = f"{SQL_SIMS}, near AS (SELECT vec_id, theme AS near FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, theme) AS k FROM s) WHERE k = 1), x AS (SELECT row_id, kind, section, coalesce(text, '') AS text, near FROM published LEFT JOIN near ON vec_id = row_id)"


def themed(t, heading=True):
    """Death rule, heading, words; a row that none of them settles goes to the theme its vector is nearest to, where it has one."""
    low = F.lower(F.coalesce("text", F.lit("")))
    death = F.coalesce(F.col("kind") == "death", F.lit(False)) | low.rlike(r"(^|[^\p{L}])(dies|mourned by)([^\p{L}]|$)")
    lexical = F.when(low.rlike("siege|army|truce|garrison"), "War and Siege").when(low.rlike("bridge|canal|walls"), "Building").when(low.rlike("elects|regency|warden|acclaimed"), "Rule and Office")
    theme = F.when(death, "Deaths").when(F.col("kind") == "birth", "Births")
    origin = F.when(death | (F.col("kind") == "birth"), "rule")
    if heading:
        theme, origin = theme.when(F.col("section").isNotNull(), F.col("section")), origin.when(F.col("section").isNotNull(), "heading")
    near = classify(t.embeddings, "vec_id", "embedding", prototypes(t)).select(F.col("vec_id").alias("row_id"), F.concat(F.lit("Topic "), F.col("theme").cast("string")).alias("near"))
    rows = t.published.select("row_id", "kind", "section", "text").join(near, "row_id", "left")
    return rows.select("row_id", "section", theme.otherwise(F.coalesce(lexical, "near", F.lit("Other"))).alias("theme"), origin.when(lexical.isNotNull(), "words").when(F.col("near").isNotNull(), "vectors").otherwise("none").alias("theme_from"))


@R.add(f"WITH {SQL_NEAR} SELECT row_id, {SQL_RULES} AS theme, {SQL_FROM} AS theme_from FROM x")
def e02_theme_cascade(t):
    """Themes by rule, heading, words or the nearest vector, with their origin."""
    return themed(t).drop("section")


@R.add(f"WITH {SQL_NEAR} SELECT section, {SQL_RULES.replace('WHEN section IS NOT NULL THEN section', '')} AS theme, count(*) AS n FROM x WHERE section IS NOT NULL GROUP BY 1, 2")
def e04_held_out(t):
    """Themes derived without the heading, against it."""
    return themed(t, heading=False).where("section is not null").groupBy("section", "theme").agg(F.count(F.lit(1)).alias("n"))


SQL_DATEISH = r"^(?:[0-9]{1,4}( BC)?|[0-9]+s|[0-9]+(st|nd|rd|th) century)$"


@R.add(f"""
WITH x AS (SELECT row_id, link FROM (SELECT row_id, unnest(links) AS link FROM published) WHERE link IS NOT NULL AND NOT regexp_matches(link, '{SQL_DATEISH}')), c AS (SELECT link, p.section AS cat, count(*) AS n FROM x JOIN published p USING (row_id) WHERE p.section IS NOT NULL GROUP BY 1, 2),
df AS (SELECT cat, ln((SELECT count(DISTINCT link) FROM c)::DOUBLE / (1 + count(*))) AS idf FROM c GROUP BY cat), b AS (SELECT link, cat, round(idf * ln(1 + n), 6) AS s FROM c JOIN df USING (cat)),
best AS (SELECT row_id, link, cat, max(s) AS s FROM x JOIN b USING (link) GROUP BY 1, 2, 3),
v AS (SELECT row_id, cat, round(sum(s), 4) AS score, count(*) AS links FROM best GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, cat) AS k, lead(score) OVER (PARTITION BY row_id ORDER BY score DESC, cat) AS second FROM v)
SELECT row_id, cat, score FROM r WHERE k = 1 AND links >= 2 AND score >= 2 AND (second IS NULL OR score >= 2 * second)""")
def e05_category_vote(t):
    """The category that a row's linked subjects vote for, if two of them or more do, and twice as strongly as for any other.

    Every subject votes once per category, with what it weighs there; links that are dates don't vote.
    """
    x = t.published.select("row_id", F.explode("links").alias("link")).where(F.col("link").isNotNull() & ~F.col("link").rlike(SQL_DATEISH))
    c = x.join(t.published.where("section is not null").select("row_id", F.col("section").alias("cat")), "row_id").groupBy("link", "cat").agg(F.count(F.lit(1)).alias("n"))
    n = c.agg(F.count_distinct("link")).scalar()
    df = c.groupBy("cat").agg(F.log(n / (1 + F.count(F.lit(1)))).alias("idf"))
    b = c.join(df, "cat").select("link", "cat", F.round(F.col("idf") * F.log1p("n"), 6).alias("s"))
    best = x.distinct().join(b, "link")
    v = best.groupBy("row_id", "cat").agg(F.round(F.sum("s"), 4).alias("score"), F.count(F.lit(1)).alias("links"))
    w = Window.partitionBy("row_id").orderBy(F.desc("score"), "cat")
    r = v.withColumn("k", F.row_number().over(w)).withColumn("second", F.lead("score").over(w)).where("k = 1")
    return r.where("links >= 2 and score >= 2 and (second is null or score >= 2 * second)").select("row_id", "cat", "score")


# filters on rows


def _filter(name: str, sql: str, condition, doc: str) -> None:
    def run(t):
        return t.published.where(condition() if callable(condition) else condition).select("row_id")

    run.__name__, run.__doc__ = name, doc
    R.add(f"SELECT row_id FROM published WHERE {sql}")(run)


_filter("filter01_unpublishable", "regexp_matches(text, '<!--|-->| – – |\\[sic|\\?\\?') OR regexp_matches(lower(text), '^(this|that|these|he|she|it|they) ')", lambda: F.col("text").rlike(r"<!--|-->| – – |\[sic|\?\?") | F.lower("text").rlike("^(this|that|these|he|she|it|they) "), "Rows with comment marks, doubled signs, or that begin with a reference back.")
_filter("filter12_range", "year BETWEEN coalesce(NULL, -9999) AND coalesce(1500, 9999)", "year between coalesce(null, -9999) and coalesce(1500, 9999)", "Rows in an open range of years.")
_filter("filter13_any_column", "contains(lower(coalesce(text, '')), 'oak') OR contains(lower(coalesce(country, '')), 'oak') OR contains(lower(coalesce(source_title, '')), 'oak')", lambda: F.contains(F.lower(F.coalesce("text", F.lit(""))), F.lit("oak")) | F.contains(F.lower(F.coalesce("country", F.lit(""))), F.lit("oak")) | F.contains(F.lower(F.coalesce("source_title", F.lit(""))), F.lit("oak")), "Rows that hold a word in any of several columns.")
_filter("filter11_alternatives", "list_bool_or(list_transform(string_split('bridge of|canal between|walls of', '|'), lambda p: contains(lower(text), p)))", lambda: F.exists(F.split(F.lit("bridge of|canal between|walls of"), r"\|"), lambda p: F.contains(F.lower("text"), p)), "Rows that hold one of several phrases.")
_filter("filter08_unbalanced", "length(text) - length(replace(text, '(', '')) <> length(text) - length(replace(text, ')', '')) OR length(text) - length(replace(text, '“', '')) <> length(text) - length(replace(text, '”', ''))", "length(text) - length(replace(text, '(', '')) <> length(text) - length(replace(text, ')', '')) or length(text) - length(replace(text, '“', '')) <> length(text) - length(replace(text, '”', ''))", "Rows with unpaired brackets or quotes.")

_MONTHS = "|".join(MONTHS)


@R.add(f"SELECT DISTINCT link, regexp_matches(link, '^(?:[0-9]{{1,4}}( BC)?|(?:{_MONTHS})( [0-9]{{1,2}})?|[0-9]+s|[0-9]+(st|nd|rd|th) century)$') AS date_like FROM (SELECT unnest(links || [year_label]) AS link FROM published)")
def filter02_date_like(t):
    """Which links are dates."""
    links = t.published.select(F.explode(F.concat("links", F.array("year_label"))).alias("link")).distinct()
    return links.select("link", F.col("link").rlike(rf"^(?:[0-9]{{1,4}}( BC)?|(?:{_MONTHS})( [0-9]{{1,2}})?|[0-9]+s|[0-9]+(st|nd|rd|th) century)$").alias("date_like"))


#: What no page is made for, by form, by beginning, by name.
NOT_WANTED = rf"^(?:(?:{_MONTHS})\s+[0-9]{{1,2}}|[0-9]{{1,4}}(\s*(BC|BCE|AD|CE))?|(AD|CE|BC|BCE)\s*[0-9]{{1,4}}|[0-9]{{1,2}}(st|nd|rd|th)\s+century|[0-9]+s)$|^(List of|Category:|File:|Image:|Template:)|^(Nobility|Roman Catholic|Catholic Church)$"


@R.add(f"SELECT label FROM (SELECT label FROM subjects UNION SELECT unnest(links) FROM published UNION SELECT year_label FROM published UNION SELECT date FROM published) WHERE length(label) BETWEEN 3 AND 70 AND regexp_matches(label, '^\\p{{Lu}}') AND NOT regexp_matches(label, '{NOT_WANTED}')")
def filter03_wanted(t):
    """Names of subjects, links, years and dates that may have a page: of fit length, a capital first, no date, year, list or namespace."""
    p = t.published
    names = t.subjects.select("label").unionByName(p.select(F.explode("links").alias("label"))).unionByName(p.select(F.col("year_label").alias("label"))).unionByName(p.select(F.col("date").alias("label"))).distinct()
    return names.where(F.length("label").between(3, 70) & F.col("label").rlike(r"^\p{Lu}") & ~F.col("label").rlike(NOT_WANTED))


_DAYS = r"[0-9]{1,2}"
_DASH = r"\s*[–—-]\s*"
#: What stands before a sentence to date it.
DATE_PREFIX = rf"^(?:(?:{_DAYS}(?:{_DASH}{_DAYS})?\s+)?(?:{_MONTHS})(?:\s+{_DAYS})?(?:{_DASH}(?:(?:{_MONTHS})\s*)?{_DAYS}(?:\s+(?:{_MONTHS}))?)?(?:\s*\([^)]*\))?|(?:Approximate|Probable) date|(?:Early|Late|Mid)?\s*(?:Spring|Summer|Autumn|Winter|{_MONTHS})){_DASH}"
#: Signs that a clue gives its year away or keeps a date before it.
TELLING = rf"[0-9]{{3,}}|^[^:]{{0,40}}\b(?:{_MONTHS})\b[^:]{{0,15}}[–—-]|^c\.\s|(?i)century|['’‘][0-9]{{2}}\b|\b[0-9]{{2}}s\b|[0-9]+(?:st|nd|rd|th)\s+(?:anniversary|birthday)"


def _thrice(c: str) -> str:
    for _ in range(3):
        c = f"trim(regexp_replace({c}, '{DATE_PREFIX}', ''))"
    return c


@R.add(f"WITH x AS (SELECT row_id, {_thrice('text')} AS clue FROM published WHERE kind = 'event') SELECT row_id, clue FROM x WHERE length(clue) BETWEEN 50 AND 240 AND regexp_matches(clue, '^\\p{{Lu}}') AND NOT regexp_matches(clue, '{TELLING.replace(chr(39), chr(39) * 2)}')")
def filter04_clues(t):
    """Events that make a clue: dates before them taken off, of fit length, beginning with a capital, not telling their year."""
    clue = F.col("text")
    for _ in range(3):
        clue = F.trim(F.regexp_replace(clue, DATE_PREFIX, ""))
    x = t.published.where("kind = 'event'").select("row_id", clue.alias("clue"))
    return x.where(F.length("clue").between(50, 240) & F.col("clue").rlike(r"^\p{Lu}") & ~F.col("clue").rlike(TELLING))


@R.add(r"""
WITH x AS (SELECT row_id, year, text, len(regexp_extract_all(text, '[^ \t\r\n\f]+')) AS words, len(regexp_extract_all(text, '\p{Lu}\p{Ll}+')) AS names, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS norm FROM published WHERE kind = 'event' AND text IS NOT NULL),
u AS (SELECT norm FROM x GROUP BY norm HAVING count(DISTINCT year) = 1)
SELECT row_id, words::INTEGER AS words, names::INTEGER AS names FROM x WHERE words BETWEEN 8 AND 70 AND names >= 2 AND NOT regexp_matches(text, '(^|[^\p{L}\p{N}])[0-9]{4}([^\p{L}\p{N}]|$)') AND NOT regexp_matches(lower(text), '(^|[^\p{L}\p{N}])(born|died|b\.|d\.)') AND norm IN (SELECT norm FROM u)""")
def filter05_questions(t):
    """Sentences fit for a question: of fit length, naming two or more, giving no year, of one year only."""
    text = F.col("text")
    x = t.published.where("kind = 'event' and text is not null").select("row_id", "year", "text", F.size(G.words(text)).alias("words"), F.size(F.regexp_extract_all(text, F.lit(r"\p{Lu}\p{Ll}+"), F.lit(0))).alias("names"), F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")).alias("norm"))
    once = x.groupBy("norm").agg(F.count_distinct("year").alias("years")).where("years = 1").select("norm")
    good = F.col("words").between(8, 70) & (F.col("names") >= 2) & ~text.rlike(r"(^|[^\p{L}\p{N}])[0-9]{4}([^\p{L}\p{N}]|$)") & ~F.lower(text).rlike(r"(^|[^\p{L}\p{N}])(born|died|b\.|d\.)")
    return x.where(good).join(once, "norm", "left_semi").select("row_id", "words", "names")


@R.add("""
WITH h AS (SELECT term_id, state_link, office, person, qid, unnest(years) AS year, terms FROM stateleaders WHERE state_link IS NOT NULL AND office IS NOT NULL), d AS (SELECT DISTINCT * FROM h WHERE year IS NOT NULL),
n AS (SELECT state_link, office, year, count(DISTINCT term_id) AS holders FROM d GROUP BY 1, 2, 3)
SELECT term_id, year FROM d JOIN n USING (state_link, office, year) WHERE holders = 1 AND qid IS NOT NULL AND list_bool_or(list_transform(terms, lambda t: t[1] < year AND year < coalesce(t[2], 2026)))""")
def filter06_unambiguous(t):
    """Years in which a post has one holder, well inside that holder's term."""
    h = t.stateleaders.where("state_link is not null and office is not null").select("term_id", "state_link", "office", "qid", F.explode(F.array_distinct("years")).alias("year"), "terms").where("year is not null")
    n = h.groupBy("state_link", "office", "year").agg(F.count_distinct("term_id").alias("holders")).where("holders = 1")
    inside = F.exists("terms", lambda x: F.coalesce((F.get(x, 0) < F.col("year")) & (F.col("year") < F.coalesce(F.get(x, 1), F.lit(2026))), F.lit(False)))
    return h.where(F.col("qid").isNotNull() & inside).join(n, ["state_link", "office", "year"], "left_semi").select("term_id", "year")


_UNIT = r"km2|sqmi|mph|km/h|km|mi|ft|yd|cm|mm|kg|lb|oz|ha|acres?|kn|AU|m"
_SPELT = "foot|feet|metres|meters|miles|kilometres|kilometers|inches|yards|tonnes|tons|pounds"
_DATED = f"(?:(?:{_MONTHS}) [0-9]{{1,2}}|[0-9]{{1,2}} (?:{_MONTHS}))"
#: Reasons why a sentence is no statement, in order: name and what it looks like (fixed values), where a pattern says it.
SHAPES = (
    ("markup", r"\[\[|\{\{|\]\]|\}\}|__[A-Z]{3,}__"),
    ("opens on punctuation", "^[,;:.–—-]"),
    ("subject lost", rf"^{_DATED}\s*[–—-]?\s*[,;]"),
    ("bare number", r"^[0-9]{1,2}\s*[–—-]\s+[A-Z]"),
    ("raw link", r"\[https?://"),
    ("ends on a colon", r":\s*$"),
    ("unbalanced", None),
    ("two units", rf"\b[0-9][0-9,.]*\s*(?:{_SPELT}|{_UNIT})\s+(?:{_UNIT})(?:[^a-zA-Z0-9_]|$)"),
    ("editor's note", r"(?i)\b(?:clarification|citation|verification|dubious)\s+needed"),
    ("commented out", "<!--|-->"),
    ("two separators", r"^[^–—-]{0,30}[–—-]\s*[–—-]"),
    ("short", "^.{0,11}$"),
)
SQL_SHAPE = "CASE WHEN text IS NULL THEN 'missing' " + " ".join(f"WHEN length(text) - length(replace(text, '(', '')) <> length(text) - length(replace(text, ')', '')) THEN '{n}'" if p is None else f"WHEN regexp_matches(text, '{p}') THEN '{n.replace(chr(39), chr(39) * 2)}'" for n, p in SHAPES) + " ELSE 'good' END"


@R.add(f"SELECT row_id, {SQL_SHAPE} AS shape FROM published")
def filter07_shape(t):
    """The first of twelve reasons why a text is no statement."""
    x = F.col("text")
    n = lambda s: F.length(x) - F.length(F.replace(x, F.lit(s), F.lit("")))
    shape = F.when(x.isNull(), "missing")
    for name, pattern in SHAPES:
        shape = shape.when(n("(") != n(")") if pattern is None else x.rlike(pattern), name)
    return t.published.select("row_id", shape.otherwise("good").alias("shape"))


@R.add("""
WITH x AS (SELECT row_id, lower(left(text, 60)) AS head, lower(split_part(text, ',', 1)) AS clause, unnest(links) AS link FROM published WHERE text IS NOT NULL)
SELECT row_id, link, list_bool_or(list_transform(list_filter(string_split(lower(link), ' '), lambda w: length(w) > 2), lambda w: contains(head, w))) AS in_head, list_bool_and(list_transform(string_split(lower(link), ' '), lambda w: contains(clause, w))) AS whole FROM x""")
def filter10_subject_tests(t):
    """Whether each linked subject is what the sentence is about."""
    x = t.published.where("text is not null").select("row_id", F.lower(F.left("text", F.lit(60))).alias("head"), F.lower(F.split_part("text", F.lit(","), F.lit(1))).alias("clause"), F.explode("links").alias("link"))
    parts = F.split(F.lower("link"), " ")
    return x.select("row_id", "link", F.exists(F.filter(parts, lambda w: F.length(w) > 2), lambda w: F.contains("head", w)).alias("in_head"), F.forall(parts, lambda w: F.contains("clause", w)).alias("whole"))


