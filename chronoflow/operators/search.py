"""Inverted index and ranked search.

Posting lists are kept in shards of document numbers, so the list of a frequent token is spread over
many rows and no token is gathered whole. A search joins a few query terms (broadcast: their number
is bounded by the queries given) with the tokens, so only matching postings move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoflow.functions.text import STOP, norm

#: Documents per shard of a posting list.
SHARD = 1 << 16


def tokens_of(docs: DataFrame, doc: str, tokens) -> DataFrame:
    return docs.select(F.col(doc).alias("doc"), F.explode(tokens).alias("token"))


def postings(tokens: DataFrame, documents, share: int = 5) -> DataFrame:
    """token, bucket (first character), shard, docs in order: lists of the tokens in at most one of ``share`` documents.

    Tokens are met once: a token's frequency is the sum of its lists' lengths. A list holds the
    documents of one shard, so none is longer than a shard.
    """
    lists = tokens.groupBy("token", F.floor(F.col("doc") / SHARD).alias("shard")).agg(F.sort_array(F.collect_list("doc")).alias("docs"))
    df = F.sum(F.size("docs").cast("bigint")).over(Window.partitionBy("token"))
    return lists.withColumn("df", df).where(F.col("df") <= F.floor(documents / share)).select("token", F.left("token", F.lit(1)).alias("bucket"), "shard", "docs")


def write_index(docs: DataFrame, tokens: DataFrame, path: str, share: int = 5) -> None:
    """Store postings by bucket, documents (doc, year, text) by shard, and their number."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    postings(tokens, n, share).repartition("bucket", "token").write.partitionBy("bucket").parquet(f"{path}/postings")
    docs.withColumn("shard", F.floor(F.col("doc") / SHARD)).repartition("shard").write.partitionBy("shard").parquet(f"{path}/documents")
    docs.agg(F.count(F.lit(1)).alias("n"), F.lit(share).alias("share")).coalesce(1).write.parquet(f"{path}/about")


def stored_postings(spark: SparkSession, path: str) -> DataFrame:
    """Posting lists as ``write_index`` stores them, in folders by bucket."""
    return spark.read.schema("token string, shard bigint, docs array<bigint>, bucket string").parquet(f"{path}/postings")


def search_index(spark: SparkSession, path: str, queries: dict[str, str], limit: int, first: int | None = None, last: int | None = None) -> DataFrame:
    """``search`` over a stored index: of the postings only the buckets and tokens asked for are read."""
    about = spark.read.parquet(f"{path}/about").first()
    forms = sorted({r.form for r in query_terms(spark, queries).collect()})  # as many as the queries have words
    lists = stored_postings(spark, path).where(F.col("bucket").isin(sorted({f[0] for f in forms})) & F.col("token").isin(forms))
    met = lists.select("token", F.explode("docs").alias("doc"))
    docs = spark.read.schema("doc bigint, year int, text string, shard bigint").parquet(f"{path}/documents")
    return search(docs, met, queries, limit, first, last, share=about.share, documents=about.n)


def query_terms(spark: SparkSession, queries: dict[str, str]) -> DataFrame:
    """q, word, form: the forms of each word of each query."""
    import re

    rows = []
    for q, text in queries.items():
        n = 0
        for w in re.findall("[a-z0-9]+", text.lower()):
            if len(w) < (2 if re.search("[0-9]", w) else 3) or w in STOP:
                continue
            rows += [(q, n, w)] + ([(q, n, w[:-1])] if len(w) > 4 and w.endswith("s") and not w.endswith("ss") else [])
            n += 1
    return spark.createDataFrame(rows, "q string, word int, form string")


def search(docs: DataFrame, tokens: DataFrame, queries: dict[str, str], limit: int, first: int | None = None, last: int | None = None, share: int = 5, documents: int | None = None) -> DataFrame:
    """q, doc, score, place: the best ``limit`` documents (doc, year, text) for each query.

    A word counts with ln(documents / documents that hold one of its forms). Documents with all words
    that occur at all beat those with some. A document that holds the whole phrase gets 1000 and up to
    300 more the earlier it stands; one of the year that is the query gets 2000. Ties by year, then doc.
    """
    spark = docs.sparkSession
    n = docs.agg(F.count(F.lit(1))).scalar() if documents is None else F.lit(documents)
    terms = query_terms(spark, queries)
    # only the words asked for are looked at; those in more than a share of the documents separate nothing
    met = tokens.join(F.broadcast(terms.select(F.col("form").alias("token")).distinct()), "token")
    rare = met.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= F.floor(n / share))
    hits = met.join(F.broadcast(rare.select("token")), "token").join(F.broadcast(terms), F.col("token") == F.col("form")).select("q", "word", "doc").distinct()
    idf = hits.groupBy("q", "word").agg(F.log(n / F.count(F.lit(1))).alias("idf"))
    words = idf.groupBy("q").agg(F.count(F.lit(1)).alias("words"))
    score = hits.join(F.broadcast(idf), ["q", "word"]).groupBy("q", "doc").agg(F.sum("idf").alias("score"), F.count(F.lit(1)).alias("hits")).join(F.broadcast(words), "q")
    most = score.groupBy("q").agg((F.max("hits") == F.first("words")).alias("whole"))
    score = score.join(F.broadcast(most), "q").where(~F.col("whole") | (F.col("hits") == F.col("words")))
    found = score.join(docs.select("doc", "year", "text"), "doc")
    if first is not None:
        found = found.where(F.col("year") >= first)
    if last is not None:
        found = found.where(F.col("year") <= last)
    texts = spark.createDataFrame([(q, t, int(t) if t.strip().lstrip("-").isdigit() and len(t.strip().lstrip("-")) <= 4 else None) for q, t in queries.items()], "q string, phrase string, as_year int")
    found = found.join(F.broadcast(texts.withColumn("phrase", norm(F.col("phrase")))), "q").withColumn("flat", norm(F.col("text")))
    at = F.expr("locate(phrase, flat)")
    bonus = F.when((at > 0) & (F.col("phrase") != ""), 1000 + 300 * (1 - (at - 1) / F.greatest(F.length("flat"), F.lit(1)))).otherwise(0.0)
    year = F.when(F.col("year") == F.col("as_year"), 2000.0).otherwise(0.0)
    found = found.select("q", "doc", "year", F.round(F.col("score") + bonus + year, 6).alias("score"))
    w = Window.partitionBy("q").orderBy(F.desc("score"), "year", "doc")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit).drop("year")


def rank_subjects(subjects: DataFrame, queries: dict[str, str], keep: int = 6) -> DataFrame:
    """q, slug, score, place: subjects whose label or description meets the query's words."""
    spark = subjects.sparkSession
    q = spark.createDataFrame(list(queries.items()), "q string, text string").select("q", norm(F.col("text")).alias("phrase")).where("phrase <> ''")
    q = q.withColumn("parts", F.filter(F.split("phrase", " "), lambda t: F.length(t) > 1))
    s = subjects.select("slug", "entries", norm(F.col("label")).alias("label"), norm(F.col("description")).alias("description"))
    # candidates share the beginning of a word with the query: an equi-join on two letters keeps it from being a cross join
    start = lambda words: F.array_distinct(F.transform(words, lambda w: F.left(w, F.lit(2))))
    keys = s.withColumn("key", F.explode(start(F.split(F.concat_ws(" ", "label", "description"), " "))))
    pairs = keys.join(F.broadcast(q.withColumn("key", F.explode(start(F.split("phrase", " "))))), "key").drop("key").dropDuplicates(["q", "slug"])
    label = F.when(F.col("label") == F.col("phrase"), 1000).when(F.startswith("label", "phrase"), 500).when(F.contains("label", "phrase"), 250).otherwise(0)
    loose = lambda t: (F.length(t) >= 4) & ~t.rlike("^[0-9]+$")
    begins = lambda text, t: F.exists(F.split(F.col(text), " "), lambda w: F.startswith(w, t))
    of = lambda t: F.when(F.array_contains(F.split("label", " "), t), 60).when(loose(t) & begins("label", t), 25).otherwise(0) + F.when(loose(t) & begins("description", t), 8).otherwise(0)
    points = label + F.aggregate("parts", F.lit(0), lambda acc, t: acc + of(t))
    scored = pairs.withColumn("points", points).where("points > 0").select("q", "slug", F.round(F.col("points") + F.least("entries", F.lit(400)) / 100, 4).alias("score"))
    best = F.max("score").over(Window.partitionBy("q"))
    kept = scored.withColumn("best", best).where(F.col("score") >= F.greatest(F.col("best") * 0.45, F.lit(20)))
    return kept.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "slug"))).where(F.col("place") <= keep).drop("best")
