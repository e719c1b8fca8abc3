"""Near-duplicate records by bottom-k sketches from one hash function.

A text is the set of its distinct words; similarity is Jaccard. Every word has one sort value: the
size class of its hash bucket (counted over the whole corpus, so common words sort last) followed by
its hash. A text's sketch holds the ``SKETCH`` lowest values.

*Inverted lists of retained values generate overlaps.* Two texts of similarity t or more share at
least ceil(t n) words, so at most n - ceil(t n) of the lowest values of either can be missing in the
other: among the n - ceil(t n) + 2 lowest of each at least two are common. Lists are therefore kept per
pair of retained values, which keeps them short where single names recur all over the corpus. Texts of
more than ``LONG`` words, whose pairs would be too many, are listed by single values of that prefix (one
less); those just below are listed both ways, so that no link across the border is lost. Within a list
texts are held against each other by size, day and the occupancy of 64 cells by the same hash.

*Union-sketch estimation filters.* The sketches of a candidate pair are merged; among the lowest
values of the union those that only one text has are counted. Two texts of similarity t can't differ
in more than (1 - t) / (1 + t) of their words together, so a merged sketch that differs in more is
dismissed, and no true pair is. Up to ``SKETCH`` words in the union, the estimate is the similarity.

*Exact Jaccard verifies* what is left on the texts' words.

Exact copies (same words, same day) are one node: they are told by a 128-bit digest of their sorted
words and meet in an aggregation, never in a list. Lists and sets of copies beyond ``HOT`` rows are
split into blocks; every two blocks meet in a task of their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoflow.plans.staging import Stage

#: Cells into which words are counted to rank them by frequency: the counts are the one thing the driver gathers.
CELLS = 1 << 16
#: Values a sketch holds.
SKETCH = 32
#: Rows of one list or one set of copies that meet in one task, and bytes of list rows per task.
HOT, TASK_BYTES = 2_000, 8_000_000
#: Distinct words up to which inverted lists are keyed by two retained values.
LONG = 64
#: Rows of duplicate groups or candidate ids up to which they are broadcast; beyond, joins shuffle.
MAX_BROADCAST = 200_000
#: The months' names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def words(text: Column) -> Column:
    """Distinct words: maximal runs of Unicode letters and numbers, lower-cased. Null gives none."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.lower))


def month_day(date: Column) -> Column:
    """Month and day a loosely written date names, as 32 * month + day; a span counts by its first day.

    Null where no day is named.
    """
    low = F.lower(F.coalesce(date, F.lit("")))
    month = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
    after = rf"\b{month}\s+(\d{{1,2}})(?!\d)"
    before = rf"(?<!\d)(\d{{1,2}})(?:st|nd|rd|th)?(?:\s*[-–—/]\s*\d{{1,2}}(?:st|nd|rd|th)?)?(?:\s+of)?\s+{month}"
    iso = r"(?<!\d)\d{4}-(\d\d)-(\d\d)(?!\d)"
    number = F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(m[:3]), F.lit(i + 1))])

    def found(pattern: str, m: int, d: int, named: bool = True) -> Column:
        mm, dd = F.regexp_extract(low, pattern, m), F.regexp_extract(low, pattern, d).try_cast("int")
        return F.when(mm != "", F.struct((F.try_element_at(number, mm) if named else mm.try_cast("int")).alias("m"), dd.alias("d")))

    # "3 may - 5 june" names its first day before the month, "may 3 - june 5" after it
    hit = F.coalesce(found(before, 2, 1), found(after, 1, 2), found(iso, 1, 2, False))
    return F.when(hit.m.between(1, 12) & hit.d.between(1, 31), hit.m * 32 + hit.d)


def _blocks(df: DataFrame, keys: list[str], id: str, blocks: Column) -> DataFrame:
    """Rows dealt out so that any two of a key meet exactly once if joined on keys, ``lo``, ``hi`` and ``_meets``.

    A key of B blocks has B (B + 1) / 2 places (lo, hi); a row of block b goes to the B places that hold b.
    """
    b = F.pmod(F.xxhash64(id), F.col("blocks")).cast("int")
    dealt = df.withColumn("blocks", blocks).withColumn("block", b).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    return dealt.select("*", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).drop("other", "blocks")


#: Rows of one block meet at its own place only.
_MEETS = "a.lo = b.lo and a.hi = b.hi and (a.block <> b.block or a.lo = a.hi)"


@dataclass
class NearDuplicates:
    """``links`` (a, b): similar nodes; ``copies`` (id, node, c): rows of nodes with more than one row, the node's own too, and their number."""

    links: DataFrame
    copies: DataFrame
    base: DataFrame
    stage: Stage

    def members(self) -> DataFrame:
        """One row per row with words: id, node (the least id of its exact copies). With ``links`` this says all that pairs() does, in linear space."""
        return self.base.select("id").join(self.copies.select("id", "node"), "id", "left").select("id", F.coalesce("node", "id").alias("node"))

    def pairs(self) -> DataFrame:
        """Every similar pair of rows (a < b), copies expanded."""
        of = lambda side: self.copies.select(F.col("node").alias(side), F.col("id").alias(f"{side}_id"))
        both = self.links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_id", "a").alias("x"), F.coalesce("b_id", "b").alias("y"))
        dealt = _blocks(self.copies, ["node"], "id", F.ceil(F.col("c") / HOT))
        same = dealt.alias("a").join(dealt.alias("b"), F.expr(f"a.node = b.node and a.id < b.id and {_MEETS}")).select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
        return both.unionByName(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    def groups(self) -> DataFrame:
        """One row per row with words: id, group (least id of its connected texts), links (of its node to other texts)."""
        edges = self.links.unionByName(self.copies.where("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b")))
        label = components(edges, self.stage)
        degree = self.links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
        return (
            self.members().join(label, "id", "left").join(degree, "node", "left").select("id", F.coalesce("group", "id").alias("group"), F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))
        )


def _order(word_hash: Column, counts: str) -> Column:
    """A word's sort value: 23 bits of its cell's count, 40 of its hash."""
    count = F.element_at(F.from_json(F.lit(counts), "array<int>"), (word_hash.bitwiseAND(F.lit(CELLS - 1)) + 1).cast("int"))
    return F.shiftleft(count.cast("bigint"), 40).bitwiseOR(F.shiftrightunsigned(word_hash, 24))


def _prefix(threshold: float) -> Column:
    """Of n words the number of lowest values among which two similar texts share two."""
    return F.least(F.col("n"), F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 2)


def near_duplicates(df: DataFrame, key: str, text: str, date: str | None = None, threshold: float = 0.8) -> NearDuplicates:
    """Similar rows: Jaccard of distinct words >= ``threshold`` and, if ``date`` is given, no conflicting days.

    ``key`` must be a unique integer; rows with a null key, and texts that are null or without words,
    pair with nothing. Other columns are not read, whatever their names. An empty table gives empty
    results.
    """
    spark = df.sparkSession
    stage = Stage(spark, "neardup")
    day = month_day(F.col(f"`{date}`")) if date else F.lit(None).cast("int")
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"), F.coalesce(day, F.lit(0)).alias("day")).where("id is not null and text is not null")
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    cells = rows.select(F.explode(hashes).alias("h")).groupBy(F.col("h").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).count()
    filled = {r.cell: min(r["count"], (1 << 23) - 1) for r in cells.toLocalIterator()}
    counts = "[" + ",".join(str(filled.get(i, 0)) for i in range(CELLS)) + "]"

    distinct = words(F.col("text"))
    base = rows.select("id", "day", distinct.alias("w")).where("size(w) > 0")
    base = base.select("id", "day", F.sort_array(F.transform("w", lambda w: _order(F.xxhash64(w), counts))).alias("v"), F.unhex(F.md5(F.array_join(F.sort_array("w"), " "))).alias("digest")).withColumn("n", F.size("v"))
    base = base.select(
        "id",
        "day",
        "n",
        F.slice("v", F.lit(1), F.greatest(_prefix(threshold), F.lit(SKETCH))).alias("sketch"),
        F.aggregate("v", F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), x.bitwiseAND(F.lit(63)).cast("int")))).alias("cells"),
        "digest",
    )
    base = stage.write(base, "base")

    # exact copies: groups with more than one row
    own = ["digest", "day"]
    several = stage.write(base.groupBy(*own).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("c")).where("c > 1"), "several")
    small = several.count() <= MAX_BROADCAST
    few = lambda x: F.broadcast(x) if small else x
    copies = stage.write(base.select("id", *own).join(few(several), own).select("id", "node", "c"), "copies")
    nodes = base.join(few(several.drop("c")), own, "left").where("node is null or node = id").select("id", F.slice("sketch", F.lit(1), _prefix(threshold)).alias("low"), "cells", F.col("n") * 512 + F.col("day"), "n").toDF("id", "low", "cells", "nd", "n")

    # inverted lists
    single = F.col("low")
    last = F.size("low") - 1
    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))),
            lambda i: F.transform(F.slice(F.col("low"), i + 2, F.size("low")), lambda y: F.xxhash64(F.get(F.col("low"), i), y)),
        )
    )
    short = F.col("n") <= LONG
    border = F.col("n") > int(LONG * threshold) - 1
    none = F.array().cast("array<bigint>")
    keys = F.concat(
        F.when(short & (F.col("n") > 1), pairs).otherwise(none),
        # one value less than ``low`` holds is enough for a single common value
        F.when(border | (F.col("n") == 1), F.slice(single, F.lit(1), F.greatest(F.size("low") - 1, F.lit(1)))).otherwise(none),
    )
    lists = nodes.select(F.explode(keys).alias("key"), "id", "cells", "nd")
    # lists that many texts are on: their cells hold far more rows than others do
    per_cell = lists.groupBy(F.col("key").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.count(F.lit(1)).alias("rows"))
    sizes = per_cell.agg(F.sum("rows"), F.avg("rows")).first()
    total, usual = sizes[0] or 0, sizes[1] or 0.0
    # at most one row per cell
    hot = {r.cell: math.ceil((r.rows - usual) / HOT) for r in per_cell.where(F.col("rows") > 2 * usual + HOT).collect()}
    meets = "a.key = b.key"
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total * 32 / TASK_BYTES))
    if hot:
        table = F.broadcast(spark.createDataFrame(list(hot.items()), "cell bigint, blocks int"))
        marked = lists.withColumn("cell", F.col("key").bitwiseAND(F.lit(CELLS - 1))).join(table, "cell", "left").drop("cell")
        lists = _blocks(marked, ["key"], "id", F.coalesce("blocks", F.lit(1)))
        meets += f" and {_MEETS}"
        lists = lists.repartition(parts, "key", "lo", "hi")
    else:
        lists = lists.repartition(parts, "key")
    na, nb, da, db = "(a.nd div 512)", "(b.nd div 512)", "(a.nd % 512)", "(b.nd % 512)"
    t = repr(threshold)
    found = (
        lists.alias("a")
        .join(
            lists.alias("b"),
            F.expr(
                f"{meets} and a.id < b.id and ({da} = 0 or {db} = 0 or {da} = {db}) and least({na}, {nb}) >= {t} * greatest({na}, {nb}) - 1e-9 "
                f"and bit_count(a.cells ^ b.cells) <= {na} + {nb} - 2 * ceil(({na} + {nb}) * {t} / (1 + {t}) - 1e-9)"
            ),
        )
        .select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
        .distinct()
    )
    found = stage.write(found, "candidates")

    def of(pairs: DataFrame, table: DataFrame, tag: str) -> DataFrame:
        """Rows of ``table`` that the pairs name."""
        ids = stage.write(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), tag)
        return table.join(F.broadcast(ids) if ids.count() <= MAX_BROADCAST else ids, "id", "left_semi")

    def beside(pairs: DataFrame, table: DataFrame) -> DataFrame:
        """Columns of both sides, as x and y."""
        one, two = (table.select(F.col("id").alias(i), F.struct(*(c for c in table.columns if c != "id")).alias(x)) for i, x in (("a", "x"), ("b", "y")))
        return pairs.join(one, "a").join(two, "b")

    # merged sketches
    both = beside(found, of(found, base.select("id", "n", F.slice("sketch", 1, SKETCH).alias("s")), "ids"))
    merged = F.slice(F.sort_array(F.array_union("x.s", "y.s")), 1, SKETCH)
    differ = F.size(merged) - F.size(F.array_intersect(merged, F.array_intersect("x.s", "y.s")))
    likely = stage.write(both.where(differ <= (F.col("x.n") + F.col("y.n")) * ((1 - threshold) / (1 + threshold)) + 1e-9).select("a", "b"), "likely")

    # exact check on the texts
    both = beside(likely, of(likely, rows.select("id", "text"), "likely-ids").select("id", words(F.col("text")).alias("w")))
    common = F.size(F.array_intersect("x.w", "y.w"))
    links = stage.write(both.where(common >= F.lit(threshold) * (F.size("x.w") + F.size("y.w") - common) - 1e-9).select("a", "b"), "links")
    stage.drop(several, found, likely)
    return NearDuplicates(links, copies, base, stage)


def components(edges: DataFrame, stage: Stage, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: id, group (its least id), by alternating large and small stars.

    Each round is written to the shared folder. A hub's neighbours are never gathered: both stars are
    an aggregation (least neighbour) and a join on it. Ends when a round changes no edge.
    """
    e = stage.write(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: every neighbour above u is tied to u's least neighbour or u itself
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage.write(large, "large")
        # small star: all lower neighbours of u and u itself are tied to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = stage.write(small, "small")
        now = e.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == tuple(before):
            break
        before = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct())
