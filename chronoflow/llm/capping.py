"""Capping the records of dominant contributors with an incremental state table.

State per contributor: the kept records and, once it is full, its cutoff (the worst kept record). A
new batch is filtered against the cutoffs, what passes is merged with the kept records, and the
merged list is trimmed to the cap. Every record that is filtered or trimmed away is logged.

Trimming never brings a contributor into one task. The merged records of over-full contributors are
range-partitioned by (contributor, score desc, id), so a hot contributor spreads over many
partitions; counts per partition and contributor (a small table) tell in which partition each
cutoff lies, and only that partition's rows are ranked.

A state can live in a folder: ``CappedState.open`` starts one or takes up the last version that was
written whole, and every batch absorbed is a new version (kept records, cutoffs, what the batch
displaced), marked as done last, so a run that dies halfway leaves the version before it.

The cutoffs are broadcast: only contributors with at least ``cap`` kept records have one, so there
are at most (records / cap) of them; beyond ``MAX_BROADCAST`` they are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoflow.plans.staging import Stage

#: Cutoff rows up to which they are broadcast.
MAX_BROADCAST = 10_000


def _after(s: Column, t: Column, cut_s: Column, cut_t: Column) -> Column:
    """(s desc, t asc) comes after the cutoff."""
    return (s < cut_s) | ((s == cut_s) & (t > cut_t))


class CappedState:
    """Kept records of every contributor, at most ``cap`` each, best first by (score desc, id asc).

    A null or NaN score ranks below all others and equal to each other. Records without a
    contributor take no part. Copies of a record count once each.
    """

    def __init__(self, stage: Stage, cap: int):
        self.stage, self.cap, self.kept, self.cuts, self.logged = stage, cap, None, None, []
        self.folder, self.version, self.n_cuts = None, 0, 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str, cap: int) -> CappedState:
        """The state in ``folder`` (shared by all executors), or a new one there. An existing one must have the same cap."""
        state = cls(Stage(spark, "capping"), cap)
        state.folder = folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(state.folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        done = [int(n[1:]) for n in found if n[0] == "v" and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{state.folder}/{n}/done/_SUCCESS"))]
        if done:
            state.version = max(done)
            about = spark.read.parquet(state._path("done")).first()
            if about.cap != cap:
                raise ValueError(f"the state in {folder} has a cap of {about.cap}, not {cap}")
            state.n_cuts = about.cuts
            state.kept = spark.read.parquet(state._path("kept"))
            state.cuts = spark.read.parquet(state._path("cuts")) if about.cuts else None
            state.logged = [spark.read.parquet(state._path("log", v)) for v in sorted(done)]
        return state

    def _path(self, what: str, version: int | None = None) -> str:
        return f"{self.folder}/v{version or self.version:06d}/{what}"

    def _save(self, before: int) -> None:
        """Write what a batch changed as the next version; the mark comes last."""
        spark = self.stage.spark
        self.version += 1
        log = self.kept.where(F.lit(False)).select("c", "t")
        for part in self.logged[before:]:
            log = log.unionByName(part)
        tables = {"kept": self.kept, "log": log, **({"cuts": self.cuts} if self.cuts is not None else {})}
        for name, table in tables.items():
            table.write.mode("overwrite").option("compression", "zstd").parquet(self._path(name))
        spark.createDataFrame([(self.cap, self.n_cuts)], "cap bigint, cuts bigint").coalesce(1).write.mode("overwrite").parquet(self._path("done"))
        self.kept, self.logged = spark.read.parquet(self._path("kept")), [*self.logged[:before], spark.read.parquet(self._path("log"))]
        if self.cuts is not None:
            self.cuts = spark.read.parquet(self._path("cuts"))
        self.stage.clear()

    def absorb(self, batch: DataFrame) -> None:
        """Merge a batch with columns c (contributor), s (score), t (id). A null score ranks as minus infinity."""
        before = len(self.logged)
        self._absorb(batch)
        if self.folder:
            self._save(before)

    def _absorb(self, batch: DataFrame) -> None:
        stage, cap = self.stage, self.cap
        if self.cuts is not None:
            cuts = self.cuts if self.n_cuts > MAX_BROADCAST else F.broadcast(self.cuts)
            marked = batch.join(cuts, "c", "left").withColumn("out", F.col("cut_t").isNotNull() & _after(F.col("s"), F.col("t"), F.col("cut_s"), F.col("cut_t")))
            batch = stage.write(marked.select("c", "s", "t", F.coalesce("out", F.lit(False)).alias("out")), "batch", ["out"])
            self.logged.append(batch.where("out").select("c", "t"))
            batch = batch.where("not out").select("c", "s", "t")
        merged = batch if self.kept is None else self.kept.unionByName(batch)
        counts = merged.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
        full = stage.write(counts.where(F.col("n") >= cap), "full")
        n_full = full.count()
        full_b = full if n_full > MAX_BROADCAST else F.broadcast(full)
        over = merged.join(full_b.select("c"), "c", "left_semi")
        rest = merged.join(full_b.select("c"), "c", "left_anti")
        if not n_full:
            self.kept = stage.write(rest, "kept")
            return
        ranged = over.repartitionByRange("c", F.desc("s"), "t").withColumn("part", F.spark_partition_id())
        ranged = stage.write(ranged, "ranged")
        per_part = ranged.groupBy("c", "part").agg(F.count(F.lit(1)).alias("m"))
        before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        per_part = per_part.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
        at_cut = per_part.where((F.col("before") < cap) & (F.col("before") + F.col("m") >= cap)).select("c", "part", (F.lit(cap) - F.col("before")).alias("need"))
        at_cut_b = at_cut if n_full > MAX_BROADCAST else F.broadcast(at_cut)
        ranks = Window.partitionBy("c").orderBy(F.desc("s"), "t")
        border = ranged.join(at_cut_b, ["c", "part"]).withColumn("rn", F.row_number().over(ranks))
        self.cuts = stage.write(border.where(F.col("rn") == F.col("need")).select("c", F.col("s").alias("cut_s"), F.col("t").alias("cut_t")), "cuts")
        self.n_cuts = n_full
        border = stage.write(border.select("c", "s", "t", (F.col("rn") > F.col("need")).alias("out")), "border")
        sides = at_cut_b.select("c", F.col("part").alias("cut_part"))
        clear = ranged.join(sides, "c").where("part <> cut_part").select("c", "s", "t", (F.col("part") > F.col("cut_part")).alias("out"))
        trimmed = stage.write(clear.unionByName(border), "trimmed", ["out"])
        self.logged.append(trimmed.where("out").select("c", "t"))
        self.kept = stage.write(rest.unionByName(trimmed.where("not out").select("c", "s", "t")), "kept")

    def displaced(self) -> DataFrame:
        """Log of all records left out so far: c, t. Empty if every contributor is within the cap."""
        log = self.kept.where(F.lit(False)).select("c", "t")
        for part in self.logged:
            log = log.unionByName(part)
        return log


def records(df: DataFrame, contributor: Column, score: str, tie: str, arrival: str | None = None) -> DataFrame:
    """c, s, t, a: records as a state absorbs them; null and NaN scores become minus infinity, records without contributor are left out."""
    s = F.col(f"`{score}`").cast("double")
    return df.select(
        contributor.alias("c"),
        F.when(s.isNull() | F.isnan(s), F.lit(float("-inf"))).otherwise(s).alias("s"),
        F.col(f"`{tie}`").alias("t"),
        (F.unix_timestamp(F.col(f"`{arrival}`")).cast("double") if arrival else F.lit(None).cast("double")).alias("a"),
    ).where(F.col("c").isNotNull())


def cap_contributors(df: DataFrame, contributor: Column, score: str, tie: str, cap: int, arrival: str | None = None, batches: int = 3) -> CappedState:
    """Feed ``df`` batch by batch (in order of ``arrival``, nulls last) into a state with ``cap``.

    A null contributor is no contributor. ``cap`` 0 leaves every record out. An empty table gives an
    empty state. Columns other than those named are not read.
    """
    stage = Stage(df.sparkSession, "capping")
    rows = records(df, contributor, score, tie, arrival)
    state = CappedState(stage, cap)
    if cap <= 0:
        state.kept = rows.where(F.lit(False)).select("c", "s", "t")
        state.logged = [rows.select("c", "t")]
        return state
    edges = rows.select(F.percentile_approx("a", [i / batches for i in range(1, batches)], 200)).first()[0] if arrival and batches > 1 else None
    edges = sorted({*(edges or ())})
    number = F.lit(0)
    for e in edges:
        number = number + F.coalesce((F.col("a") > F.lit(e)).cast("int"), F.lit(1))
    rows = rows.select("c", "s", "t", number.alias("batch"))
    for b in range(len(edges) + 1):
        state.absorb(rows.where(F.col("batch") == b).drop("batch"))
    return state
