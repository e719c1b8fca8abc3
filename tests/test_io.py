"""Sources, sinks, streams and the entry module."""

import datetime
import importlib
import os
import re
import sys

import pytest
from pyspark.sql import functions as F

from chronoflow.sources import batched, files
from chronoflow.streaming import limits

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_resolve():
    store = {"a": ("b", None), "b": (None, "1"), "c": ("d", None), "d": ("e", None), "e": ("f", None), "f": ("g", None), "g": (None, "2")}
    calls = []

    def fetch(keys):
        calls.append(keys)
        if len(calls) == 1:
            raise batched.Transient
        return {k: store[k] for k in keys if k in store}

    got = batched.resolve(["a", "b", "c", "zz"], fetch)
    assert got["a"] == ("b", "1", 1) and got["b"] == ("b", "1", 0) and got["zz"] == ("zz", None, 0) and got["c"][1] is None

    def broken(keys):
        raise batched.Transient

    with pytest.raises(batched.Transient):
        batched.again(lambda: broken([]), tries=2, pause=0)


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1900, "a"), (-5, "b"), (1900, "c")], "year int, t string")
    files.write_json_per_key(df, f"{tmp_path}/j", "year")
    assert sorted((r.key, r.t) for r in files.json_per_key(spark, f"{tmp_path}/j", "t string").collect()) == [(-5, "b"), (1900, "a"), (1900, "c")]
    (tmp_path / "s.csv").write_text("period,value\n2001-01,1.5\n2001-02,.\n2001-03,\n")
    assert [tuple(r) for r in files.csv_series(spark, f"{tmp_path}/s.csv").collect()] == [("2001-01", 1.5)]
    log = spark.createDataFrame([(1, 1, True), (1, 2, False), (2, 1, False), (2, 2, False)], "k int, n int, ok boolean")
    assert sorted((r.k, r.n) for r in files.latest_ok(log, "k", "n", "ok").collect()) == [(1, 1), (2, 2)]


def test_limits(spark):
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    rows = spark.createDataFrame([(at(m), u) for u, ms in (("a", (0, 0, 1, 1, 1)), ("b", (5,))) for m in ms], "ts timestamp, u string")
    got = {(r.start.minute, r.u): (r.n, r.over) for r in limits.counted(rows, "ts", "u", "1 minute", "3 minutes", 2).collect()}
    assert got == {(0, "a"): (2, False), (1, "a"): (3, True), (5, "b"): (1, False)}


def test_entry_without_llm(monkeypatch):
    sys.path.insert(0, ROOT)
    entry = importlib.import_module("__spark_entry__")
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and "p7_found" in names
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "chronoflow.llm" else find(name, *a))
    core = entry.queries()
    assert "p7_found" in core and not any(n.startswith("p1_") for n in core)


def test_nothing_in_core_imports_llm():
    for folder, _, names in [*os.walk(os.path.join(ROOT, "chronoflow")), *os.walk(os.path.join(ROOT, "tests"))]:
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                assert not re.search(r"(?m)^\s*(from|import) chronoflow\.llm", open(os.path.join(folder, name)).read()), name


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables aren't here")
def test_queries_equal_sql(spark):
    """Some queries of every module against DuckDB on the smallest tables."""
    import glob
    import math

    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    entry = importlib.import_module("__spark_entry__")

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.6g}"
        return repr(v)

    names = ["p7_found", "a05_calendar_days", "a10_entity_rollup", "w04_islands", "w07_shard_spans", "j06_interval", "j09_as_of_backward", "t08_even_spread", "d02_twin_fold", "q02_search", "f15_julian", "g01_verdicts", "c02_leader_claims", "v04_integrity", "x15_bullet_trees", "z01_rate_limit"]
    for name in names:
        df = entry.queries()[name](spark, folder)
        columns = sorted(df.columns)
        mine = sorted([plain(r[c]) for c in columns] for r in df.collect())
        found = con.execute(entry.oracle_sql()[name])
        given = [d[0] for d in found.description]
        theirs = sorted([plain(r[given.index(c)]) for c in columns] for r in found.fetchall())
        assert mine == theirs, name


def test_dense_ids(spark):
    from chronoflow.queries.ordered import dense_ids

    rows = spark.range(100).select((F.col("id") * 7 % 100).alias("x"))
    got = sorted((r.x, r.docid) for r in dense_ids(rows, ["x"]).collect())
    assert got == [(i, i) for i in range(100)]


def test_staging_refuses_a_cluster_without_a_folder(spark, tmp_path):
    from types import SimpleNamespace

    from chronoflow.plans import staging

    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda *a: None)))
    with pytest.raises(RuntimeError):
        staging.shared_dir(unset)
    unset.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        staging.shared_dir(unset)
    stage = staging.Stage(spark, "drops")
    a, b = stage.write(spark.range(3), "a"), stage.write(spark.range(4), "b")
    folder = stage.root.removeprefix("file://")
    assert b.count() == 4 and len(os.listdir(folder)) == 2
    stage.drop(a)
    assert b.count() == 4 and len(os.listdir(folder)) == 1
    stage.clear()
    assert not os.path.exists(folder)


def test_pages(spark, tmp_path):
    """Pages of several files; a store that says more than it gives is an error."""
    spark.dataSource.register(batched.Paged)
    for name, n in (("a", 7), ("b", 4)):
        spark.range(n).select(F.concat(F.lit(name), F.col("id").cast("string")).alias("k")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    pages = spark.read.format("paged").option("path", f"{tmp_path}/t").option("limit", "3").load()
    rows = batched.counted(pages).collect()
    assert len(rows) == 11 and len({r.page for r in rows}) == 5 and {r.of for r in rows} == {11}
    with pytest.raises(Exception, match="11 rows of 12"):
        batched.counted(pages.withColumn("of", F.lit(12))).collect()
    spark.range(0).select(F.lit("x").alias("k")).write.parquet(f"{tmp_path}/none")
    assert batched.counted(spark.read.format("paged").option("path", f"{tmp_path}/none").load()).count() == 0
