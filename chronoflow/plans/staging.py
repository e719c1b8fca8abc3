"""Cutting lineage with tables in the cluster's shared folder.

Iterative operators write their state as Parquet under the folder the session names in
``spark.checkpoint.dir`` and read it back, so a lost executor costs a re-read and never a
recomputation of the whole loop. A session on one machine (master ``local``) without that setting gets
a temporary folder; on a cluster that would be a folder of each machine's own, so it is refused.

Tables that no later step reads are dropped by the operators; those behind a result are on a list and
deleted when the driver ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share; a local temporary one for a local session that names none."""
    named = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{_KEY} must name a folder that all executors of {master} share")
    own = tempfile.mkdtemp(prefix="chronoflow-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set(_KEY, f"file://{own}")
    return f"file://{own}"


class Stage:
    """Written tables of one operator run. ``drop`` removes those no later step reads, ``clear`` all."""

    _roots: dict[str, SparkSession] = {}

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._paths: list[tuple[DataFrame, str]] = []

    def path(self, tag: str) -> str:
        self._n += 1
        Stage._roots[self.root] = self.spark
        return f"{self.root}/{self._n:03d}-{tag}"

    def write(self, df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` and read it back with its schema: the lineage ends here."""
        path = self.write_path(df, tag, partition_by)
        back = self.read(path, df.schema)
        self._paths.append((back, path))
        return back

    def write_path(self, df: DataFrame, tag: str, partition_by: list[str] | None = None) -> str:
        path = self.path(tag)
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path

    def read(self, path: str, schema=None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(path)

    def drop(self, *tables: DataFrame | str | None) -> None:
        """Delete tables (as ``write`` returned them, or paths) that no DataFrame still to be run reads."""
        for t in tables:
            path = t if isinstance(t, str) else next((p for d, p in self._paths if d is t), None)
            if path is not None:
                _delete(self.spark, path)
                self._paths = [(d, p) for d, p in self._paths if p != path]

    def clear(self) -> None:
        """Delete all that this run wrote: its results can't be read afterwards."""
        _delete(self.spark, self.root)
        self._paths = []
        Stage._roots.pop(self.root, None)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _end() -> None:
    for root, spark in list(Stage._roots.items()):
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, root)
        except Exception:  # the session is gone: a file system of this machine can still be reached
            if root.startswith("file://"):
                shutil.rmtree(root[7:], ignore_errors=True)
