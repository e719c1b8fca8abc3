"""Keyed lookups in batches from a remote store, as a Spark data source.

``spark.read.format("batched_lookup")`` with options ``path`` (a folder of Parquet snapshots with
columns key, target, value), ``keys`` (a Parquet folder with column key, each key once) and ``batch``
asks for that many keys a request; every file of keys is a task of its own. A request follows redirects (rows whose
``target`` is set) up to three hops, and a transient failure is tried again with a growing pause.
Offline the store is the snapshot; a live store replaces ``fetch``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HOPS, TRIES = 3, 4


class Transient(Exception):
    """A failure worth another try."""


def again(call: Callable, tries: int = TRIES, pause: float = 0.05):
    """``call`` until it succeeds or has failed ``tries`` times, the pause doubling each time."""
    for attempt in range(tries):
        try:
            return call()
        except Transient:
            if attempt + 1 == tries:
                raise
            time.sleep(pause * 2**attempt)


def resolve(keys: list[str], fetch: Callable[[list[str]], dict[str, tuple[str | None, str | None]]]) -> dict[str, tuple[str, str | None, int]]:
    """key: (name it leads to, value, hops). Missing keys and chains that are too long have no value."""
    at, found, hops = {k: k for k in keys}, {}, 0
    while at and hops <= HOPS:
        rows = again(lambda: fetch(sorted(set(at.values()))))
        onward = {}
        for key, name in at.items():
            target, value = rows.get(name, (None, None))
            if target and hops < HOPS:
                onward[key] = target
            else:
                found[key] = (name, None if target else value, hops)
        at, hops = onward, hops + 1
    return found


class BatchedLookup(DataSource):
    @classmethod
    def name(cls) -> str:
        return "batched_lookup"

    def schema(self) -> str:
        return "key string, resolved string, value string, hops int"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(0)
        self.path = path


class Paged(DataSource):
    """``spark.read.format("paged")`` with options ``path`` (a Parquet table) and ``limit``: a task per page of that many rows.

    Every row has the page it came with and the count that the store gave for all, so that what was
    read can be held against it (``counted``). Offline the store is a snapshot, its order that of the file.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, of bigint, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Pages(self.options)


class _Page(InputPartition):
    def __init__(self, file: str, page: int, first: int, size: int, of: int):
        super().__init__(page)
        self.file, self.page, self.first, self.size, self.of = file, page, first, size, of


class _Pages(DataSourceReader):
    def __init__(self, options):
        self.path, self.limit = options["path"], int(options.get("limit", "100"))

    def partitions(self) -> list[InputPartition]:
        root = self.path.split("://")[0] + "://" if "://" in self.path else ""
        files = [(root + f.path, f.count_rows()) for f in _opened(self.path).get_fragments()]  # from the footers
        total, out = sum(n for _, n in files), []
        for file, n in files:
            for first in range(0, n, self.limit):
                out.append(_Page(file, len(out), first, min(self.limit, n - first), total))
        return out or [_Page("", 0, 0, 0, 0)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        import json

        if partition.size:
            rows = again(lambda: _opened(partition.file).to_table().slice(partition.first, partition.size).to_pylist())
            for row in rows:
                yield partition.page, partition.of, json.dumps(row, ensure_ascii=False, default=str)


def counted(pages, expected: str = "of"):
    """The rows, or an error if they are not as many as the store said there are."""
    from pyspark.sql import functions as F

    n, of = pages.count(), pages.agg(F.max(expected)).scalar()
    return pages.where(F.when(F.lit(n) == F.coalesce(of, F.lit(0)), True).otherwise(F.raise_error(F.concat(F.lit(f"{n} rows of "), F.coalesce(of, F.lit(0)).cast("string")))))


def _opened(path: str):
    """A Parquet folder or file at a path or URI of any file system, as a dataset."""
    import pyarrow.dataset as ds
    from pyarrow.fs import FileSystem

    if "://" in path or path.startswith("file:"):
        files, path = FileSystem.from_uri(path)
        return ds.dataset(path, filesystem=files, format="parquet")
    return ds.dataset(path, format="parquet")


class _Reader(DataSourceReader):
    """One partition per file of keys: the driver sees the files' names only."""

    def __init__(self, options):
        self.path, self.keys, self.size = options["path"], options["keys"], int(options.get("batch", "50"))

    def partitions(self) -> list[InputPartition]:
        found = _opened(self.keys).files
        root = self.keys.split("://")[0] + "://" if "://" in self.keys else ""
        return [_File(root + f) for f in found] or [_File("")]

    def read(self, partition: _File) -> Iterator[tuple]:
        import pyarrow.compute as pc

        if not partition.path:
            return
        store = _opened(self.path)

        def fetch(keys):
            rows = store.to_table(columns=["key", "target", "value"], filter=pc.field("key").isin(keys)).to_pylist()
            return {r["key"]: (r["target"], r["value"]) for r in rows}

        for batch in _opened(partition.path).to_batches(columns=["key"], batch_size=self.size):
            keys = batch.column(0).drop_null().unique().to_pylist()
            for key, (name, value, hops) in sorted(resolve(keys, fetch).items()):
                yield key, name, value, hops
