"""Labelling tasks in numbered pages as a data source, for batches and streams.

``spark.read.format("task_pages").option("path", folder)`` reads ``page-1.json``, ``page-2.json``, ... of a folder or
store that pyarrow reads, each ``{"tasks": [...]}`` (or ``results``) of ``page_size`` tasks (100) but for the last one.
The pages are partitions; where they end is found by a search over page numbers, since a page that isn't full is the
last.  An equal session id is asked of the pages themselves, so other tasks don't leave them.  A stream's offset is the
number of tasks that were read: new tasks at the end, in the last page or behind it, come once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, InputPartition

from wearlake.operators import labeling

#: Tasks as pages give them; session_id is the one of ``data``, on its own so that it can be asked for.
SCHEMA = f"{labeling.TASKS}, session_id string"


def _arrow() -> pa.Schema:
    number, text = pa.int64(), pa.string()
    data = pa.struct([("session_id", text), *((c, number) for c in ("frame_index", "segment_index", "start_frame", "end_frame"))])
    note = pa.struct([("was_cancelled", pa.bool_()), ("result", text), ("completed_by", text), ("created_at", text)])
    return pa.schema([("id", number), ("data", data), ("annotations", pa.list_(note)), ("session_id", text)])


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def fetch(path: str, page: int) -> list[dict]:
    """The tasks of a page; none of a page that isn't there."""
    store, folder = _store(path)
    name = f"{folder.rstrip('/')}/page-{page}.json"
    if store.get_file_info(name).type == pyarrow.fs.FileType.NotFound:
        return []
    with store.open_input_stream(name) as f:
        got = json.loads(f.read())
    return got.get("tasks") or got.get("results") or []


def count_tasks(full: int, get: Callable[[int], list], start: int = 1) -> int:
    """Tasks of all pages, from the knowledge that all pages before ``start`` are full: doubling steps, then halving ones."""
    low, step = start - 1, 1  # pages up to low are full
    while len(get(low + step)) >= full:
        low, step = low + step, step * 2
    high = low + step  # this page isn't full
    while high - low > 1:
        middle = (low + high) // 2
        if len(get(middle)) >= full:
            low = middle
        else:
            high = middle
    return low * full + len(get(high))


class _Page(InputPartition):
    """Tasks first to end (end left out) of a page."""

    def __init__(self, page: int, first: int, end: int):
        self.page, self.first, self.end = page, first, end


class _Pages:
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("task_pages needs a path")
        self.path, self.size, self.session = options["path"], int(options.get("page_size", 100)), None
        if self.size < 1:
            raise ValueError("page_size must be at least 1")

    def count(self, start: int = 0) -> int:
        return count_tasks(self.size, lambda page: fetch(self.path, page), start // self.size + 1)

    def split(self, start: int, end: int) -> list[_Page]:
        """The tasks start to end, a partition a page."""
        return [
            _Page(p + 1, max(0, start - p * self.size), min(self.size, end - p * self.size))
            for p in range(start // self.size, -(-end // self.size))
        ]

    def batches(self, part: _Page | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark makes of no partitions
            return
        rows = fetch(self.path, part.page)[part.first : part.end]
        rows = [r | {"session_id": (r.get("data") or {}).get("session_id")} for r in rows]
        if self.session is not None:
            rows = [r for r in rows if r["session_id"] == self.session]
        yield pa.RecordBatch.from_pylist(rows, _arrow())


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.pages = _Pages(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("session_id",) and self.pages.session is None:
                self.pages.session = f.value
            else:
                yield f

    def partitions(self) -> Sequence[_Page]:
        return self.pages.split(0, self.pages.count())

    def read(self, partition: _Page) -> Iterator[pa.RecordBatch]:
        return self.pages.batches(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.pages, self.known = _Pages(options), 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"tasks": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.known = max(self.known, self.pages.count(self.known))
        return {"tasks": self.known}

    def partitions(self, start: dict, end: dict) -> Sequence[_Page]:
        self.known = max(self.known, end["tasks"])
        return self.pages.split(start["tasks"], end["tasks"])

    def read(self, partition: _Page) -> Iterator[pa.RecordBatch]:
        return self.pages.batches(partition)

    def commit(self, end: dict) -> None:
        pass


class TaskPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "task_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Batch:
        return _Batch(self.options)

    def streamReader(self, schema) -> _Stream:  # noqa: N802
        return _Stream(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it be asked for sessions."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TaskPages)


def read_tasks(spark: SparkSession, path: str, page_size: int = 100) -> DataFrame:
    register(spark)
    return spark.read.format("task_pages").option("path", path).option("page_size", page_size).load()


def write_pages(tasks: DataFrame, path: str, page_size: int = 100) -> None:
    """Write tasks (as labeling.TASKS) as pages in the order of their ids, in a store that all machines share.

    Rows are numbered by sorted parts and the counts of the parts before (as many numbers as parts); a task writes a
    page, at once and under its own name, so one that is repeated changes nothing.
    """
    placed = tasks.select("id", F.to_json(F.struct("id", "data", "annotations")).alias("body")).repartitionByRange("id").sortWithinPartitions("id", "body")
    placed = placed.withColumn("_place", F.monotonically_increasing_id()).persist()
    try:
        held = placed.groupBy(F.shiftright("_place", 33).alias("part")).count().orderBy("part").collect()
        first, total = {}, 0
        for r in held:
            first[r.part], total = total, total + r["count"]
        base = F.create_map(*(F.lit(x) for k, v in first.items() for x in (k, v))) if first else F.create_map(F.lit(0), F.lit(0))
        number = base[F.shiftright("_place", 33)] + F.col("_place").bitwiseAND((1 << 33) - 1)

        def write(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
            store, folder = _store(path)
            store.create_dir(folder, recursive=True)
            name = f"{folder.rstrip('/')}/page-{key[0]}.json"
            begun = f"{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(begun) as f:
                f.write(('{"tasks": [' + ",".join(p.sort_values("n")["body"]) + "]}").encode())
            store.move(begun, name)
            return pd.DataFrame({"page": [key[0]], "tasks": [len(p)]})

        pages = placed.withColumn("n", number).groupBy((F.floor(F.col("n") / page_size) + 1).cast("long").alias("page"))
        pages.applyInPandas(write, "page long, tasks long").write.format("noop").mode("overwrite").save()
    finally:
        placed.unpersist()
