"""A table of episodes in buckets of a key, changed a few buckets at a time and committed by a manifest.

Under ``path``: data/<write>/bucket=K holds the rows of bucket K that one write made, versions/N.json names for each
bucket the write that holds it.  A change reads and writes only the buckets it touches, then adds the next version
file; readers take the newest version, so they see all of a change or none.  Two changes at once can't both add the
same version: the later one is an error and leaves the table as it was.  Files of old versions stay until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wearlake.operators import catalog

_BUCKET = "_bucket"


@dataclass(frozen=True)
class Version:
    """held: for each bucket with rows, the name of the write that made them.  by: the column whose hash is the bucket."""

    path: str
    number: int
    by: str
    buckets: int
    schema: str
    held: dict[int, str]

    def rows(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets, with a column of the bucket."""
        schema = StructType.fromJson(json.loads(self.schema))
        wanted = sorted(b for b in (self.held if buckets is None else buckets) if b in self.held)
        if not wanted:
            return spark.createDataFrame([], schema).withColumn(_BUCKET, F.lit(None).cast("int"))
        paths = [f"{self.path}/data/{self.held[b]}/{_BUCKET}={b}" for b in wanted]
        files = spark.read.schema(schema).parquet(*paths)
        return files.withColumn(_BUCKET, F.regexp_extract(F.col("_metadata.file_path"), f"{_BUCKET}=(\\d+)/[^/]*$", 1).cast("int"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _bucket(df: DataFrame, by: str, buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int"))


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def current(spark: SparkSession, path: str) -> Version:
    """The newest version of a table."""
    numbers = [int(n.removesuffix(".json")) for n in _names(spark, f"{path}/versions") if n.removesuffix(".json").isdigit()]
    if not numbers:
        raise FileNotFoundError(f"no table at {path}")
    raw = json.loads(spark.read.text(f"{path}/versions/{max(numbers)}.json", wholetext=True).first()[0])
    return Version(path, max(numbers), raw["by"], raw["buckets"], raw["schema"], {int(k): v for k, v in raw["held"].items()})


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version."""
    return current(spark, path).rows(spark).drop(_BUCKET)


def _commit(spark: SparkSession, version: Version) -> Version:
    """Add the version file; it is written whole before it gets its name, which must be free."""
    fs, folder = _fs(spark, f"{version.path}/versions")
    jvm = spark.sparkContext._jvm
    fs.mkdirs(folder)
    body = {"by": version.by, "buckets": version.buckets, "schema": version.schema, "held": version.held}
    written = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = fs.create(written, False)
    try:
        out.write(bytearray(json.dumps(body).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(written, jvm.org.apache.hadoop.fs.Path(folder, f"{version.number}.json"), options)
    except Exception as e:
        fs.delete(written, False)
        if "FileAlreadyExists" in str(e):
            raise RuntimeError(f"version {version.number} of {version.path} was made meanwhile") from e
        raise
    return version


def _write(rows: DataFrame, path: str, rows_per_file: int = 500_000) -> tuple[str, list[int]]:
    """Write rows (with their bucket) as a new write: (its name, the buckets that have rows)."""
    name = uuid.uuid4().hex
    rows.repartition(_BUCKET).write.option("maxRecordsPerFile", rows_per_file).partitionBy(_BUCKET).parquet(f"{path}/data/{name}")
    made = [int(n.split("=")[1]) for n in _names(rows.sparkSession, f"{path}/data/{name}") if n.startswith(f"{_BUCKET}=")]
    return name, made


def create(df: DataFrame, path: str, by: str = "session_id", buckets: int = 64) -> Version:
    """A new table of ``df``'s rows, bucketed by a column; a table that is there is an error."""
    spark = df.sparkSession
    if _names(spark, f"{path}/versions"):
        raise FileExistsError(f"a table is at {path}")
    name, made = _write(_bucket(df, by, buckets), path)
    return _commit(spark, Version(path, 1, by, buckets, df.schema.json(), dict.fromkeys(made, name)))


def _replace(spark: SparkSession, old: Version, rows: DataFrame, touched: list[int]) -> Version:
    name, made = _write(rows, old.path)
    held = {b: w for b, w in old.held.items() if b not in set(touched)} | dict.fromkeys(made, name)
    return _commit(spark, replace(old, number=old.number + 1, held=held))


def merge(new: DataFrame, path: str, key: list[str], order: str) -> Version:
    """Rows of a key that is there are replaced, others added; of several new rows of a key the latest by ``order``.

    ``key`` must hold the table's bucket column, so that a key's rows are in one bucket.  Only buckets of new rows are
    read and written; no new rows change nothing.
    """
    spark = new.sparkSession
    old = current(spark, path)
    if old.by not in key:
        raise ValueError(f"the key must hold {old.by}")
    named = new.select(*StructType.fromJson(json.loads(old.schema)).fieldNames())
    tagged = _bucket(named, old.by, old.buckets)
    touched = [r[0] for r in tagged.select(_BUCKET).distinct().collect()]  # as many as buckets, at most
    if not touched:
        return old
    before = old.rows(spark, touched).drop(_BUCKET)
    return _replace(spark, old, _bucket(catalog.upsert(before, named, key, order), old.by, old.buckets), touched)


def delete(spark: SparkSession, path: str, where: Column, sessions: list | None = None) -> tuple[Version, int]:
    """Delete rows: (the version after, how many went).

    With ``sessions``, values of the bucket column, only their buckets are looked at; else all are, but for the columns
    that the condition needs.  Buckets without such rows aren't written.  A condition that is null deletes nothing.
    """
    old = current(spark, path)
    near = None
    if sessions is not None:
        kind = StructType.fromJson(json.loads(old.schema))[old.by].dataType
        asked = spark.createDataFrame([(s,) for s in sessions], f"`{old.by}` {kind.simpleString()}")
        near = [r[0] for r in _bucket(asked, old.by, old.buckets).select(_BUCKET).distinct().collect()]
        where = where & F.col(old.by).isin(list(sessions))
    found = dict(old.rows(spark, near).filter(where).groupBy(_BUCKET).count().collect())  # a row a bucket
    if not found:
        return old, 0
    kept = old.rows(spark, sorted(found)).filter(~F.coalesce(where, F.lit(False)))
    return _replace(spark, old, kept, sorted(found)), sum(found.values())


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete data that none of the newest ``keep`` versions holds, and older versions' files; how many writes went.

    Not while a change is under way: what it has written isn't held by a version yet.
    """
    numbers = sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{path}/versions") if n.removesuffix(".json").isdigit())
    held = set()
    for n in numbers[-max(1, keep) :]:
        held |= set(json.loads(spark.read.text(f"{path}/versions/{n}.json", wholetext=True).first()[0])["held"].values())
    gone = [n for n in _names(spark, f"{path}/data") if n not in held]
    for n in numbers[: -max(1, keep)]:
        fs, where = _fs(spark, f"{path}/versions/{n}.json")
        fs.delete(where, False)
    for n in gone:
        fs, where = _fs(spark, f"{path}/data/{n}")
        fs.delete(where, True)
    return len(gone)
