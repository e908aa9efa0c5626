"""Cluster plumbing of this subpackage: the shared folder, written intermediate tables, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: The paths of the innermost open ``scratch``.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session gets one of its own; a cluster is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = current.get() if current.isDefined() else None
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="wearlake-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def own_prefix(names: list[str], wish: str) -> str:
    """A prefix like ``wish`` that no name starts with, in any case of its letters."""
    while any(n.lower().startswith(wish.lower()) for n in names):
        wish = f"_{wish}"
    return wish


def value_text(df: DataFrame, name: str) -> Column:
    """A column's values as text that is equal just where the values are; null stays null."""
    kind = df.schema[name].dataType.typeName()
    value = F.col(f"`{name}`")
    if kind in ("float", "double"):
        value = value + F.lit(0).cast(kind)  # -0.0 is 0.0
    if kind in ("struct", "array", "map", "variant"):
        return F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return F.hex(value) if kind == "binary" else value.cast("string")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted by the innermost open ``scratch``."""
    path, owned = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, also after an error, all tables that operators wrote inside it.

    DataFrames that operators return may read such tables, so results have to be
    saved or collected inside.  Paths that are gone already are no error.
    """
    owned: list[str] = []
    token = _OWNED.set(owned)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in owned:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame into the shared folder and read it back.

    The written table survives lost executors and cuts the lineage.  Its place
    is kept in ``df.wearlake_path`` for ``discard``.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.wearlake_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables written by ``materialise`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "wearlake_path", None)
        if path:
            _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that are written and no longer referred to, where the session has its JVM at hand."""
    gc.collect()
    jvm = getattr(getattr(spark, "sparkContext", None), "_jvm", None)
    if jvm is not None:
        jvm.System.gc()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an undirected edge list, written; a component is named by its smallest node.

    Large-star and small-star rounds in turn, until every edge leads from a node
    to the one root it has.  Each round is a partial aggregation and an
    equi-join, so a node with very many neighbours is pre-aggregated and its
    join partition can be split.  Rounds are written to the shared folder.
    Self-loops keep their node; nulls are ignored; an empty edge list gives an
    empty result.
    """
    seen = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    nodes = materialise(seen.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    links = written = nodes
    loops = True
    while True:
        ends = links.filter("u <> v") if loops else links
        end = lambda node, up: F.struct(F.col(node).alias("node"), F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
        role = ends.select(F.explode(F.array(end("u", 1), end("v", 0))).alias("r"))
        role = role.groupBy("r.node").agg(F.sum("r.up").alias("up"), F.max("r.down").alias("down"))
        if role.filter("up + down > 1 and up > 0").isEmpty():
            break
        edge = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
        both = ends.select(F.explode(F.array(edge("u", "v"), edge("v", "u"))).alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(edge("u", "m"), edge("v", "m"))).alias("e"))
        now = materialise(small.select("e.u", "e.v").filter("u <> v").distinct(), "star")
        if written is not nodes:
            discard(written)
        links, written, loops = now, now, False
    ends = nodes.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = (links.filter("u <> v") if loops else links).groupBy("u").agg(F.min("v").alias("m"))
    found = materialise(
        ends.join(labels, ends.node == labels.u, "left").select("node", F.coalesce("m", "node").alias("component")),
        "components",
    )
    discard(nodes, written)
    return found
