"""An index of vectors by direction: inverted lists written as Parquet partitions, searched for many queries at once.

Centroids are fitted on a bounded sample; every vector goes to the list of its nearest one, and the lists are
partitions, so that a search reads only the lists it probes.  Each list keeps its reach, the smallest cosine of a
member with the centroid, which bounds what an unprobed list can hold: ``exact`` searches go on to just the lists that
could still change a result.  How many lists a search probes by itself is measured on the sample when the index is
built.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass
class VectorIndex:
    """centroids: (lists + 1, dim), the last one zero, of vectors without direction; reach: the least cosine in each list."""

    path: str
    key: str
    vector: str
    centroids: np.ndarray
    reach: np.ndarray
    probes: int
    schema: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return _lists(spark, self.path, self.schema)

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """The largest cosine that each list can hold for each unit query."""
        away = np.arccos(np.clip(unit @ self.centroids.T, -1, 1)) - np.arccos(np.clip(self.reach, -1, 1))[None, :]
        out = np.cos(np.maximum(away, 0)) + 1e-9
        out[:, -1] = 0.0
        return out


def _units(vectors: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are vectors of that width, their unit vectors); a zero vector stays zero."""
    keep, out = [], []
    for k, v in enumerate(vectors.to_pylist()):
        if not v or None in v or dim is not None and len(v) != dim:
            continue
        x = np.array(v, np.float64)
        if np.isfinite(x).all():
            top = np.abs(x).max()
            x = x / top if top else x
            size = np.linalg.norm(x)
            keep.append(k)
            out.append(x / size if size else x)
    return np.array(keep, np.int64), np.array(out).reshape(len(out), dim or (len(out[0]) if out else 0))


def _centroids(x: np.ndarray, lists: int, rounds: int, seed: int) -> np.ndarray:
    """Unit centroids of unit vectors; a list that runs empty takes a random row."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), lists, replace=len(x) < lists)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], x[rng.integers(0, len(x), lists)])
    return c


def _enough(x: np.ndarray, c: np.ndarray, k: int, recall: float, seed: int) -> int:
    """Lists to probe so that of the k nearest rows of the sample that share is found, over at most 256 of its rows."""
    rng = np.random.default_rng(seed)
    asked = rng.choice(len(x), min(256, len(x)), replace=False)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -2
    k = min(k, len(x) - 1)
    if k < 1:
        return 1
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    home = (x @ c.T).argmax(axis=1)
    order = np.argsort(np.argsort(-(x[asked] @ c.T), axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.sort(np.take_along_axis(order, home[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def build(
    df: DataFrame, path: str, key: str = "id", vector: str = "embedding", lists: int | None = None, sample_rows: int = 16_384,
    k: int = 10, recall: float = 0.95, rows_per_file: int = 200_000, seed: int = 5,
) -> VectorIndex:
    """Write an index of all rows of ``df`` (all their columns) under ``path``.

    Lists are as many as the square root of the rows, 4096 at most (that many centroids go to every task), unless
    given.  Null vectors, those with null or non-finite components and those whose width isn't the most frequent one
    aren't indexed; zero vectors are, in a list of their own.  A crowded list is written by many tasks.
    """
    spark = df.sparkSession
    usable = df.filter(F.col(vector).isNotNull())
    usual = usable.groupBy(F.size(vector).alias("n")).count().filter("n > 0").orderBy(F.desc("count"), F.desc("n")).first()
    dim, total = (usual["n"], usual["count"]) if usual else (1, 0)
    drawn = usable.filter(F.size(vector) == dim).orderBy(F.xxhash64(key), key).select(vector).limit(sample_rows).toArrow()
    sample = _units(drawn.column(0).combine_chunks(), dim)[1]
    sample = sample[np.abs(sample).max(axis=1, initial=0) > 0]
    count = max(1, min(lists or round(total**0.5), 4096, max(1, len(sample))))
    own = _centroids(sample, count, 10, seed) if len(sample) else np.zeros((1, dim))
    probes = _enough(sample, own, k, recall, seed) if len(sample) else 1
    centroids = np.vstack((own, np.zeros((1, dim))))
    names = df.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                keep, unit = _units(part.column(names.index(vector)), dim)
                score = unit @ centroids[:-1].T
                home = score.argmax(axis=1) if len(unit) else np.zeros(0, np.int64)
                flat = np.abs(unit).max(axis=1, initial=0) == 0
                near = np.where(flat, 1.0, score[np.arange(len(unit)), home])
                home = np.where(flat, len(centroids) - 1, home).astype(np.int32)
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(at) for c in part.columns), pa.array([u.tobytes() for u in unit], pa.binary()), pa.array(near), pa.array(home)],
                    [*names, "_unit", "_near", "_list"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    placed = df.mapInArrow(assign, f"{kinds}, _unit binary, _near double, _list int")
    schema = placed.schema.json()
    salted = placed.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(16)))
    salted.repartition("_list", "_salt").drop("_salt").write.option("maxRecordsPerFile", rows_per_file).partitionBy("_list").parquet(f"{path}/lists")
    held = {r["_list"]: r["reach"] for r in _lists(spark, path, schema).groupBy("_list").agg(F.min("_near").alias("reach")).collect()}  # a row a list
    reach = np.array([held.get(c, 2.0) for c in range(len(centroids))])
    rows = [(c, [float(x) for x in centroids[c]], float(reach[c]), probes, schema) for c in range(len(centroids))]
    spark.createDataFrame(rows, "list int, centroid array<double>, reach double, probes int, schema string").coalesce(1).write.parquet(f"{path}/centroids")
    return VectorIndex(path, key, vector, centroids, reach, probes, schema)


def _lists(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{path}/lists")


def load(spark: SparkSession, path: str, key: str = "id", vector: str = "embedding") -> VectorIndex:
    """An index that ``build`` wrote; its centroids are at most 4097 rows."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("list").collect()
    return VectorIndex(path, key, vector, np.array([r.centroid for r in rows]), np.array([r.reach for r in rows]), rows[0].probes, rows[0].schema)


def _probed(queries: DataFrame, index: VectorIndex, query: str, vector: str, probes: int) -> DataFrame:
    """(query, unit, lists): the nearest lists that have members, nearest first; the list without direction counts as any other."""
    kind = queries.schema[query].dataType.simpleString()
    there = index.reach <= 1.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, unit = _units(batch.column(1), index.centroids.shape[1])
            score = np.where(there[None, :], unit @ index.centroids.T, -2.0)
            order = np.argsort(-score, axis=1, kind="stable")[:, : min(probes, int(there.sum()))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), pa.array([u.tobytes() for u in unit], pa.binary()), pa.array(list(order), pa.list_(pa.int32()))],
                ["_query", "_unit", "_lists"],
            )

    return queries.select(query, vector).mapInArrow(run, f"_query {kind}, _unit binary, _lists array<int>")


def _scan(asked: DataFrame, index: VectorIndex, k: int, where: Column | None, block: int) -> DataFrame:
    """(query, key, similarity): for each query and probed list's block its k best rows; only probed partitions are read."""
    spark = asked.sparkSession
    wanted = asked.select(F.explode("_lists").alias("_list"), "_query", "_unit")
    read = sorted(r["_list"] for r in wanted.select("_list").distinct().collect())  # at most as many as lists
    members = index.rows(spark).filter(F.col("_list").isin(read))
    members = members.filter(where) if where is not None else members
    kinds = {"q": asked.schema["_query"].dataType.simpleString(), "k": members.schema[index.key].dataType.simpleString()}
    count = lambda df, name: df.groupBy("_list").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    grid = count(wanted, "_a").join(count(members, "_b"), "_list")
    number = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = wanted.join(grid, "_list").withColumn("a", number("_query", "_a")).withColumn("b", every("_b"))
    right = members.join(grid, "_list").withColumn("b", number(index.key, "_b")).withColumn("a", every("_a"))
    left = left.select("_list", "a", "b", "_query", "_unit")
    right = right.select("_list", "a", "b", F.col(index.key).alias("_key"), F.col("_unit").alias("_member"))

    def best(asked: pa.Table, held: pa.Table) -> pa.Table:
        columns = [[], [], []]
        if len(asked) and len(held):
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.float64).reshape(len(t), -1) for t, c in ((asked, "_unit"), (held, "_member")))
            keys = held.column("_key").combine_chunks()
            rank = np.empty(len(keys), np.int64)
            rank[keys.to_pandas().argsort(kind="stable")] = np.arange(len(keys))
            for start in range(0, len(x), 256):
                score = x[start : start + 256] @ y.T
                least = np.partition(score, len(y) - k, axis=1)[:, len(y) - k] if len(y) > k else np.full(len(score), -2.0)
                i, j = np.nonzero(score >= least[:, None] - 1e-9)
                value = np.einsum("ij,ij->i", x[start + i], y[j])  # one way for all pairs, so that equal vectors tie
                order = np.lexsort((rank[j], -value, i))
                order = order[np.arange(len(order)) - np.searchsorted(i[order], i[order]) < k]
                columns[0].append(asked.column("_query").combine_chunks().take(pa.array(start + i[order])))
                columns[1].append(keys.take(pa.array(j[order])))
                columns[2].append(pa.array(value[order]))
        if not columns[0]:
            return pa.table([asked.column("_query").slice(0, 0), held.column("_key").slice(0, 0), pa.array([], pa.float64())], names=["_query", "_key", "_score"])
        return pa.table([pa.concat_arrays(c) for c in columns], names=["_query", "_key", "_score"])

    found = left.groupBy("_list", "a", "b").cogroup(right.groupBy("_list", "a", "b")).applyInArrow(
        best, f"_query {kinds['q']}, _key {kinds['k']}, _score double"
    )
    return _first(found, k)


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("_query").orderBy(F.desc("_score"), "_key")
    return found.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)


def search(
    queries: DataFrame, index: VectorIndex, k: int, query: str = "query_id", vector: str = "embedding", probes: int | None = None,
    exact: bool = False, where: Column | None = None, block: int = 4096,
) -> DataFrame:
    """(query, key, similarity, rank): the k rows of highest cosine of each query, ties by key.

    Query ids and keys are unique.  Queries that aren't vectors of the index's width have no rows; of a zero vector all
    similarities are 0.  ``probes`` lists are read (as many as the index measured, unless given).  With ``exact`` a
    second pass reads, for each query, the lists that can hold a row better than its k-th, or any, where it has fewer;
    then the result is that of a whole scan.  ``where`` selects rows before they count.
    """
    probes = max(1, probes or index.probes)
    asked = _probed(queries, index, query, vector, probes)
    found = _scan(asked, index, k, where, block)
    if exact:
        worst = found.groupBy("_query").agg(F.min("_score").alias("_least"), F.count("*").alias("_n")).withColumnRenamed("_query", "_q")
        known = asked.join(worst, F.col("_query") == F.col("_q"), "left").select(
            "_query", "_unit", "_lists", F.when(F.col("_n") >= k, F.col("_least")).otherwise(F.lit(-2.0)).alias("_least")
        )
        kind = asked.schema["_query"].dataType.simpleString()

        def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                unit = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float64).reshape(batch.num_rows, -1)
                may = (index.reach <= 1.5)[None, :] & (index.bounds(unit) >= batch.column(3).to_numpy()[:, None])
                for row, done in enumerate(batch.column(2).to_pylist()):
                    may[row, done] = False
                lists = [np.flatnonzero(m).astype(np.int32) for m in may]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], ["_query", "_unit", "_lists"])

        rest = known.mapInArrow(more, f"_query {kind}, _unit binary, _lists array<int>")
        found = _first(found.drop("_rank").union(_scan(rest, index, k, where, block).drop("_rank")), k)
    return found.select(
        F.col("_query").alias(query), F.col("_key").alias(index.key), F.col("_score").alias("similarity"), F.col("_rank").alias("rank")
    )
