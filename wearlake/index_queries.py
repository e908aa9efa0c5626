"""Queries of the written vector index, the cell cover and the bucketed catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import geo
from wearlake.operators import geocells, vectorindex
from wearlake.plans import standins as st
from wearlake.registry import query, r6
from wearlake.sources import catalogue
from wearlake.sources.scratch import scratch_path


def _index(spark, d) -> tuple[DataFrame, vectorindex.VectorIndex]:
    e = st.read(spark, d, "embeddings").withColumnRenamed("vec_id", "id")
    asked = e.filter("id % 50 = 0").select(F.col("id").alias("query_id"), "embedding")
    return asked, vectorindex.build(e, scratch_path(spark, "vector-index"))


@query("""WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0),
p AS (SELECT q.id AS query_id, e.id, list_cosine_similarity(q.v, e.v) AS similarity FROM e q JOIN e ON q.id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS n FROM p)
SELECT query_id, id, n AS place, round(similarity, 6) AS similarity FROM k WHERE n <= 10""")
def indexed_topk(spark, d):
    """The ten nearest of every fiftieth vector, through the index and certified by its bounds."""
    asked, index = _index(spark, d)
    return vectorindex.search(asked, index, 10, exact=True).select(
        "query_id", "id", F.col("rank").alias("place"), *r6("similarity")
    )


@query()
def index_recall(spark, d):
    """How many of the ten nearest the probed lists alone find, per query."""
    asked, index = _index(spark, d)
    near = vectorindex.search(asked, index, 10).select("query_id", "id", F.lit(1).alias("hit"))
    true = vectorindex.search(asked, index, 10, exact=True).select("query_id", "id")
    return true.join(near, ["query_id", "id"], "left").groupBy("query_id").agg(
        F.count("*").alias("wanted"), F.count("hit").alias("found"), F.lit(index.probes).alias("probes"), F.lit(len(index.reach) - 1).alias("lists")
    )


def _geodesic_sql(pairs: str, steps: int = 8) -> str:
    """CTEs that add the ellipsoid's distance ``m`` to pairs (lat1, lon1, lat2, lon2) in the same number of steps."""
    f = f"{geo.FLATTENING!r}::DOUBLE"
    polar = f"{geo.POLE_M!r}::DOUBLE"
    arc = """sqrt(pow(c2 * sin(lam), 2) + pow(c1 * s2 - s1 * c2 * cos(lam), 2)) AS ss, s1 * s2 + c1 * c2 * cos(lam) AS cs"""
    more = """*, atan2(ss, cs) AS sigma, CASE WHEN ss > 0 THEN c1 * c2 * sin(lam) / ss ELSE 0 END AS sa"""
    middle = """*, CASE WHEN 1 - sa * sa > 1e-15::DOUBLE THEN cs - 2 * s1 * s2 / (1 - sa * sa) ELSE 0 END AS cm, 1 - sa * sa AS c2a"""
    parts = [
        f"""g0 AS (SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, turn AS lam FROM (
SELECT *, atan((1 - {f}) * tan(radians(lat1))) AS u1, atan((1 - {f}) * tan(radians(lat2))) AS u2, radians(lon2 - lon1) AS turn FROM {pairs}))"""
    ]
    for k in range(1, steps + 1):
        parts.append(
            f"""g{k} AS (SELECT * EXCLUDE (lam, ss, cs, sigma, sa, cm, c2a, c), turn + (1 - c) * {f} * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1))) AS lam
FROM (SELECT *, {f} / 16 * c2a * (4 + {f} * (4 - 3 * c2a)) AS c FROM (SELECT {middle} FROM (SELECT {more} FROM (SELECT *, {arc} FROM g{k - 1})))))"""
        )
    parts.append(
        f"""gm AS (SELECT *, {polar} * big * (sigma - small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) AS m
FROM (SELECT *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS big, u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS small
FROM (SELECT *, c2a * {(geo.AXIS_M**2 - geo.POLE_M**2) / geo.POLE_M**2!r}::DOUBLE AS u FROM (SELECT {middle} FROM (SELECT {more} FROM (SELECT *, {arc} FROM g{steps}))))))"""
    )
    return ",\n".join(parts)


@query(f"""WITH {st.EPISODES}, c AS (SELECT s_suppkey AS centre_id, 12.0::DOUBLE + (s_suppkey * 37 % 2000) * 1e-3 AS lat1, 77.0::DOUBLE + (s_suppkey * 91 % 2000) * 1e-3 AS lon1 FROM supplier),
p AS (SELECT centre_id, id, lat1, lon1, lat AS lat2, lon AS lon2 FROM c JOIN e ON lat BETWEEN lat1 - 0.03 AND lat1 + 0.03 AND lon BETWEEN lon1 - 0.03 AND lon1 + 0.03),
{_geodesic_sql("p")}
SELECT centre_id, id, round(m, 3) AS distance_m FROM gm WHERE m <= 3000""")
def geo_within(spark, d):
    """Episodes that start within 3 km of each of many places, on the ellipsoid."""
    k = F.col("s_suppkey")
    places = st.read(spark, d, "supplier").select(
        k.alias("centre_id"), (F.lit(12.0) + (k * 37 % 2000) * 1e-3).alias("lat"), (F.lit(77.0) + (k * 91 % 2000) * 1e-3).alias("lon")
    )
    return geocells.within(places, st.episodes(spark, d), 3000.0).withColumn("distance_m", F.round("distance_m", 3))


@query(f"""WITH {st.EPISODES}, u AS (SELECT id, session, frames + 1000 AS frames, 'new' AS scenario FROM e WHERE session % 11 = 0),
a AS (SELECT id, session, 400000 + id % 7 AS frames, 'added' AS scenario FROM e WHERE session % 13 = 0)
SELECT session, id, frames, scenario FROM (
  SELECT session, id, frames, scenario FROM e WHERE session % 11 <> 0 UNION ALL SELECT session, id, frames, scenario FROM u
  UNION ALL SELECT session, -id - 1 AS id, frames, scenario FROM a) WHERE session NOT IN (7, 22) AND frames <> 400003""")
def catalogue_changes(spark, d):
    """A bucketed catalogue of all episodes after an upsert, the deletion of sessions and a deletion by condition."""
    e = st.episodes(spark, d).select("session", "id", "frames", "scenario")
    path = scratch_path(spark, "catalogue")
    catalogue.create(e, path, by="session", buckets=32)
    newer = e.filter("session % 11 = 0").withColumns({"frames": F.col("frames") + 1000, "scenario": F.lit("new")})
    added = e.filter("session % 13 = 0").withColumns(
        {"frames": 400_000 + F.col("id") % 7, "scenario": F.lit("added"), "id": -F.col("id") - 1}
    )
    catalogue.merge(newer.unionByName(added), path, ["session", "id"], "frames")
    catalogue.delete(spark, path, F.lit(True), sessions=[7, 22])
    catalogue.delete(spark, path, F.col("frames") == 400_003)
    return catalogue.read(spark, path)
