"""Recordings derived from the driver's tables, in Spark and, as CTEs, in SQL.

events are a sensor stream per user (session); positions and magnitudes follow
from event_id.  orders are episodes, conversations transcripts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    n = F.col("event_id")
    return e.select(
        F.col("user_id").alias("session"), n, (
            F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 1e6
        ).alias("t"), "value",
        (F.lit(12.9) + (n % 1000) * 1e-4).alias("lat"), (
            F.lit(77.5) + (n * 7 % 1000) * 1e-4
        ).alias("lon"), (n % 7).cast("double").alias("speed"), (
            (n % 9) / 2.0
        ).alias("magnitude"), F.col("event_type").alias("kind"),
    )


SENSOR = """s AS (SELECT user_id AS session, event_id, epoch_us(ts) / 1e6 AS t, value, 12.9::DOUBLE + (event_id % 1000) * 1e-4 AS lat,
 77.5::DOUBLE + (event_id * 7 % 1000) * 1e-4 AS lon, (event_id % 7)::DOUBLE AS speed, (event_id % 9) / 2e0 AS magnitude, event_type AS kind FROM events)"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("session").orderBy("t", "event_id")
    return sensor(spark, sf_dir).withColumn("frame", (F.row_number().over(w) - 1).cast("long"))


FRAMES = SENSOR + ", f AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY t, event_id) - 1 AS frame FROM s)"


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as spoken intervals of 2.5 s, every 2 s."""
    c = read(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").alias("session"), F.col("turn").alias("ord"), (F.col("turn") * 2.0).alias("r_start"),
        (F.col("turn") * 2.0 + 2.5).alias("r_end"), "text",
    )


TRANSCRIPTS = "r AS (SELECT conv_id AS session, turn AS ord, turn * 2e0 AS r_start, turn * 2e0 + 2.5e0 AS r_end, text FROM conversations)"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of 3.2 s per conversation, up to the end of its last turn."""
    c = transcripts(spark, sf_dir).groupBy("session").agg(F.max("r_end").alias("end"))
    return c.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("end") / 3.2) - 1))).select(
        "session", "segment", (F.col("segment") * 3.2).alias("l_start"), (F.col("segment") * 3.2 + 3.2).alias("l_end")
    )


SPANS = """l AS (SELECT session, segment, segment * 3.2e0 AS l_start, segment * 3.2e0 + 3.2e0 AS l_end
 FROM (SELECT conv_id AS session, unnest(range(0, ceil((max(turn) * 2e0 + 2.5e0) / 3.2e0)::BIGINT)) AS segment FROM conversations GROUP BY conv_id))"""


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"), F.col("o_custkey").alias("session"), (k % 400 + 3).alias("frames"), F.col(
            "o_orderpriority"
        ).alias("scenario"), F.col("o_orderstatus").alias("status"),
        (F.lit(12.0) + (k % 2000) * 1e-3).alias("lat"), (
            F.lit(77.0) + (k * 3 % 2000) * 1e-3
        ).alias("lon"), F.col("o_totalprice").alias("price"),
    )


EPISODES = """e AS (SELECT o_orderkey AS id, o_custkey AS session, o_orderkey % 400 + 3 AS frames, o_orderpriority AS scenario, o_orderstatus AS status,
 12.0::DOUBLE + (o_orderkey % 2000) * 1e-3 AS lat, 77.0::DOUBLE + (o_orderkey * 3 % 2000) * 1e-3 AS lon, o_totalprice AS price FROM orders)"""


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct 30-second chunks, numbered by time over the session's hours (coarse, so that holes occur)."""
    s = sensor(spark, sf_dir).withColumn("chunk", F.floor(F.col("t") / 3600).cast("long"))
    return s.groupBy("session", "chunk").agg(F.min("t").alias("start_time"), F.max("t").alias("end_time"))


CHUNKS = SENSOR + ", c AS (SELECT session, floor(t / 3600)::BIGINT AS chunk, min(t) AS start_time, max(t) AS end_time FROM s GROUP BY ALL)"


#: Bytes of frames that are drawn at a time.
DRAWN = 1 << 20


def drawn(parts: Iterator[pd.DataFrame], side: int) -> Iterator[pd.DataFrame]:
    """(session, frame, image) of rows with the frame's own vector, the session's first one and how far it has moved;
    images are many times as large as these rows, so few go out at a time."""
    cell, few = np.arange(side) / 8.0, max(1, DRAWN // (3 * side * side))
    for p in (q.iloc[a : a + few] for q in parts for a in range(0, len(q), few)):
        images = []
        for own, v, x in zip(p["embedding"], p["first"], p["moved"]):
            if own is None or v is None or not len(v):
                images.append(None)
                continue
            tile = np.resize(np.abs(np.nan_to_num(np.asarray(v, float))) * 1000 % 256, (8, 8))
            weights = []
            for at in (cell, cell - x / 8.0):
                low, share = np.floor(at).astype(int) % 8, at - np.floor(at)
                w = np.zeros((side, 8))
                w[np.arange(side), low] = 1 - share
                w[np.arange(side), (low + 1) % 8] += share
                weights.append(w)
            light = weights[0] @ tile @ weights[1].T
            images.append(np.rint(np.stack((light, light, light / 2), axis=2)).astype(np.uint8).tobytes())
        yield p[["session", "frame"]].assign(image=pd.Series(images, index=p.index, dtype=object))


def video(spark: SparkSession, sf_dir: str, side: int = 64) -> DataFrame:
    """Frames of 40 a session, all vectors: the picture of the session's first vector, moved sideways by 0, 2, 4 and 6
    pixels a frame for ten frames each; a null vector is a frame without an image.

    Vectors weigh little and frames cost much, so sessions are dealt to as many tasks as spark.sql.shuffle.partitions says.
    """
    e = read(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 40).cast("long").alias("session"), (F.col("vec_id") % 40).cast("long").alias("frame"), "embedding"
    )
    e = e.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "session")
    first = e.groupBy("session").agg(F.min_by("embedding", "frame").alias("first"))
    speed = F.floor(F.col("frame") / 10) * 2.0
    moved = F.sum(speed).over(Window.partitionBy("session").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0))
    placed = e.withColumn("moved", moved).join(first, "session")

    shots = placed.mapInPandas(lambda parts: drawn(parts, side), "session long, frame long, image binary")
    return shots.withColumns({"height": F.lit(side), "width": F.lit(side), "channels": F.lit(3)})
