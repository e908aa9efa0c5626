"""Queries from frames as bytes to motion, segments and pixels.  SQL can't express tracking; tests compare with brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearlake.operators import composites, flow, images
from wearlake.plans import standins as st
from wearlake.registry import query, r6


@query()
def flow_magnitudes(spark, d):
    return flow.magnitudes(st.video(spark, d)).select("session", "frame", *r6("magnitude"))


@query()
def video_segments(spark, d):
    return composites.video_segments(st.video(spark, d)).select(
        "session", "start_frame", "end_frame", *r6("confidence", "motion_magnitude")
    )


@query()
def segment_motion_levels(spark, d):
    """The dense motion of uniform segments of ten frames."""
    k = F.floor(F.col("frame") / 10)
    frames = st.video(spark, d)
    segments = frames.groupBy("session", k.alias("segment")).agg(
        F.min("frame").alias("start_frame"), (F.max("frame") + 1).alias("end_frame")
    )
    return flow.segment_motion(segments, frames).select(
        "session", "segment", "motion_level", "motion_confidence", *r6("flow_magnitude")
    )


@query()
def video_pixels(spark, d):
    """Frames with a box blurred, resized to 224 x 224 and scaled: sums of their pixels by channel."""
    box = F.array(F.struct(F.lit(8).alias("x"), F.lit(4).alias("y"), F.lit(30).alias("w"), F.lit(40).alias("h")))
    out = images.video_stage(st.video(spark, d).withColumn("faces", box), boxes="faces", sums=True)
    return out.select(
        "session", "frame", "height", "width", "n", *(F.round(F.get("sums", F.lit(k)), 6).alias(c) for k, c in enumerate(("red", "green", "blue")))
    )
