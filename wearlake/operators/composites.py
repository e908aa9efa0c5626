"""Whole stages: the operators of the other modules joined as a session's processing needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import geo
from wearlake.operators import flow, folds, intervals, series
from wearlake.sources.scratch import scratch_path

ACCEL, GYRO = ("accel_x", "accel_y", "accel_z"), ("gyro_x", "gyro_y", "gyro_z")


def align_streams(
    frames: DataFrame, imu: DataFrame, gps: DataFrame | None, audio: DataFrame | None,
    imu_columns: tuple[str, ...] = (*ACCEL, *GYRO), window: float = 0.5, block: int = 16_000, part: str = "session",
    t: str = "t", tie: str | None = None,
) -> DataFrame:
    """frames (part, frame, t) with imu, gps (lat, lon, alt, speed, sine and cosine of the heading) and audio arrays.

    Sensors are interpolated at frame times and held outside; headings as sine and cosine.  audio holds (part, rate,
    samples) and its first sample lies half a window before the first frame; each frame has the ``window`` seconds
    around it, zero-padded, of the lowest rate's length.  Without gps or audio rows the arrays are zeros; a session
    without inertial rows has zeros too.  Times must differ inside a session.
    """
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    out = frames
    at = series.interpolate(imu, frames, list(imu_columns), part, t, tie=tie)
    out = out.join(at.select(part, t, F.array(*imu_columns).alias("imu")).hint("merge"), [part, t], "left")
    if gps is not None:
        sine, cosine = geo.cyclic(F.col("heading"))
        names = ["lat", "lon", "alt", "speed_kmh", "_sin", "_cos"]
        at = series.interpolate(gps.withColumns({"_sin": sine, "_cos": cosine}), frames, names, part, t, tie=tie)
        out = out.join(at.select(part, t, F.array(*names).alias("gps")).hint("merge"), [part, t], "left")
    else:
        out = out.withColumn("gps", zeros(6))
    blank = lambda c, n: F.transform(F.coalesce(c, zeros(n)), lambda x: F.coalesce(x, F.lit(0.0)))
    out = out.withColumns({"imu": blank(F.col("imu"), len(imu_columns)), "gps": blank(F.col("gps"), 6)})
    if audio is None:
        return out.withColumn("audio", F.array().cast("array<double>"))
    rate = audio.agg(F.min("rate")).first()[0] or 0
    count = max(1, int(window * rate))
    begin = frames.groupBy(part).agg(F.min(t).alias("_t0")).join(audio.select(part, "rate"), part, "left")
    placed = out.join(begin.hint("merge"), part).withColumn(
        "_first", F.floor(F.coalesce((F.col(t) - F.col("_t0")) * F.col("rate"), F.lit(0.0))).cast("long")
    )
    cut = intervals.block_windows(
        placed, intervals.sample_blocks(audio, block, part), "_first", count, [part, "frame"], block, part
    )
    return cut.withColumnRenamed("window", "audio").drop("_t0", "rate", "_first")


def imu_stage(
    imu: DataFrame, fps: float = 30.0, rate: float = 100.0, normalise: bool = True, part: str = "session", t: str = "t"
) -> DataFrame:
    """Inertial series without gravity, on a frame grid that ends before the last sample, with quaternions of the angular
    rates and, if ``normalise``, all six channels as z-scores (<column>_z).  A series under two rows stays as it is."""
    flat = folds.remove_gravity(imu.select(part, t, *ACCEL, *GYRO), list(ACCEL), rate, part, t)
    flat = flat.select(part, t, *(F.col(f"{c}_hp").alias(c) for c in ACCEL), *GYRO)
    short = flat.groupBy(part).agg(F.count("*").alias("_n")).filter("_n < 2").select(part)
    times = series.grid(flat, 1.0 / fps, part, t, closed=False).join(short, part, "left_anti")
    resampled = series.interpolate(
        flat, times, [*ACCEL, *GYRO], part, t
    ).unionByName(flat.join(short, part, "left_semi"))
    turned = folds.orientation(resampled, GYRO, 1.0 / fps, part, t)
    return series.z_score(turned, [*ACCEL, *GYRO], part) if normalise else turned


def audio_stage(
    audio: DataFrame, frames: DataFrame, to: int = 16_000, window: float | None = None, start: float = 0.0,
    block: int = 16_000, part: str = "session", t: str = "t",
) -> DataFrame:
    """frames with ``window``: the samples, at the rate ``to`` and scaled to a peak of 1, from each frame's time on, for
    ``window`` seconds (by default each session's median time between frames, 1 / 30 with one frame), zero-padded."""
    pcm = folds.resample_audio(audio, to)
    top = F.array_max(F.transform("samples", F.abs))
    pcm = pcm.withColumn(
        "samples", F.when(top < 1e-8, F.col("samples")).otherwise(F.transform("samples", lambda x: x / top))
    )
    wide = frames.withColumn("_width", F.lit(window)) if window else frames.join(
        series.gaps(frames, part, t).select(part, F.coalesce("median_gap", F.lit(1.0 / 30)).alias("_width")), part
    )
    wide = wide.withColumns(
        {
            "_first": ((F.col(t) - F.lit(start)) * to).cast("long"),
            "_count": F.greatest(F.lit(1), (F.col("_width") * to).cast("int")),
        }
    )
    # a window that begins before the recording has what is left of it, at its front
    left = F.greatest(F.lit(0), F.col("_count") + F.least(F.lit(0), F.col("_first"))).cast("int")
    most = wide.agg(F.max("_count")).first()[0] or 1
    cut = intervals.block_windows(
        wide, intervals.sample_blocks(pcm, block, part), "_first", most, [part, "frame"], block, part
    )
    return cut.withColumn(
        "window", F.concat(F.slice("window", 1, left), F.array_repeat(F.lit(0.0), F.col("_count") - left))
    ).drop("_width", "_first", "_count")


def flow_segments(
    frames: DataFrame, high: float = 3.0, low: float = 1.0, least: int = 15, part: str = "session", i: str = "frame",
    m: str = "magnitude",
) -> DataFrame:
    """Action segments of frames with a flow magnitude, short ones merged; a session of one frame is one segment of
    confidence 0.5 and magnitude 0."""
    few = frames.groupBy(part).agg(F.count("*").alias("_n")).filter("_n < 2").select(part)
    found = folds.merge_short(
        series.hysteresis(frames.join(few, part, "left_anti"), part, i, m, high, low), least, part
    )
    lone = few.select(
        part, F.lit(0).cast("long").alias("start_frame"), F.lit(1).cast("long").alias("end_frame"),
        F.lit(0.5).alias("confidence"), F.lit(0.0).alias("motion_magnitude"),
    )
    return found.unionByName(lone)


def video_segments(
    frames: DataFrame, high: float = 3.0, low: float = 1.0, least: int = 15, part: str = "session", i: str = "frame"
) -> DataFrame:
    """Action segments of frames as bytes: tracked corners give each frame's magnitude, these the segments.

    The magnitudes are read several times, so they are written once under spark.checkpoint.dir.
    """
    spark = frames.sparkSession
    found, path = flow.magnitudes(frames, part, i), scratch_path(spark, "magnitudes")
    found.write.parquet(path)
    return flow_segments(spark.read.schema(found.schema).parquet(path), high, low, least, part, i, "magnitude")


def gps_stage(
    fixes: DataFrame, fps: float = 30.0, part: str = "session", t: str = "t", tie: str | None = None
) -> DataFrame:
    """Fixes smoothed, with motion, stationarity and tile names, on a frame grid: numbers interpolated (the heading as a
    number), place, segment and stationarity of the last fix."""
    smooth = folds.kalman(fixes, ["lat", "lon"], part, t, tie=tie)
    smooth = smooth.withColumns(
        {"lat": F.col("lat_smooth"), "lon": F.col("lon_smooth")}
    ).drop("lat_smooth", "lon_smooth")
    moved = series.stationary(series.motion(smooth, part, t, tie), part, t, "speed_kmh", tie=tie)
    moved = moved.withColumn("place_name", geo.tile_name(F.col("lat"), F.col("lon")))
    times = series.grid(moved, 1.0 / fps, part, t)
    numbers = series.interpolate(moved, times, ["lat", "lon", "speed_kmh", "heading", "total_m"], part, t, tie=tie)
    kinds = series.as_of(moved, times, ["place_name", "is_stationary", "segment_id"], part, t, tie=tie)
    return numbers.join(kinds.hint("merge"), [part, t])
