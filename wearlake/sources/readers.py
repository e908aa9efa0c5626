"""Readers with declared schemas: sensor CSV, session JSON, WAV, chunk folders, episodes."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

IMU = "timestamp double, accel_x double, accel_y double, accel_z double, gyro_x double, gyro_y double, gyro_z double"
GPS_DEFAULTS = {"alt": 0.0, "speed_kmh": 0.0, "heading": 0.0, "fix_quality": 1, "num_satellites": 0}
SESSION = "session_id string, start_time double, end_time double, video_fps double, audio_sample_rate int, imu_hz double, video_frames long, audio_samples long, imu_samples long, data_dir string, language string"


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing columns are added, nulls filled."""
    for c, v in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
    return df


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    gone = [c for c in columns if c not in df.columns]
    if gone:
        raise ValueError(f"missing columns: {', '.join(gone)}")
    return df


def _numbers(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, header=True)
    return raw.select(*(F.col(f"`{c}`").try_cast("double").alias(c) for c in raw.columns))


def read_imu(spark: SparkSession, path: str, degrees: bool = False) -> DataFrame:
    """The seven inertial columns; missing ones are 0; ordered by time; rates in degrees become radians."""
    df = with_defaults(
        require(_numbers(spark, path), ["timestamp"]), {c.split()[0]: 0.0 for c in IMU.split(", ")[1:]}
    ).select(*(c.split()[0] for c in IMU.split(", ")))
    if degrees:
        df = df.withColumns({c: F.radians(c) for c in ("gyro_x", "gyro_y", "gyro_z")})
    return df.orderBy("timestamp")


def read_gps(spark: SparkSession, path: str) -> DataFrame:
    """Fixes ordered by time; timestamp, lat and lon are required, the rest has defaults."""
    return with_defaults(require(_numbers(spark, path), ["timestamp", "lat", "lon"]), GPS_DEFAULTS).orderBy("timestamp")


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Every metadata.json below a folder."""
    return spark.read.schema(SESSION).option("multiLine", True).option("recursiveFileLookup", True).option(
        "pathGlobFilter", "metadata.json"
    ).json(path)


def find_session(spark: SparkSession, path: str, session_id: str) -> DataFrame:
    """The metadata of one session below a folder; none is an empty result."""
    return read_sessions(spark, path).filter(F.col("session_id") == session_id)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """A processed series that ``writers.write_processed`` wrote."""
    return spark.read.parquet(path)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Labelling tasks with their annotations, as exported in JSON arrays or lines; the results stay JSON texts."""
    note = "struct<was_cancelled:boolean,result:string,completed_by:string,created_at:string>"
    data = "struct<session_id:string,frame_index:long,segment_index:long,start_frame:long,end_frame:long>"
    return spark.read.schema(f"id long, data {data}, annotations array<{note}>").option("multiLine", True).json(path)


def read_damaged(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Episode descriptions in JSON with ``path`` and ``open_error``, which names what can't be parsed, for validation.errors."""
    df = spark.read.schema(f"{schema}, _damaged string").option("multiLine", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_damaged"
    ).json(path)
    return df.withColumns(
        {
            "path": F.col("_metadata.file_path"),
            "open_error": F.when(F.col("_damaged").isNotNull(), F.lit("cannot be parsed")),
        }
    ).drop("_damaged")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents; damaged ones and missing files are skipped."""
    df = spark.read.schema(f"{schema}, _damaged string").option("multiLine", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_damaged"
    ).option("ignoreMissingFiles", True).json(path)
    return df.filter("_damaged is null").drop("_damaged")


def decode_wav(raw: bytes) -> tuple[int, np.ndarray]:
    """(rate, mono samples in [-1, 1]) of 8, 16, 24 or 32-bit PCM; channels are averaged."""
    with wave.open(io.BytesIO(raw)) as w:
        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        data = w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(data, np.uint8).astype(np.float64) - 128) / 128
    elif width in (2, 4):
        x = np.frombuffer(data, f"<i{width}").astype(np.float64) / float(1 << (8 * width - 1))
    elif width == 3:
        b = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        raise ValueError(f"unsupported sample width {width}")
    return rate, x.reshape(-1, channels).mean(axis=1)


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """16-bit mono WAV of samples clipped to [-1, 1]."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def read_wav(spark: SparkSession, path: str) -> DataFrame:
    """(path, rate, samples) of WAV files."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            got = [decode_wav(c) for c in p["content"]]
            yield pd.DataFrame(
                {"path": p["path"], "rate": [r for r, _ in got], "samples": [x.astype(np.float32) for _, x in got]}
            )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(
        run, "path string, rate int, samples array<float>"
    )


def read_frame_times(
    spark: SparkSession, path: str | None, frames: int = 0, fps: float = 30.0, start: float = 0.0
) -> DataFrame:
    """Frame times of a CSV (frame_index, timestamp), without one as ``frame_times``."""
    if path is None:
        return frame_times(spark, frames, fps, start)
    rows = require(_numbers(spark, path), ["timestamp"])
    if "frame_index" not in rows.columns:
        raise ValueError("missing columns: frame_index")
    return rows.select(F.col("frame_index").cast("long"), "timestamp").orderBy("frame_index")


def frame_times(spark: SparkSession, frames: int, fps: float, start: float = 0.0) -> DataFrame:
    """frame_index and timestamp start + i / fps; no frames is an error."""
    if frames <= 0:
        raise ValueError("no frames")
    return spark.range(frames).select(
        F.col("id").alias("frame_index"), (F.lit(start) + F.col("id") / F.lit(fps)).alias("timestamp")
    )


def list_chunks(spark: SparkSession, base: str) -> DataFrame:
    """(chunk, nested): chunks/chunk_NNNN folders with a video win over flat video_NNNN.mp4 files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select(F.col("path"))
    found = files.select(
        F.regexp_extract("path", r"/chunks/chunk_(\d{4})/video_\d{4}\.mp4$", 1).alias("n"),
        F.regexp_extract("path", r"(?<!/chunks/chunk_\d{4})/video_(\d{4})\.mp4$", 1).alias("f"),
    )
    found = found.select(
        F.when(F.col("n") != "", F.col("n")).otherwise(F.nullif("f", F.lit(""))).cast("int").alias("chunk"),
        (F.col("n") != "").alias("nested"),
    ).filter("chunk is not null")
    wins = found.agg(F.max("nested").alias("any")).first()["any"]
    return found.filter(F.col("nested") == F.lit(bool(wins))).distinct().orderBy("chunk")


def chunk_paths(df: DataFrame, base: str) -> DataFrame:
    """The five files of each chunk."""
    n = F.format_string("%04d", "chunk")
    folder = F.when(F.col("nested"), F.concat(F.lit(f"{base}/chunks/chunk_"), n)).otherwise(F.lit(base))
    roles = {
        "video": "video_%s.mp4", "audio": "audio_%s.wav", "imu": "imu_%s.csv", "gps": "gps_%s.csv",
        "meta": "chunk_meta_%s.json",
    }
    return df.select("chunk", *(F.concat(folder, F.lit("/"), F.format_string(p, n)).alias(r) for r, p in roles.items()))


def raw_imu(df: DataFrame) -> DataFrame:
    """int16 counts of a +-2 g, +-250 degrees/s device to m/s^2 and rad/s."""
    return df.withColumns(
        {c: F.col(c) / 16384.0 * 9.81 for c in ("accel_x", "accel_y", "accel_z")}
        | {c: F.radians(F.col(c) / 131.0) for c in ("gyro_x", "gyro_y", "gyro_z")}
    )


def synthetic_imu(
    spark: SparkSession, sessions: int, rows: int, rate: float = 100.0, seed: int = 1, start: float = 1_700_000_000.0
) -> DataFrame:
    """(session_id, timestamp, six channels) of sensors at rest with noise, the same for the same seed and partitions."""
    noise = lambda k, mean, size: mean + F.randn(seed + k) * size
    at = F.lit(start) + (F.col("id") % rows) / F.lit(rate)
    name = F.format_string("session_%04d", F.floor(F.col("id") / rows))
    return spark.range(sessions * rows).select(
        name.alias(
            "session_id"
        ), at.alias("timestamp"), noise(0, 0.0, 0.3).alias("accel_x"), noise(1, 0.0, 0.3).alias("accel_y"), noise(
            2, 9.81, 0.1
        ).alias("accel_z"),
        *(noise(3 + k, 0.0, 0.05).alias(c) for k, c in enumerate(("gyro_x", "gyro_y", "gyro_z"))),
    )


def synthetic_gps(
    spark: SparkSession, sessions: int, rows: int, seed: int = 1, start: float = 1_700_000_000.0, lat: float = 12.97,
    lon: float = 77.59,
) -> DataFrame:
    """(session_id, timestamp, lat, lon, speed_kmh, heading) of random walks at one fix a second: the heading changes by
    5 degrees and the speed by 2 km/h (never below 0) of deviation each."""
    base = spark.range(sessions * rows).select(
        F.format_string("session_%04d", F.floor(F.col("id") / rows)).alias("session_id"),
        (F.col("id") % rows).alias("_k"), F.randn(seed).alias("_h"), F.randn(seed + 1).alias("_v"),
    )
    w = Window.partitionBy("session_id").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.pmod(F.sum(F.col("_h") * 5).over(w) + 360, F.lit(360.0))
    # a walk that never goes below 0 is the free walk less its lowest point so far
    free = base.withColumn("_free", F.lit(10.0) + F.sum(F.col("_v") * 2).over(w)).withColumn("heading", heading)
    moved = free.withColumn("speed_kmh", F.col("_free") - F.least(F.lit(0.0), F.min("_free").over(w)))
    step = F.col("speed_kmh") / 3.6 / 111_320.0
    north, east = F.sum(
        step * F.cos(F.radians("heading"))
    ).over(w), F.sum(step * F.sin(F.radians("heading"))).over(w) / math.cos(math.radians(lat))
    return moved.select(
        "session_id", (F.lit(start) + F.col("_k")).alias("timestamp"), (F.lit(lat) + north).alias("lat"),
        (F.lit(lon) + east).alias("lon"), "speed_kmh", "heading",
    )


def decode_video(df: DataFrame, decoder=None) -> DataFrame:
    """Frames of binary videos through an injected Arrow function; none is part of this package."""
    if decoder is None:
        raise NotImplementedError(
            "video decoding needs a decoder: a mapInPandas function from (path, content) to (path, frame_index, timestamp, image)"
        )
    return df.mapInPandas(decoder, "path string, frame_index long, timestamp double, image binary")


def parse_nmea(lines: DataFrame, column: str = "line") -> DataFrame:
    """Fields of RMC (status A) and GGA sentences: kind, utc, lat, lon, speed_kmh, heading, alt, fix_quality, num_satellites."""
    p = F.split(F.regexp_replace(column, r"\*.*$", ""), ",")
    at = lambda k: F.nullif(F.get(p, F.lit(k)), F.lit(""))
    kind = F.substring(F.get(p, F.lit(0)), -3, 3)
    angle = lambda v, side, width: (
        F.substring(v, 1, width).try_cast("double") + F.expr("0") + F.substring(
            v, width + 1, 20
        ).try_cast("double") / 60
    ) * F.when(side.isin("S", "W"), -1.0).otherwise(1.0)
    rmc = kind == "RMC"
    pick = lambda a, b: F.when(rmc, at(a)).otherwise(at(b))
    return lines.filter((rmc & (at(2) == "A")) | (kind == "GGA")).select(
        "*", kind.alias("kind"), at(1).alias("utc"), angle(
            pick(3, 2), pick(4, 3), 2
        ).alias("lat"), angle(pick(5, 4), pick(6, 5), 3).alias("lon"),
        F.when(
            rmc, at(7).try_cast("double") * 1.852
        ).alias("speed_kmh"), F.when(rmc, at(8).try_cast("double")).alias("heading"),
        F.when(
            ~rmc, at(9).try_cast("double")
        ).alias("alt"), F.when(
            ~rmc, at(6).try_cast("int")
        ).alias("fix_quality"), F.when(~rmc, at(7).try_cast("int")).alias("num_satellites"),
    )
