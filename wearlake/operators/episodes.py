"""Episodes: per-frame payloads, cutting sessions into episodes, writing, listing and loading them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlake.operators import intervals, series

IMU_WIDTH, GPS_WIDTH, ACTION_WIDTH = 10, 6, 7
MIN_FRAMES = 10


def numbered(rows: DataFrame, order: list[str], name: str, part: str = "session", base: int = 0) -> DataFrame:
    """Adds ``name``: base, base + 1 and so on in the order of each series."""
    return rows.withColumn(
        name, (F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1 + base).cast("long")
    )


def instruction_map(texts: DataFrame, part: str = "session", order: str = "ord") -> DataFrame:
    """(part, segment, instruction) of rows with text and maybe segment_index, which is the row's place where it is
    missing; of several for one segment the last row's."""
    rows = numbered(texts, [order], "_place", part)
    segment = F.coalesce(
        F.col("segment_index").cast("long"), F.col("_place")
    ) if "segment_index" in texts.columns else F.col("_place")
    return rows.groupBy(part, segment.alias("segment")).agg(
        F.max_by(F.coalesce("text", F.lit("")), "_place").alias("instruction")
    )


def cut_episodes(
    segments: DataFrame, lengths: DataFrame, texts: DataFrame, default: str = "", least: int = MIN_FRAMES,
    base: int = 0, part: str = "session",
) -> DataFrame:
    """Episodes of a session's segments (segment, start_frame, end_frame): clamped to the session's ``n_frames``
    (``lengths``), without those under ``least`` frames, numbered from ``base`` in segment order, each with the
    instruction of its segment, which may be empty, else the default."""
    inside = segments.join(lengths.select(part, "n_frames"), part)
    inside = inside.withColumns(
        {"start_frame": F.greatest(F.col("start_frame"), F.lit(0)), "end_frame": F.least("end_frame", "n_frames")}
    ).drop("n_frames")
    kept = inside.filter(F.col("end_frame") - F.col("start_frame") >= least)
    said = numbered(kept, ["segment"], "episode_index", part, base).join(
        instruction_map(texts, part), [part, "segment"], "left"
    )
    return said.withColumn("instruction", F.coalesce("instruction", F.lit(default)))


def episode_frames(episodes: DataFrame, frames: DataFrame, part: str = "session") -> DataFrame:
    """The frames of each episode with episode_index and frame_index, counted from 0 in the episode."""
    inside = intervals.frames_in(episodes.select(part, "episode_index", "start_frame", "end_frame"), frames, part)
    return inside.withColumn("frame_index", F.col("frame") - F.col("start_frame")).drop("start_frame", "end_frame")


def frame_payload(
    frames: DataFrame, imu: DataFrame | None = None, gps: DataFrame | None = None, audio: DataFrame | None = None,
    audio_width: int = 533, part: str = "session",
) -> DataFrame:
    """imu (10 numbers), gps (6), audio (``audio_width``) and action (7) of each (part, frame).

    The others hold rows of (part, frame) with ``values``; what is missing is 0.  Inertial rows of a session count only
    if there are at least as many as frames.  The action is the six inertial values and 0.
    """
    fit = lambda c, width: F.slice(
        F.concat(
            F.coalesce(
                F.transform(
                    F.coalesce(c, F.array().cast("array<double>")), lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
                ),
                F.array().cast("array<double>"),
            ),
            F.array_repeat(F.lit(0.0), width),
        ),
        1, width,
    )
    out = frames
    if imu is not None:
        enough = imu.groupBy(part).agg(F.count("*").alias("_have")).join(
            frames.groupBy(part).agg(F.count("*").alias("_want")), part
        ).filter("_have >= _want").select(part)
        imu = imu.join(enough, part, "left_semi")
    for name, rows in (("imu", imu), ("gps", gps), ("audio", audio)):
        out = out.join(
            rows.select(part, "frame", F.col("values").alias(f"_{name}")), [part, "frame"], "left"
        ) if rows is not None else out.withColumn(f"_{name}", F.lit(None).cast("array<double>"))
    out = out.withColumns(
        {
            "imu": fit(F.slice("_imu", 1, 6), IMU_WIDTH), "gps": fit(F.col("_gps"), GPS_WIDTH),
            "audio": fit(F.col("_audio"), audio_width),
        }
    )
    return out.withColumn("action", F.concat(F.slice("imu", 1, 6), F.array(F.lit(0.0)))).drop("_imu", "_gps", "_audio")


def derive_actions(
    frames: DataFrame, width: int = IMU_WIDTH, part: str | tuple[str, ...] = "session", frame: str = "frame_index"
) -> DataFrame:
    """``action`` (7 numbers) of frames with ``imu``: with 10 columns no move and the change of the quaternion, whose
    first row is the identity less its own; with 6 the angular rates in the last three; else zeros."""
    zero = F.lit(0.0)
    if width >= IMU_WIDTH:
        before = F.lag("imu").over(Window.partitionBy(*([part] if isinstance(part, str) else part)).orderBy(frame))
        turn = [
            F.when(
                before.isNotNull(), F.get("imu", F.lit(k)) - F.get(before, F.lit(k))
            ).otherwise(F.lit(float(k == 9)) - F.get("imu", F.lit(k))) for k in range(6, 10)
        ]
        return frames.withColumn("action", F.array(zero, zero, zero, *turn))
    rates = [F.get("imu", F.lit(k)) for k in range(3, 6)] if width >= 6 else [zero] * 3
    return frames.withColumn("action", F.array(zero, zero, zero, zero, *rates))


def complete_frames(frames: DataFrame, fps: float = 30.0, part: str | tuple[str, ...] = "session") -> DataFrame:
    """Frames as they are written: without ``timestamp`` it is frame_index / fps, without ``gps`` six zeros, without ``action`` it is derived."""
    if "timestamp" not in frames.columns:
        frames = frames.withColumn("timestamp", F.col("frame_index") / F.lit(fps))
    if "gps" not in frames.columns:
        frames = frames.withColumn("gps", F.array_repeat(F.lit(0.0), GPS_WIDTH))
    return frames if "action" in frames.columns else derive_actions(frames, part=part)


#: Beside the partitions of written episodes, where Spark's readers of the data don't look: one row an episode.
LISTING = "_episodes"


def describe_episodes(frames: DataFrame, by: tuple[str, ...] = ("session_id", "episode_index")) -> DataFrame:
    """One row an episode: frames, the first and last timestamp, and the instruction of its first frame that has one
    (empty if none has)."""
    order = F.col("frame_index") if "frame_index" in frames.columns else F.lit(0)
    text, found = F.lit(""), {"frames": F.count("*")}
    if "instruction" in frames.columns:
        said = F.nullif("instruction", F.lit(""))
        text = F.coalesce(F.min_by("instruction", F.when(said.isNotNull(), F.struct(order, said))), F.lit(""))
    if "timestamp" in frames.columns:
        found |= {"first_timestamp": F.min("timestamp"), "last_timestamp": F.max("timestamp")}
    return frames.groupBy(*by).agg(*(v.alias(k) for k, v in found.items()), text.alias("instruction"))


def list_episodes(spark: SparkSession, path: str, by: tuple[str, ...] = ("session_id", "episode_index")) -> DataFrame:
    """(session_id, episode_index, frames, instruction) of written episodes in the order of their index.

    The listing that ``writers.write_episodes`` leaves beside the episodes is read, which costs a row an episode and no
    row of a frame.  Without one the needed columns of the frames are read and damaged files are skipped.
    """
    try:
        rows = spark.read.parquet(f"{path.rstrip('/')}/{LISTING}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(path)
        rows = describe_episodes(rows, by)
    return rows.select(*by, "frames", "instruction").orderBy(by[-1], *by[:-1])


def load_episode(spark: SparkSession, path: str, session_id: str, episode_index: int | None = None) -> DataFrame:
    """The frames of one session, or of one of its episodes, in order; a partition filter, so that nothing else is read."""
    rows = spark.read.parquet(path).filter(F.col("session_id") == session_id)
    if episode_index is not None:
        rows = rows.filter(F.col("episode_index") == episode_index)
    return rows.orderBy(*(["episode_index"] if "episode_index" in rows.columns else []), "frame_index")


def frame_index(episodes: DataFrame, key: str = "path") -> DataFrame:
    """(key, frame) of every frame of episodes with a number of ``frames``, in the order of the key."""
    return series.numbered(episodes.select(key, "frames"), F.lit(0), F.col("frames") - 1, "frame").drop("frames")


def key_frames(segments: DataFrame, most: int, part: str = "session") -> DataFrame:
    """The middle frame of each of the first ``most`` segments of a session, ascending."""
    first = numbered(segments, ["segment"], "_n", part).filter(F.col("_n") < most)
    return first.select(
        part, "segment", F.floor((F.col("start_frame") + F.col("end_frame")) / 2).cast("long").alias("frame")
    )


def even_frames(lengths: DataFrame, most: int, part: str = "session") -> DataFrame:
    """Without segments: every max(1, n_frames // most)-th frame, the first ``most`` of them."""
    step = F.greatest(F.lit(1), F.floor(F.col("n_frames") / most))
    last = F.least(F.floor((F.col("n_frames") - 1) / step), F.lit(most - 1))
    placed = lengths.select(part, step.cast("long").alias("_step"), last.alias("_last"))
    return series.numbered(placed, F.lit(0), F.col("_last"), "_k").select(part, (F.col("_k") * F.col("_step")).alias("frame"))


def best_checkpoint(runs: DataFrame, part: str = "run", loss: str = "val_loss", order: str = "epoch") -> DataFrame:
    """The row of least loss of each run, the earliest of equals; a null or NaN loss is never best."""
    good = runs.filter(F.col(loss).isNotNull() & ~F.isnan(loss))
    best = good.groupBy(part).agg(F.min_by(F.struct(*good.columns), F.struct(loss, order)).alias("_b"))
    return best.select("_b.*")
