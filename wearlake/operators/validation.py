"""Episode validation: an array of errors per episode, and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUIRED = ("image", "audio", "imu", "action", "instruction", "frame_index", "timestamp")
MIN_FRAMES, MIN_SIDE, MAX_SIDE, ACTION_MOST = 5, 32, 1920, 100.0


def _bad(x: Column) -> Column:
    return F.exists(x, lambda v: F.isnan(v))


def errors(episodes: DataFrame) -> DataFrame:
    """Adds ``errors``, an array of (check, detail), to episodes with frames, has_<dataset> flags, height, width,
    channels, <modality>_rows, instruction and action_values (an array of doubles).  A row with ``open_error`` (the
    column may be missing) has that error alone."""
    error = lambda when, check, detail: F.when(when, F.struct(F.lit(check).alias("check"), detail.alias("detail")))
    values = F.coalesce("action_values", F.array().cast("array<double>"))
    checks = [error(~F.coalesce(f"has_{d}", F.lit(False)), "missing_dataset", F.lit(d)) for d in REQUIRED]
    checks.append(error(F.col("frames") < MIN_FRAMES, "min_frames", F.col("frames").cast("string")))
    checks.append(error(~F.col("channels").isin(1, 3, 4), "channels", F.col("channels").cast("string")))
    for side in ("height", "width"):
        checks.append(error(~F.col(side).between(MIN_SIDE, MAX_SIDE), side, F.col(side).cast("string")))
    for m in ("audio", "imu", "action"):
        checks.append(
            error(
                F.col(f"{m}_rows") != F.col("frames"), "alignment",
                F.concat(F.lit(f"{m}:"), F.col(f"{m}_rows").cast("string")),
            )
        )
    checks.append(error(F.trim(F.coalesce("instruction", F.lit(""))) == "", "instruction", F.lit("empty")))
    checks.append(
        error(
            F.exists(values, lambda v: ~F.isnan(v) & (F.abs(v) > ACTION_MOST) & (F.abs(v) != float("inf"))),
            "action_range", F.lit("over limit"),
        )
    )
    checks.append(error(_bad(values), "nan", F.lit("action")))
    checks.append(error(F.exists(values, lambda v: F.abs(v) == float("inf")), "inf", F.lit("action")))
    found = F.array_compact(F.array(*checks))
    if "open_error" in episodes.columns:
        found = F.when(
            F.col("open_error").isNotNull(),
            F.array(F.struct(F.lit("open_file").alias("check"), F.col("open_error").alias("detail"))),
        ).otherwise(found)
    return episodes.withColumn("errors", found)


def validate(episodes: DataFrame) -> DataFrame:
    """(path, check, detail) of every error."""
    return errors(episodes).select("path", F.explode("errors").alias("e")).select("path", "e.check", "e.detail")


def report(episodes: DataFrame) -> DataFrame:
    """total, valid and invalid episodes, and the number of errors, in one pass."""
    n = F.size("errors")
    return errors(episodes).agg(
        F.count("*").alias("total"), F.count_if(n == 0).alias("valid"), F.count_if(n > 0).alias("invalid"),
        F.coalesce(F.sum(n), F.lit(0)).alias("errors"),
    )


def episode_files(files: DataFrame) -> DataFrame:
    """Of (session, path): a session's episodes/episode_*.h5 files, of a session without any all its .h5 files."""
    named = files.filter(F.col("path").rlike(r"\.h5$")).withColumn(
        "_named", F.col("path").rlike(r"/episodes/episode_[^/]*\.h5$")
    )
    any_ = named.groupBy("session").agg(F.max("_named").alias("_any"))
    return named.join(any_, "session").filter(F.col("_named") == F.col("_any")).drop("_named", "_any")
