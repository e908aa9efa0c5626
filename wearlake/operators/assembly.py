"""Chunk assembly: coverage, gaps, concatenation, session identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlake.operators import series


def missing_runs(chunks: DataFrame, part: str = "session", i: str = "chunk") -> DataFrame:
    """(after_chunk, missing) of every hole in the chunk numbers."""
    after = F.lead(i).over(Window.partitionBy(part).orderBy(i))
    return chunks.select(
        part, F.col(i).alias("after_chunk"), (after - F.col(i) - 1).alias("missing")
    ).filter("missing > 0")


def time_gaps(
    chunks: DataFrame, most: float = 5.0, length: float = 30.0, part: str = "session", i: str = "chunk"
) -> DataFrame:
    """Chunks that start over ``most`` seconds after the one before ends; a missing end is start + ``length``; a chunk
    without a start is skipped."""
    known = chunks.filter(F.col("start_time").isNotNull()).withColumn(
        "_end", F.coalesce("end_time", F.col("start_time") + length)
    )
    gap = F.col("start_time") - F.lag("_end").over(Window.partitionBy(part).orderBy(i))
    return known.withColumn("gap", gap).filter(F.col("gap") > most).select(part, i, "gap")


def coverage(
    chunks: DataFrame, length: float = 30.0, fps: float = 30.0, part: str = "session", i: str = "chunk"
) -> DataFrame:
    """Found and missing chunks between the first and last, percent, frames and seconds (from the times,
    else by number), and the holes."""
    n, span = F.countDistinct(i), F.max(i) - F.min(i) + 1
    seconds = F.coalesce(F.max("end_time") - F.min("start_time"), n * F.lit(length))
    out = chunks.groupBy(part).agg(
        n.alias("found"), (span - n).alias("missing"), F.round(100 * n / span, 2).alias("percent"),
        seconds.alias("seconds"),
    )
    holes = missing_runs(chunks, part, i).groupBy(part).agg(
        F.array_sort(F.collect_list(F.struct("after_chunk", "missing"))).alias("gaps")
    )
    empty = F.array().cast(holes.schema["gaps"].dataType)
    return out.withColumn(
        "frames", F.floor(F.col("seconds") * fps)
    ).join(holes, part, "left").withColumn("gaps", F.coalesce("gaps", empty))


def absent_chunks(chunks: DataFrame, part: str = "session", i: str = "chunk") -> DataFrame:
    """Chunk numbers expected between first and last but not there."""
    ends = chunks.groupBy(part).agg(F.min(i).alias("a"), F.max(i).alias("b"))
    expected = series.numbered(ends, F.col("a"), F.col("b"), i).select(part, i)
    return expected.join(chunks.select(part, i), [part, i], "left_anti")


def common_chunks(left: DataFrame, right: DataFrame, part: str = "session", i: str = "chunk") -> DataFrame:
    """Chunks that both have, once each."""
    return left.select(part, i).intersect(right.select(part, i))


def path_list(parts: list[DataFrame]) -> DataFrame:
    """Paths of several listings, each in its own order and one listing after the other."""
    out = parts[0].select("path", F.lit(0).alias("listing"))
    for k, p in enumerate(parts[1:], 1):
        out = out.unionAll(p.select("path", F.lit(k).alias("listing")))
    return out.orderBy("listing", "path")


def video_manifest(chunks: DataFrame, part: str = "session", i: str = "chunk") -> DataFrame:
    """(part, order, path) of the video files to join, in chunk order."""
    return chunks.select(
        part, (F.row_number().over(Window.partitionBy(part).orderBy(i)) - 1).alias("order"),
        F.col("video").alias("path"),
    )


def series_of_chunks(
    rows: DataFrame, part: str = "session", t: str = "timestamp", order: tuple[str, ...] = ("chunk", "row")
) -> DataFrame:
    """The rows of all chunks of a session, of one time only the first by chunk and row."""
    return series.first_by_time(rows, [part, t], list(order))


def assemble(chunks: DataFrame, length: float = 30.0, part: str = "session", i: str = "chunk") -> DataFrame:
    """One row per session of chunks (chunk, session_id, start_time, end_time): name, number and list of chunks, seconds
    (from the earliest start to the latest end, else ``length`` a chunk), holes in the numbers and in time.

    Sessions without chunks have no row.
    """
    named = session_name(chunks.withColumn("_folder", F.col(part).cast("string")), "_folder", part, i)
    seconds = F.coalesce(F.max("end_time") - F.min("start_time"), F.countDistinct(i) * F.lit(length))
    whole = chunks.groupBy(part).agg(
        F.countDistinct(i).alias("chunk_count"), F.array_sort(F.collect_set(i)).alias("chunk_indices"),
        seconds.alias("seconds"),
    )
    holes = missing_runs(
        chunks.select(part, i).distinct(), part, i
    ).groupBy(part).agg(F.sum("missing").alias("missing"))
    late = time_gaps(chunks, length=length, part=part, i=i).groupBy(part).agg(F.count("*").alias("late"))
    joined = whole.join(named, part).join(holes, part, "left").join(late, part, "left")
    return joined.withColumns({"missing": F.coalesce("missing", F.lit(0)), "late": F.coalesce("late", F.lit(0))})


def concat_frames(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts by column name; columns missing in a part are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def concat_audio(chunks: DataFrame, part: str = "session", i: str = "chunk") -> DataFrame:
    """One array of samples per session in chunk order, without chunks of another rate than the first, scaled to a peak of 1."""
    first = F.first("rate").over(Window.partitionBy(part).orderBy(i))
    same = chunks.withColumn("_r", first).filter(F.col("rate") == F.col("_r"))
    joined = same.groupBy(part).agg(
        F.min("rate").alias("rate"),
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct(i, "samples"))), lambda x: x["samples"])
        ).alias("samples"),
    )
    top = F.array_max(F.transform("samples", F.abs))
    return joined.withColumn(
        "samples", F.when(top > 0, F.transform("samples", lambda x: x / top)).otherwise(F.col("samples"))
    )


def placed_audio(chunks: DataFrame, part: str = "session", i: str = "chunk") -> DataFrame:
    """(part, i, rate, first, samples): what ``concat_audio`` joins, left in its chunks: ``first`` is the place of a chunk's
    first sample in the whole, and samples are scaled to the session's peak of 1.

    Chunks of another rate than the first are left out, as are chunks without samples.  Numbers must differ inside a
    session.  Only a chunk's length and peak pass a window of the session, so a recording of any length is many tasks.
    """
    of = lambda c: F.col(c).alias(f"_{c}")
    told = chunks.select(
        of(part), of(i), of("rate"), F.size("samples").cast("long").alias("_n"),
        F.array_max(F.transform("samples", F.abs)).alias("_peak"),
    ).filter("_n > 0")
    w = Window.partitionBy(f"_{part}")
    rate = F.min_by("_rate", f"_{i}").over(w)
    told = told.withColumn("_first_rate", rate).filter("_rate = _first_rate")
    before = F.sum("_n").over(w.orderBy(f"_{i}").rowsBetween(Window.unboundedPreceding, -1))
    told = told.withColumns({"first": F.coalesce(before, F.lit(0).cast("long")), "_top": F.max("_peak").over(w)})
    both = chunks.join(told, F.col(part).eqNullSafe(F.col(f"_{part}")) & (F.col(i) == F.col(f"_{i}")))
    scaled = F.when(F.col("_top") > 0, F.transform("samples", lambda x: x / F.col("_top"))).otherwise(F.col("samples"))
    return both.select(part, i, "rate", "first", scaled.alias("samples"))


def session_name(chunks: DataFrame, fallback: str, part: str = "folder", i: str = "chunk") -> DataFrame:
    """The first non-empty session_id in chunk order, else the fallback column."""
    named = F.min_by(F.nullif("session_id", F.lit("")), F.when(F.nullif("session_id", F.lit("")).isNotNull(), F.col(i)))
    return chunks.groupBy(part).agg(F.coalesce(named, F.first(fallback)).alias("session_id"))
