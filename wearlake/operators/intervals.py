"""Interval joins by time buckets, so that they are equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlake.operators import series


def overlaps(left: DataFrame, right: DataFrame, width: float, part: str = "session", least: float = 0.0) -> DataFrame:
    """Pairs of (l_start, l_end) and (r_start, r_end) rows that overlap by more than ``least``; overlap is added.

    Both sides go to all buckets of ``width`` they touch; a pair counts in the
    bucket where its overlap begins.
    """
    cells = lambda df, a, b: series.numbered(
        df, F.floor(F.col(a) / width), F.floor(F.greatest(F.col(a), F.col(b)) / width), "_cell"
    )
    pairs = cells(left, "l_start", "l_end").join(cells(right, "r_start", "r_end"), [part, "_cell"])
    begin = F.greatest("l_start", "r_start")
    pairs = pairs.withColumn("overlap", F.least("l_end", "r_end") - begin)
    return pairs.filter((F.col("overlap") > least) & (F.col("_cell") == F.floor(begin / width))).drop("_cell")


def overlap_text(
    left: DataFrame, right: DataFrame, key: list[str], width: float, part: str = "session", least: float = 0.1
) -> DataFrame:
    """Every left row with the trimmed texts of right rows overlapping it, in their order (ord)."""
    found = overlaps(left, right, width, part, least).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("ord", F.trim("text").alias("text")))).alias("_t")
    )
    text = F.array_join(F.transform("_t", lambda x: x["text"]), " ")
    return left.join(found, key, "left").withColumn("text", F.coalesce(text, F.lit(""))).drop("_t")


def best_overlap(
    left: DataFrame, right: DataFrame, key: list[str], width: float, default: str, part: str = "session"
) -> DataFrame:
    """Every left row with the text of the right row that overlaps it most, the first of equals; else the default."""
    w = Window.partitionBy(*key).orderBy(F.desc("overlap"), "ord")
    best = overlaps(left, right, width, part).withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(
        *key, F.nullif(F.trim("text"), F.lit("")).alias("text")
    )
    return left.join(best, key, "left").withColumn("text", F.coalesce("text", F.lit(default)))


def frames_in(segments: DataFrame, frames: DataFrame, part: str = "session") -> DataFrame:
    """Frames of each half-open segment, as an equi-join on the frame number."""
    wide = series.numbered(segments, F.col("start_frame"), F.col("end_frame") - 1, "frame")
    return wide.join(frames, [part, "frame"])


def window_rows(frames: DataFrame, order: str, value: str, count: int, part: str = "session") -> DataFrame:
    """``count`` values from each row on in the order of its series, zero-padded, in ``window``: each row is a sample,
    and no array of the whole series stands at every row."""
    w = Window.partitionBy(part).orderBy(order)
    return frames.withColumn(
        "window", F.array(*(F.col(value) if k == 0 else F.lead(value, k, 0.0).over(w) for k in range(count)))
    )


def sample_blocks(audio: DataFrame, size: int = 16_000, part: str = "session", samples: str = "samples") -> DataFrame:
    """(part, block, samples): arrays of samples cut into blocks of ``size``."""
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(samples), F.lit(1)) - 1) / size).cast("int")),
        lambda k: F.slice(samples, (k * size + 1).cast("int"), size),
    )
    return audio.select(part, F.posexplode(F.filter(cut, lambda x: F.size(x) > 0)).alias("block", "samples"))


def block_windows(
    rows: DataFrame, blocks: DataFrame, start: str, count: int, key: list[str], size: int = 16_000,
    part: str = "session",
) -> DataFrame:
    """rows with ``window``: ``count`` samples from index ``start`` (negative: from 0), zero-padded; key names a row.

    A row meets only the blocks that its window touches, by an equi-join, so that a whole recording is never beside
    each of its rows; it carries its other columns along, so that rows are made once.
    """
    at = F.greatest(F.col(start), F.lit(0)).cast("long")
    others = [c for c in rows.columns if c not in key]
    begun = rows.select(*key, F.struct(*others).alias("_row"), at.alias("_at"))
    wide = series.numbered(begun, F.floor(F.col("_at") / size), F.floor((F.col("_at") + count - 1) / size), "block")
    first = F.greatest(F.col("_at") - F.col("block") * size, F.lit(0))
    end = F.least(F.col("_at") + count - F.col("block") * size, F.lit(size))
    parts = wide.join(blocks, [part, "block"], "left").select(
        *key, "_row", "block", F.slice("samples", (first + 1).cast("int"), (end - first).cast("int")).alias("_x")
    )
    held = F.filter(F.array_sort(F.collect_list(F.struct("block", "_x"))), lambda b: b["_x"].isNotNull())
    joined = parts.groupBy(*key).agg(F.first("_row").alias("_row"), F.flatten(F.transform(held, lambda b: b["_x"])).alias("_w"))
    found = joined.select(*(F.col(c) if c in key else F.col("_row")[c].alias(c) for c in rows.columns), "_w")
    whole = F.concat(
        F.coalesce(F.col("_w").cast("array<double>"), F.array().cast("array<double>")),
        F.array_repeat(F.lit(0.0), count),
    )
    return found.withColumn("window", F.slice(whole, 1, count)).drop("_w")
