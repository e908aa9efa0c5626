"""Recognised speech: cleaning, confidence, texts of segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import formats


def clean(parts: DataFrame, language: str = "?") -> DataFrame:
    """Recognised parts (text, start, end, language, n_tokens, avg_logprob) with trimmed text and confidence; blank ones go."""
    out = parts.withColumns(
        {
            "text": F.trim("text"), "language": F.coalesce("language", F.lit(language)),
            "confidence": formats.confidence(F.col("n_tokens"), F.col("avg_logprob")),
        }
    )
    return out.filter(F.coalesce("text", F.lit("")) != "").drop("n_tokens", "avg_logprob")


def by_segment(
    segments: DataFrame, parts: DataFrame, key: list[str], order: str = "ord", language: str = "?"
) -> DataFrame:
    """Segments with the joined texts of their parts (same key), the mean confidence (0 without parts) and the first part's language."""
    told = parts.groupBy(*key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"]), " "
        ).alias("text"),
        F.avg("confidence").alias("confidence"), F.min_by("language", order).alias("language"),
    )
    joined = segments.join(told, key, "left")
    return joined.withColumns(
        {
            "text": F.coalesce("text", F.lit("")), "confidence": F.coalesce("confidence", F.lit(0.0)),
            "language": F.coalesce("language", F.lit(language)),
        }
    )


def speech_slices(segments: DataFrame, rate: int) -> DataFrame:
    """first_sample and end_sample of segments in seconds, cut to whole numbers, for intervals.block_windows."""
    return segments.withColumns(
        {"first_sample": (F.col("start") * rate).cast("long"), "end_sample": (F.col("end") * rate).cast("long")}
    )


def records(parts: DataFrame) -> DataFrame:
    """Parts as they are written: times to 3 and the confidence to 4 places."""
    return parts.withColumns(formats.rounded({"start": 3, "end": 3, "confidence": 4}))


def transcription(parts: DataFrame, part: str = "session", order: str = "ord") -> DataFrame:
    """(part, text, language, segments): a session's whole text, its first part's language (? without) and its parts (text,
    start, end) in order; sessions without parts have no row."""
    ordered = F.array_sort(F.collect_list(F.struct(order, "text", "start", "end")))
    whole = parts.groupBy(part).agg(
        ordered.alias("_p"), F.coalesce(F.min_by("language", order), F.lit("?")).alias("language")
    )
    segments = F.transform(
        "_p", lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), x["end"].alias("end"))
    )
    return whole.select(
        part, F.array_join(F.transform("_p", lambda x: x["text"]), " ").alias("text"), "language",
        segments.alias("segments"),
    )
