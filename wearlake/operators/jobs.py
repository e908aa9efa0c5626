"""Background jobs as a table of states: the latest state of a job counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ("queued", "running", "done", "failed")


def queue_jobs(sessions: DataFrame, at: str = "now") -> DataFrame:
    """A queued job for each (job_id, session_id): status and stage queued, no progress, no error; ``at`` is its time column."""
    return sessions.select(
        "job_id", "session_id", F.lit("queued").alias("status"), F.lit("queued").alias("stage"), F.lit(0.0).alias(
            "progress_pct"
        ), F.lit(None).cast("string").alias("error"),
        F.col(at).alias("created_at"), F.col(at).alias("updated_at"),
    )


def advance(jobs: DataFrame, updates: DataFrame) -> DataFrame:
    """Jobs after updates (job_id, updated_at and any of status, stage, progress_pct, error): of each column the latest value that isn't
    null counts; updates of unknown jobs are left out."""
    columns = [c for c in ("status", "stage", "progress_pct", "error") if c in updates.columns]
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("updated_at"))).alias(f"_{c}")
    told = updates.groupBy("job_id").agg(*(latest(c) for c in columns), F.max("updated_at").alias("_at"))
    joined = jobs.join(told, "job_id", "left")
    return joined.withColumns(
        {c: F.coalesce(f"_{c}", c) for c in columns} | {"updated_at": F.coalesce("_at", "updated_at")}
    ).drop("_at", *(f"_{c}" for c in columns))
