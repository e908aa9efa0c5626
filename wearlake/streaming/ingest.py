"""Chunk ingest as Structured Streaming: landing folder, idempotent queue, counters, pairing, finalisation."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

log = logging.getLogger(__name__)

ROLES = ("video", "audio", "imu", "gps", "meta")
FILE = "session_id string, chunk_index int, role string, path string, received timestamp"


def landed(spark: SparkSession, path: str) -> DataFrame:
    """A stream of arrival records (JSON lines) of a landing folder."""
    return spark.readStream.schema(FILE).json(path)


def complete_chunks(files: DataFrame, late: str = "1 hour") -> DataFrame:
    """Chunks of which all five files have arrived, once each, with the arrival of the one that made them complete.

    Each chunk's state is five flags, exact whatever is sent twice or has another role, and a mark that it was given
    out; it goes when the watermark is ``late`` beyond its last file.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        have, done = state.get if state.exists else (0, False)
        latest = None
        for p in parts:
            for role in p["role"].unique():
                if role in ROLES:
                    have |= 1 << ROLES.index(role)
            latest = p["received"].max() if latest is None else max(latest, p["received"].max())
        complete = have == (1 << len(ROLES)) - 1
        state.update((have, done or complete))
        state.setTimeoutTimestamp(max(int(latest.timestamp() * 1000), state.getCurrentWatermarkMs()) + 1)
        if complete and not done:
            yield pd.DataFrame({"session_id": [key[0]], "chunk_index": [key[1]], "received": [latest]})

    keyed = files.withWatermark("received", late).groupBy("session_id", "chunk_index")
    return keyed.applyInPandasWithState(
        run, "session_id string, chunk_index int, received timestamp", "have int, done boolean", "append",
        "EventTimeTimeout",
    )


def queued(chunks: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each (session, chunk) once, however often it is sent."""
    return chunks.withWatermark("received", late).dropDuplicatesWithinWatermark(["session_id", "chunk_index"])


def session_counters(chunks: DataFrame) -> DataFrame:
    """received (re-sends count) and the largest chunk index per session."""
    return chunks.groupBy("session_id").agg(F.count("*").alias("received"), F.max("chunk_index").alias("max_chunk"))


def latest_fix(fixes: DataFrame) -> DataFrame:
    return fixes.groupBy("session_id").agg(
        F.max_by(F.struct("lat", "lon"), "timestamp").alias("fix"), F.max("timestamp").alias("timestamp")
    )


def tumbling(samples: DataFrame, ts: str, value: str, width: str = "30 seconds", late: str = "10 seconds") -> DataFrame:
    """Counts and means per session and fixed window."""
    w = samples.withWatermark(ts, late).groupBy("session_id", F.window(ts, width).alias("w")).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean")
    )
    return w.select("session_id", F.col("w.start").alias("start"), "n", "mean")


def pair_sentences(rows: DataFrame, key: str = "session_id") -> DataFrame:
    """Fixes from the latest RMC and the latest GGA of a session, both cleared after each pair."""
    out = f"{key} string, utc string, lat double, lon double, speed_kmh double, heading double, alt double, fix_quality int, num_satellites int"
    fields = ["utc", "lat", "lon", "speed_kmh", "heading"], ["alt", "fix_quality", "num_satellites"]

    def run(group: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rmc, gga = (list(x) if x is not None else None for x in (state.get if state.exists else (None, None)))
        made = []
        for p in parts:
            for r in p.sort_values("seq").itertuples(index=False):
                if r.kind == "RMC":
                    rmc = [getattr(r, f) for f in fields[0]]
                else:
                    gga = [getattr(r, f) for f in fields[1]]
                if rmc is not None and gga is not None:
                    made.append([group[0], *rmc, *gga])
                    rmc = gga = None
        state.update((tuple(rmc) if rmc is not None else None, tuple(gga) if gga is not None else None))
        yield pd.DataFrame(made, columns=[key, *fields[0], *fields[1]])

    store = "rmc struct<utc:string,lat:double,lon:double,speed_kmh:double,heading:double>, gga struct<alt:double,fix_quality:int,num_satellites:int>"
    return rows.groupBy(key).applyInPandasWithState(run, out, store, "append", "NoTimeout")


PENDING, UPLOADING, DONE, FAILED = "pending", "uploading", "done", "failed"
#: Seconds waited after each failed attempt, so also the number of attempts.
WAITS = (2.0, 4.0, 8.0)


def with_retries(
    work: Callable[[], bool | None], waits: tuple[float, ...] = WAITS, wait: Callable[[float], bool | None] = time.sleep
) -> bool:
    """Whether ``work`` succeeded (returned something else than False, raised nothing), tried once per wait; ``wait``
    returning True stops."""
    for seconds in waits:
        try:
            if work() is not False:
                return True
        except Exception:
            log.exception("attempt failed")
        if wait(seconds):
            break
    return False


def run_batches(
    stream: DataFrame, sink: Callable[[DataFrame, int], bool | None], checkpoint: str, every: str = "5 seconds",
    waits: tuple[float, ...] = WAITS, wait: Callable[[float], bool | None] = time.sleep, once: bool = False,
):
    """Start a query that hands each micro-batch to ``sink``, again after each wait if it fails; a batch that fails every
    time ends the query and is replayed by the next start.  ``once``: what is there, then the end."""

    def deliver(batch: DataFrame, number: int) -> None:
        if not with_retries(lambda: sink(batch, number), waits, wait):
            raise RuntimeError(f"batch {number} failed {len(waits)} times")

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def enqueue(queue: DataFrame, chunks: DataFrame) -> DataFrame:
    """The queue (session_id, chunk_index, status) with chunks that it lacks as pending; a known chunk keeps its status."""
    new = chunks.select("session_id", "chunk_index").distinct().join(queue, ["session_id", "chunk_index"], "left_anti")
    return queue.unionByName(new.withColumn("status", F.lit(PENDING)))


def unfinished(queue: DataFrame) -> DataFrame:
    """What is to be uploaded, after a restart too: pending and uploading chunks, ascending; failed ones never again."""
    return queue.filter(F.col("status").isin(PENDING, UPLOADING)).orderBy("session_id", "chunk_index")


def pending_count(queue: DataFrame) -> DataFrame:
    """Pending chunks of each session (those being uploaded don't count)."""
    return queue.groupBy("session_id").agg(F.count_if(F.col("status") == PENDING).alias("queued"))


def upload_stats(queue: DataFrame) -> DataFrame:
    """Queued, done and failed chunks of each session."""
    return queue.groupBy("session_id").agg(*(F.count_if(F.col("status") == s).alias(n) for s, n in ((PENDING, "queued"), (DONE, "uploaded"), (FAILED, "failed"))))


def settle(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The queue after outcomes (session_id, chunk_index, started, ok): ok null and started: uploading; true: done; false:
    failed.  Done and failed chunks don't change."""
    told = outcomes.groupBy("session_id", "chunk_index").agg(
        F.max("started").alias("_started"), F.max("ok").alias("_ok")
    )
    now = F.when(
        F.col("status").isin(DONE, FAILED), F.col("status")
    ).when(F.col("_ok"), DONE).when(~F.col("_ok"), FAILED).when(F.col("_started"), UPLOADING).otherwise(F.col("status"))
    return queue.join(told, ["session_id", "chunk_index"], "left").withColumn("status", now).drop("_started", "_ok")


def sessions(chunks: DataFrame, finalised: DataFrame) -> DataFrame:
    """Counters of each session of a batch and whether it was closed by a control record (session_id); a closed session is queued for assembly."""
    closed = finalised.select("session_id").distinct().withColumn("_closed", F.lit(True))
    out = session_counters(chunks).join(closed, "session_id", "left").withColumn(
        "is_finalized", F.coalesce("_closed", F.lit(False))
    ).drop("_closed")
    return out.withColumn("assembly_status", F.when(F.col("is_finalized"), "queued").otherwise("receiving"))


def closing(records: DataFrame, late: str = "1 hour") -> DataFrame:
    """Of a stream of records (session_id, kind, received): each session once, when its first ``finalize`` record comes."""
    return records.filter("kind = 'finalize'").withWatermark("received", late).dropDuplicatesWithinWatermark(["session_id"]).select(
        "session_id", "received"
    )


def simulated_imu(spark: SparkSession, rows_per_second: int = 100, seed: int = 7) -> DataFrame:
    """A stream of inertial rows at rest with noise: gravity on the third axis."""
    rows = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    noise = lambda k, size: F.randn(seed + k) * size
    names = {
        "accel_x": noise(0, 0.1), "accel_y": noise(1, 0.1), "accel_z": noise(2, 0.1) + 9.81, "gyro_x": noise(3, 0.01),
        "gyro_y": noise(4, 0.01), "gyro_z": noise(5, 0.01),
    }
    return rows.select(F.col("timestamp"), F.col("value").alias("seq"), *(v.alias(c) for c, v in names.items()))
