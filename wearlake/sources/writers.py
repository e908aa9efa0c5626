"""Sinks: Parquet episodes, CSV, JSON and JSONL, WAV, dataset summaries, the state of a run, landed files."""

from __future__ import annotations

import io
import json
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.operators import episodes
from wearlake.sources import readers


def write_episodes(frames: DataFrame, path: str, by: tuple[str, ...] = ("session_id",), fps: float = 30.0) -> None:
    """Per-frame rows as Parquet partitioned by session (and episode), completed as
    episodes.complete_frames says, and their listing, which episodes.list_episodes reads.  No rows is an error."""
    frames = episodes.complete_frames(frames, fps, by) if "imu" in frames.columns else frames
    if frames.isEmpty():
        raise ValueError("no frames to write")
    frames.repartition(*by).sortWithinPartitions(
        *by, "frame_index"
    ).write.mode("overwrite").partitionBy(*by).parquet(path)
    written = frames.sparkSession.read.schema(frames.schema).parquet(path)
    episodes.describe_episodes(written, by).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{episodes.LISTING}")


def write_processed(df: DataFrame, path: str) -> None:
    """A processed series as Parquet."""
    df.write.mode("overwrite").parquet(path)


def append_imu(new: DataFrame, path: str, key: tuple[str, ...] = ("timestamp",)) -> None:
    """Append the rows of a buffer to a Parquet series; rows that are there already (the buffer is sent whole each time) don't come twice."""
    spark = new.sparkSession
    new = new.dropDuplicates(list(key))
    try:
        new = new.join(spark.read.parquet(path).select(*key), list(key), "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    new.write.mode("append").parquet(path)


def append_batch(rows: DataFrame, path: str, number: int) -> bool:
    """Append a batch of a stream (as foreachBatch hands it over) once: whether it was new.

    A batch has a folder of its own and, when that is whole, an entry in the log beside it; a batch that is in the log
    is left alone, one that isn't is written over.  So a batch sent again, after a crash too, costs its own size and
    adds nothing, no history is read, and all rows of a batch stay, also those of one time.
    """
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    entry = jvm.org.apache.hadoop.fs.Path(f"{path}/log/{int(number)}")
    fs = entry.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(entry):
        return False
    rows.write.mode("overwrite").parquet(f"{path}/data/batch={int(number)}")
    fs.mkdirs(entry.getParent())
    fs.create(entry, True).close()
    return True


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that are in the log, with the column ``batch``; of others there may be parts, which don't count."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    names = [s.getPath().getName() for s in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)]
    known = spark.createDataFrame([(int(n),) for n in names if n.isdigit()], "batch int")
    return spark.read.parquet(f"{path}/data").withColumn("batch", F.col("batch").cast("int")).join(known, "batch", "left_semi")


def write_wav(audio: DataFrame, folder: str) -> DataFrame:
    """16-bit WAV files of (name, rate, samples) in a folder that all machines share; returns (name, path, bytes)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            made = []
            for name, rate, x in zip(p["name"], p["rate"], p["samples"]):
                raw = readers.encode_wav(np.asarray(x, float), int(rate))
                path = os.path.join(folder, f"{name}.wav")
                with open(f"{path}.{uuid.uuid4().hex}", "wb") as f:
                    f.write(raw)
                os.replace(f.name, path)  # a repeated task leaves whole files only
                made.append((name, path, len(raw)))
            yield pd.DataFrame(made, columns=["name", "path", "bytes"])

    os.makedirs(folder, exist_ok=True)
    return audio.select("name", "rate", "samples").mapInPandas(run, "name string, path string, bytes long")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_fixes(fixes: DataFrame, path: str, t0: float, t1: float) -> None:
    """The fixes of a closed time range as CSV."""
    write_csv(fixes.filter(F.col("timestamp").between(t0, t1)), path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").json(path)


FEATURES = {
    "observation.image": "uint8", "observation.audio": "float32", "observation.imu": "float32", "action": "float32",
    "language_instruction": "string", "timestamp": "float64",
}


def dataset_info(rows: DataFrame, fps: float = 30.0) -> DataFrame:
    """One row with the JSON summary of a dataset: episodes, frames, distinct two-character language prefixes, fps and feature types."""
    totals = rows.agg(
        F.count("*").alias("total_episodes"), F.coalesce(F.sum("frames"), F.lit(0)).alias("total_frames"),
        F.array_sort(F.collect_set(F.substring("instruction", 1, 2))).alias("languages"),
    )
    features = F.struct(*(F.lit(v).alias(k.replace(".", "_")) for k, v in FEATURES.items()))
    return totals.select(F.to_json(F.struct("*", F.lit(fps).alias("fps"), features.alias("features"))).alias("info"))


def run_info(rows: DataFrame, session_id: str, scenario: str, total_frames: int, fps: int = 30) -> DataFrame:
    """One row with the JSON summary of one session's episodes."""
    fields = {
        "session_id": session_id, "scenario_type": scenario, "total_frames": total_frames, "fps": fps, "action_dim": 7
    }
    return rows.agg(F.count("*").alias("num_episodes")).select(
        F.to_json(
            F.struct(
                "num_episodes", *(F.lit(v).alias(k) for k, v in fields.items()),
                F.array(F.lit(224), F.lit(224)).alias("image_size"),
            )
        ).alias("info")
    )


def dataset_card(stats: DataFrame) -> DataFrame:
    """A text about a dataset from catalog.dataset_stats."""
    text = F.format_string(
        "# Dataset\n\n%d episodes, %d frames, %.1f seconds, %d sessions\n", "episodes", "frames",
        F.col("seconds").cast("double"), "sessions",
    )
    return stats.select(text.alias("card"))


def save_state(spark: SparkSession, path: str, state: dict) -> None:
    """A run's state (done stages and their results) as a JSON file."""
    spark.createDataFrame(
        [(json.dumps(state, sort_keys=True),)], "value string"
    ).coalesce(1).write.mode("overwrite").text(path)


def load_state(spark: SparkSession, path: str) -> dict:
    """The saved state, empty if there is none."""
    try:
        rows = spark.read.text(path).collect()  # one line
    except AnalysisException:
        return {}
    return json.loads(rows[0]["value"]) if rows else {}


def run_stages(
    spark: SparkSession, path: str, stages: list[tuple[str, Callable[[dict], object]]], resume: bool = True
) -> dict:
    """Run stages in order, each with the results so far; a stage that a saved state has done is skipped."""
    state = load_state(spark, path) if resume else {}
    for name, work in stages:
        if name not in state:
            state[name] = work(dict(state))
            save_state(spark, path, state)
    return state


def stage_table(spark: SparkSession, state: dict, names: list[str]) -> DataFrame:
    """(stage, done, result) of each stage, in order."""
    rows = [(k, n, n in state, json.dumps(state[n]) if n in state else None) for k, n in enumerate(names)]
    return spark.createDataFrame(
        rows, "place int, stage string, done boolean, result string"
    ).orderBy("place").drop("place")


def land(spark: SparkSession, archive: bytes, folder: str, role: str = "upload") -> list[str]:
    """The files of a ZIP in a landing folder; names that lead out of it are refused."""
    done = []
    with zipfile.ZipFile(io.BytesIO(archive)) as z:
        for item in z.infolist():
            path = os.path.normpath(os.path.join(folder, item.filename))
            if not path.startswith(os.path.normpath(folder) + os.sep):
                raise ValueError(f"{role} holds a path outside its folder: {item.filename}")
            if not item.is_dir():
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as f:
                    f.write(z.read(item))
                done.append(path)
    return sorted(done)


def delete_sessions(df: DataFrame, out: str, sessions: list[str]) -> int:
    """Write the rows of all other sessions to ``out``; returns how many rows were left out."""
    gone = F.coalesce(F.col("session_id").isin(sessions), F.lit(False))
    df.filter(~gone).write.mode("overwrite").partitionBy("session_id").parquet(out)
    return df.filter(gone).count()


def write_session_meta(sessions: DataFrame, path: str, at: str) -> None:
    """The assembled sessions (assembly.assemble) as JSON, with the time of assembly."""
    write_json(sessions.withColumn("assembled_at", F.lit(at)), path)


def write_results(path: str, **tables: DataFrame) -> None:
    """Results of stages (transcription, segments, validation, ...) as JSON, each in a folder of its name."""
    for name, df in tables.items():
        write_json(df, os.path.join(path, name))


def task_batches(df: DataFrame, order: str, size: int = 50) -> DataFrame:
    """A batch number per row, ``size`` rows each, through partition-wise numbering without one global sort task."""
    ranked = df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()).withColumn(
        "_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    )
    return ranked.withColumn("batch", F.concat_ws("-", F.col("_p"), F.floor(F.col("_i") / size))).drop("_p", "_i")
