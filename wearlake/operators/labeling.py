"""Auto-labels, annotation parsing and application, label statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.functions import formats
from wearlake.functions import text as tx
from wearlake.operators import intervals

ANNOTATION = "array<struct<from_name:string,type:string,value:struct<choices:array<string>,text:array<string>,rating:int,rectanglelabels:array<string>,x:double,y:double,width:double,height:double>>>"


def blend(action: Column, motion: Column, gps: Column) -> Column:
    """0.4, 0.3 and 0.3 of the confidences, rounded to 2 places on the exact binary sum, as Python does."""
    return formats.fixed(F.lit(0.4) * action + F.lit(0.3) * motion + F.lit(0.3) * gps, 2).cast("double")


def auto_label(segments: DataFrame, default: str = "other") -> DataFrame:
    """action_type, scenario, instructions, confidence and sources of segments with text, motion_level, motion_conf,
    is_stationary, speed_kmh (null: no GPS) and gps_conf."""
    # columns of their own, so that a whole text is lowered and searched once
    out = segments.withColumn("_low", F.lower(F.coalesce("text", F.lit(""))))
    out = out.withColumns(
        {"_action": tx.action_word(F.col("_low")), "_scenario": tx.scenario_word(F.col("_low"))}
    ).drop("_low")
    action, sure = tx.action(F.col("_action"), F.col("motion_level"), F.col("is_stationary"))
    out = out.withColumns(
        {
            "action_type": action, "action_conf": sure,
            "scenario": tx.scenario(F.col("_scenario"), F.col("speed_kmh"), default),
        }
    ).drop("_action", "_scenario")
    hi, en = tx.instructions(F.col("text"), F.col("action_type"))
    said = F.coalesce(F.col("text") != "", F.lit(False))
    sources = F.array_join(
        F.array_compact(
            F.array(
                F.lit("motion"), F.when(said, F.lit("whisper")), F.when(F.col("speed_kmh").isNotNull(), F.lit("gps"))
            )
        ),
        ",",
    )
    return out.withColumn("instruction_hi", hi).withColumn("instruction_en", en).withColumn(
        "confidence", blend(F.col("action_conf"), F.col("motion_conf"), F.col("gps_conf"))
    ).withColumn("sources", sources)


def counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) of several columns in one pass."""
    pairs = F.explode(
        F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    )
    return df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def parse_annotations(df: DataFrame, column: str = "annotation") -> DataFrame:
    """Typed fields of annotation JSON: the last result of a name wins; quality is 2 without a rating."""
    r = F.coalesce(F.from_json(column, ANNOTATION), F.from_json(F.lit("[]"), ANNOTATION))
    df = df.withColumn("_r", r)
    last = lambda name: F.get(
        F.filter("_r", lambda x: x["from_name"] == name), F.size(F.filter("_r", lambda x: x["from_name"] == name)) - 1
    )["value"]
    for name, field in (
        ("action_type", "choices"), ("scenario", "choices"), ("instruction_hi", "text"), ("instruction_en", "text")
    ):
        df = df.withColumn(name, F.coalesce(F.get(last(name)[field], 0), F.lit("")))
    boxes = F.transform(F.filter("_r", lambda x: x["from_name"] == "objects"), lambda x: F.struct(
        F.coalesce(F.get(x["value"]["rectanglelabels"], 0), F.lit("unknown")).alias("label"), *(
            F.coalesce(x["value"][c], F.lit(0.0)).alias(c) for c in ("x", "y", "width", "height")
        )
    ))
    return df.withColumn(
        "quality", F.coalesce(last("quality")["rating"], F.lit(2))
    ).withColumn("bboxes", boxes).drop("_r")


TASKS = "id long, data struct<session_id:string,frame_index:long,segment_index:long,start_frame:long,end_frame:long>, annotations array<struct<was_cancelled:boolean,result:string,completed_by:string,created_at:string>>"


def pull_annotations(tasks: DataFrame) -> DataFrame:
    """One row per annotation of a task (columns as in TASKS) that isn't cancelled, with the task's fields and its place."""
    rows = tasks.select(
        "id", "data", F.posexplode("annotations").alias("place", "a")
    ).filter(~F.coalesce("a.was_cancelled", F.lit(False)))
    return rows.select(
        F.col("id").alias("task_id"), *(
            F.col(f"data.{c}").alias(c)
            for c in ("session_id", "frame_index", "segment_index", "start_frame", "end_frame")
        ),
        F.col("a.result").alias("annotation"), F.col(
            "a.completed_by"
        ).alias("annotator"), F.col("a.created_at").alias("created_at"), "place",
    )


def of_session(annotations: DataFrame, session_id: str | None) -> DataFrame:
    """The annotations of one session, or all."""
    return annotations if session_id is None else annotations.filter(F.col("session_id") == session_id)


def annotation_index(annotations: DataFrame, order: list[str]) -> DataFrame:
    """The last annotation, parsed, of each episode_index: segment_index, else task_id, else -1."""
    rows = annotations.withColumn(
        "episode_index",
        F.coalesce(
            F.col("segment_index"), F.col("task_id") if "task_id" in annotations.columns else F.lit(None), F.lit(-1)
        ).cast("long"),
    )
    w = Window.partitionBy("episode_index").orderBy(*(F.desc(c) for c in order))
    return parse_annotations(rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n"))


def annotation_lines(index: DataFrame, episodes: DataFrame) -> DataFrame:
    """A record per annotated episode, with the path (``episode_path``) of its episode or null."""
    found = index.join(episodes.select("episode_index", F.col("path").alias("episode_path")), "episode_index", "left")
    return found.select(
        "episode_path", "episode_index", "action_type", "scenario", "instruction_hi", "instruction_en", "quality",
        "bboxes", "annotator", "created_at",
    )


def labels_group(index: DataFrame) -> DataFrame:
    """(episode_index, labels): what an annotation adds to its episode, texts empty where missing, the boxes as JSON."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    fields = [
        *(text(c) for c in ("action_type", "scenario", "instruction_hi", "instruction_en")),
        F.col("quality").cast("int").alias("quality"), text("annotator"), text("created_at"),
        F.lit(True).alias("is_human_labeled"),
    ]
    return index.select("episode_index", F.struct(*fields, F.to_json("bboxes").alias("bboxes_json")).alias("labels"))


def export_summary(episodes: DataFrame, index: DataFrame) -> DataFrame:
    """One row: episodes in all, with an annotation, and without."""
    joined = episodes.select("episode_index").join(
        index.select("episode_index", F.lit(True).alias("_has")), "episode_index", "left"
    )
    return joined.agg(
        F.count("*").alias("total"), F.count("_has").alias("updated"), (F.count("*") - F.count("_has")).alias("skipped")
    )


def segment_labels(
    segments: DataFrame, texts: DataFrame, gps: DataFrame | None, fps: float = 30.0, default: str = "general",
    width: float = 5.0, part: str = "session",
) -> DataFrame:
    """auto_label of segments (segment, start_frame, end_frame, magnitude), with the texts (ord, r_start, r_end in
    seconds, text) that overlap them and the fixes (frame, is_stationary, speed_kmh) of their frames.

    A segment is stationary if over 0.6 of its fixes are.  Confidences: gps 0.75 with fixes in the segment, else 0.3;
    motion by its level, 0.4 for a segment under two frames.  Without fixes a session has no speed.
    """
    timed = segments.withColumns(
        {"l_start": F.col("start_frame") / F.lit(fps), "l_end": F.col("end_frame") / F.lit(fps)}
    )
    said = intervals.overlap_text(timed, texts, [part, "segment"], width, part).drop("l_start", "l_end")
    if gps is not None:
        inside = intervals.frames_in(
            segments.select(part, "segment", "start_frame", "end_frame"), gps.select(part, "frame", "is_stationary"),
            part,
        )
        share = inside.groupBy(part, "segment").agg(
            (F.avg(F.col("is_stationary").cast("double")) > 0.6).alias("is_stationary"), F.lit(0.75).alias("gps_conf")
        )
        speed = gps.groupBy(part).agg(F.avg("speed_kmh").alias("speed_kmh"))
        said = said.join(share, [part, "segment"], "left").join(speed, part, "left")
    else:
        said = said.withColumns(
            {"is_stationary": F.lit(False), "gps_conf": F.lit(0.3), "speed_kmh": F.lit(None).cast("double")}
        )
    level, sure = tx.motion_level(F.col("magnitude"), F.col("end_frame") - F.col("start_frame"))
    said = said.withColumns(
        {
            "is_stationary": F.coalesce("is_stationary", F.lit(False)), "gps_conf": F.coalesce("gps_conf", F.lit(0.3)),
            "motion_level": level, "motion_conf": sure,
        }
    )
    return auto_label(said.withColumn("text", F.trim("text")), default)


def task_fields(labels: DataFrame) -> DataFrame:
    """The five fields of a label that a labelling task shows."""
    return labels.select("action_type", "scenario", "instruction_hi", "instruction_en", "confidence")


def with_predictions(tasks: DataFrame, labels: DataFrame, part: str = "session") -> DataFrame:
    """Tasks (segment) with the prediction of the label at the same place, null where there are fewer labels."""
    return tasks.join(predictions(labels).select(part, "segment", "prediction"), [part, "segment"], "left")


def label_summary(labels: DataFrame) -> DataFrame:
    """One row: labels, mean confidence to 3 places (0 without labels), stationary ones, and counts by action, scenario and
    motion level as sorted arrays of (value, n)."""
    by = counts(labels, ["action_type", "scenario", "motion_level"])
    listed = by.agg(
        *(
            F.array_sort(F.collect_list(F.when(F.col("column") == c, F.struct("value", "n")))).alias(f"{c}s")
            for c in ("action_type", "scenario", "motion_level")
        )
    )
    totals = labels.agg(
        F.count("*").alias("total"), F.coalesce(F.bround(F.avg("confidence"), 3), F.lit(0.0)).alias("avg_confidence"),
        F.count_if("is_stationary").alias("stationary_count"),
    )
    return totals.crossJoin(listed)  # one row each


def latest(annotations: DataFrame, key: str, order: str) -> DataFrame:
    """The last annotation of each key."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return annotations.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def apply_annotations(episodes: DataFrame, annotations: DataFrame, key: str) -> DataFrame:
    """Episodes with the instruction of their annotation: Hindi, else English, else their own."""
    joined = episodes.join(
        annotations.select(key, "instruction_hi", "instruction_en", F.lit(True).alias("_has")), key, "left"
    )
    said = F.coalesce(
        F.nullif("instruction_hi", F.lit("")), F.nullif("instruction_en", F.lit("")), F.col("instruction")
    )
    return joined.withColumn("instruction", said).withColumn(
        "annotated", F.coalesce("_has", F.lit(False))
    ).drop("_has", "instruction_hi", "instruction_en")


def completion(tasks: DataFrame, annotations: str = "n_annotations") -> DataFrame:
    """Tasks, annotated, pending, annotations in all, percent done (0 without tasks)."""
    done = F.count_if(F.col(annotations) > 0)
    return tasks.agg(
        F.count("*").alias("tasks"), done.alias("annotated"), (F.count("*") - done).alias("pending"), F.coalesce(
            F.sum(annotations), F.lit(0)
        ).alias("annotations"),
        F.when(F.count("*") > 0, F.round(100 * done / F.count("*"), 1)).otherwise(0.0).alias("percent"),
    )


def predictions(df: DataFrame) -> DataFrame:
    """Prediction JSON of labels: only the fields that are there; the score is 0.5 if missing."""
    item = lambda name, kind, value: F.when(
        F.coalesce(value, F.lit("")) != "",
        F.struct(F.lit(name).alias("from_name"), F.lit(kind).alias("type"), value.alias("value")),
    )
    result = F.array_compact(
        F.array(
            item("action_type", "choices", F.col("action_type")), item("scenario", "choices", F.col("scenario")),
            item("instruction_hi", "textarea", F.col("instruction_hi")),
        )
    )
    return df.withColumn(
        "prediction", F.to_json(F.struct(F.coalesce("confidence", F.lit(0.5)).alias("score"), result.alias("result")))
    )


def frame_tasks(frames: DataFrame) -> DataFrame:
    """(session_id, frame_index, task) of encoded frames (jpeg): the JSON of a labelling task with the image inside; send it in
    batches of writers.task_batches."""
    data = F.struct(formats.data_url(F.col("jpeg")).alias("image"), "session_id", "frame_index")
    return frames.select("session_id", "frame_index", F.to_json(F.struct(data.alias("data"))).alias("task"))


def segment_tasks(segments: DataFrame, frames: DataFrame, labels: DataFrame, part: str = "session") -> DataFrame:
    """(part, segment, task): one task per segment with its middle frame (jpeg; at most the session's last frame) and, where
    there is a label at its place, the label as a prediction."""
    last = frames.groupBy(part).agg(F.max("frame").alias("_last"))
    middle = F.least(F.floor((F.col("start_frame") + F.col("end_frame")) / 2), F.col("_last")).cast("long")
    placed = segments.join(last, part).withColumn("frame", middle).join(
        frames.select(part, "frame", "jpeg"), [part, "frame"], "left"
    )
    told = with_predictions(placed, labels, part)
    data = F.struct(
        formats.data_url(F.col("jpeg")).alias("image"), F.col(part).alias("session_id"), F.col("segment").alias(
            "segment_index"
        ), "start_frame", "end_frame",
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.col("frame").alias("frame_index"),
    )
    prediction = F.when(
        F.col("prediction").isNotNull(),
        F.array(
            F.from_json("prediction", "score double, result array<struct<from_name:string,type:string,value:string>>")
        ),
    )
    return told.select(
        part, "segment", F.to_json(F.struct(data.alias("data"), prediction.alias("predictions"))).alias("task")
    )
