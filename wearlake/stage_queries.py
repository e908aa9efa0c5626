"""Queries of whole stages, labelling, transcripts, the upload queue and episode cutting, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import text as tx
from wearlake.operators import assembly, catalog, composites, episodes, images, labeling, series, training, transcripts
from wearlake.plans import standins as st
from wearlake.queries import _ACTION, _HYST, _SCENARIO, MOTION
from wearlake.registry import _SQL, query, r6
from wearlake.sources import pages
from wearlake.sources.scratch import scratch_path
from wearlake.streaming import ingest, uploads

_STOPS = f"""WITH {st.SENSOR}, {MOTION}, a AS (SELECT *, speed_kmh < 2 AS slow FROM motion),
b AS (SELECT *, CASE WHEN slow <> lag(slow) OVER w THEN 1 ELSE 0 END AS turned FROM a WINDOW w AS (PARTITION BY session ORDER BY t, event_id)),
d AS (SELECT *, sum(turned) OVER (PARTITION BY session ORDER BY t, event_id) AS run FROM b),
g AS (SELECT *, slow AND max(t) OVER (PARTITION BY session, run) - min(t) OVER (PARTITION BY session, run) >= 5 AS is_stationary FROM d),
h AS (SELECT *, CASE WHEN lag(is_stationary) OVER (PARTITION BY session ORDER BY t, event_id) AND NOT is_stationary THEN 1 ELSE 0 END AS started FROM g),
m AS (SELECT *, sum(started) OVER (PARTITION BY session ORDER BY t, event_id) AS segment_id FROM h)"""


def _moved(spark, d) -> DataFrame:
    return series.motion(st.sensor(spark, d), tie="event_id")


@query(_STOPS + " SELECT session, event_id, is_stationary, segment_id::BIGINT AS segment_id FROM m")
def gps_stops(spark, d):
    out = series.stationary(_moved(spark, d), speed="speed_kmh", tie="event_id")
    return out.select("session", "event_id", "is_stationary", F.col("segment_id").cast("long").alias("segment_id"))


@query(f"""WITH {st.SENSOR}, {MOTION}, pl AS (SELECT session, 'tile_' || printf('%.3f', lat) || '_' || printf('%.3f', lon) AS place, total_m FROM motion),
n AS (SELECT session, place, count(*) AS n FROM pl GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY n DESC, place) AS k FROM n)
SELECT session, (SELECT count(*) FROM pl WHERE pl.session = r.session) AS num_points, round((SELECT max(total_m) FROM pl WHERE pl.session = r.session), 1) AS total_dist_m,
 string_agg(place || ':' || n, ',' ORDER BY n DESC, place) AS top_places FROM r WHERE k <= 3 GROUP BY session""")
def gps_summary(spark, d):
    out = catalog.gps_summary(catalog.tag_places(_moved(spark, d)))
    return out.withColumn(
        "top_places", F.array_join(F.transform("top_places", lambda p: F.concat_ws(":", p["place_name"], p["n"])), ",")
    )


@query(f"""WITH {st.SENSOR}, {MOTION} SELECT session, round(avg(speed_kmh), 6) AS mean_kmh, CASE WHEN avg(speed_kmh) > 15 THEN 'driving' WHEN avg(speed_kmh) > 3 THEN 'food_delivery' ELSE 'general' END AS scenario FROM motion GROUP BY session""")
def session_scenario(spark, d):
    return catalog.session_scenario(_moved(spark, d)).withColumns({"mean_kmh": F.round("mean_kmh", 6)})


_CHANNELS = ("value", "speed", "magnitude")
_FIXES = ("lat", "lon", "alt", "speed_kmh", "hs", "hc")
_AT = lambda c: f"CASE WHEN p.t IS NULL THEN n.{c} WHEN n.t IS NULL OR p.t = g.t THEN p.{c} ELSE p.{c} + (n.{c} - p.{c}) * ((g.t - p.t) / (n.t - p.t)) END"
_WIDE = ", ".join(f"round({_AT(c)}, 6) AS {c}" for c in (*_CHANNELS, *_FIXES))


@query(f"""WITH {st.SENSOR}, s2 AS (SELECT session, event_id, t / 3600 AS t, value, speed, magnitude, lat, lon, (event_id % 500)::DOUBLE AS alt, (event_id % 160)::DOUBLE AS speed_kmh, sin(radians(speed * 40)) AS hs, cos(radians(speed * 40)) AS hc FROM s),
f AS (SELECT session, value, row_number() OVER (PARTITION BY session ORDER BY t, event_id) - 1 AS frame FROM s2),
e AS (SELECT session, min(t) AS a, max(t) AS b FROM s2 GROUP BY session),
g AS (SELECT session, a, k AS frame, a + k * 4e0 AS t FROM (SELECT session, a, unnest(range(0, ceil((b - a) / 4e0)::BIGINT + 1)) AS k FROM e)),
w AS (SELECT g.*, floor((t - a) * 1)::BIGINT AS i FROM g),
p AS (SELECT g.session, g.frame, s2.* EXCLUDE (session) FROM g ASOF LEFT JOIN s2 ON g.session = s2.session AND g.t >= s2.t),
n AS (SELECT g.session, g.frame, s2.* EXCLUDE (session) FROM g ASOF LEFT JOIN s2 ON g.session = s2.session AND g.t <= s2.t)
SELECT g.session, g.frame, {_WIDE}, coalesce(x.value, 0) AS a0, coalesce(y.value, 0) AS a1
FROM w g JOIN p ON p.session = g.session AND p.frame = g.frame JOIN n ON n.session = g.session AND n.frame = g.frame
LEFT JOIN f x ON x.session = g.session AND x.frame = g.i LEFT JOIN f y ON y.session = g.session AND y.frame = g.i + 1""")
def align_streams(spark, d):
    s = st.sensor(spark, d).withColumns(
        {
            "t": F.col("t") / 3600, "alt": (F.col("event_id") % 500).cast("double"),
            "speed_kmh": (F.col("event_id") % 160).cast("double"), "heading": F.col("speed") * 40,
        }
    )
    frames = series.grid(s, 4.0)
    frames = episodes.numbered(frames, ["t"], "frame")
    pcm = st.frames(spark, d).groupBy("session").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("frame", "value"))), lambda x: x["value"]).alias("samples")
    ).withColumn("rate", F.lit(1))
    out = composites.align_streams(frames, s, s, pcm, _CHANNELS, window=2.0, block=16, tie="event_id")
    names = [("imu", k, c) for k, c in enumerate(_CHANNELS)] + [("gps", k, c) for k, c in enumerate(_FIXES)]
    return out.select(
        "session", "frame", *(F.round(F.get(a, F.lit(k)), 6).alias(c) for a, k, c in names),
        *(F.get("audio", F.lit(k)).alias(f"a{k}") for k in (0, 1)),
    )


_SEGMENTS = _HYST + """, seg AS (SELECT session, start_frame, end_frame, m, row_number() OVER (PARTITION BY session ORDER BY start_frame) - 1 AS segment FROM (
 SELECT session, start_frame, end_frame, m FROM x UNION ALL SELECT session, 0, max(frame) + 1, avg(magnitude) FROM f WHERE session NOT IN (SELECT session FROM x) GROUP BY session))"""


def _segments(spark, d) -> DataFrame:
    return episodes.numbered(series.hysteresis(st.frames(spark, d)), ["start_frame"], "segment")


_EPISODES = _SEGMENTS + """, len_ AS (SELECT session, count(*) - session % 3 AS n_frames FROM f GROUP BY session),
cut AS (SELECT session, segment, greatest(start_frame, 0) AS start_frame, least(end_frame, n_frames) AS end_frame FROM seg JOIN len_ USING (session)),
kept AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY segment) - 1 + 3 AS episode_index FROM cut WHERE end_frame - start_frame >= 4),
said AS (SELECT session, segment, arg_max(text, turn) AS instruction FROM (SELECT conv_id AS session, turn, coalesce(text, '') AS text,
 CASE WHEN turn % 3 = 0 THEN turn // 3 ELSE row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 END AS segment FROM conversations) GROUP BY ALL),
ep AS (SELECT kept.*, coalesce(instruction, 'none') AS instruction FROM kept LEFT JOIN said USING (session, segment))"""


def _episodes(spark, d) -> DataFrame:
    lengths = st.frames(spark, d).groupBy("session").agg((F.count("*") - F.col("session") % 3).alias("n_frames"))
    texts = st.transcripts(spark, d).withColumn(
        "segment_index", F.when(F.col("ord") % 3 == 0, F.floor(F.col("ord") / 3))
    )
    return episodes.cut_episodes(_segments(spark, d), lengths, texts, "none", 4, 3)


@query(_EPISODES + " SELECT session, segment, start_frame, end_frame, episode_index, instruction FROM ep")
def cut_episodes(spark, d):
    return _episodes(spark, d).select("session", "segment", "start_frame", "end_frame", "episode_index", "instruction")


@query(_EPISODES + " SELECT ep.session, episode_index, frame - start_frame AS frame_index, round(value, 6) AS value FROM ep JOIN f ON f.session = ep.session AND f.frame >= start_frame AND f.frame < end_frame")
def episode_frames(spark, d):
    return episodes.episode_frames(
        _episodes(spark, d), st.frames(spark, d).select("session", "frame", "value")
    ).select("session", "episode_index", "frame_index", *r6("value"))


@query(_SEGMENTS + " SELECT session, segment, (start_frame + end_frame) // 2 AS frame FROM seg WHERE segment < 5")
def key_frames(spark, d):
    return episodes.key_frames(_segments(spark, d), 5)


@query(f"WITH {st.FRAMES}, n AS (SELECT session, count(*) AS n FROM f GROUP BY session), k AS (SELECT session, unnest(range(0, n, greatest(1, n // 4)))::BIGINT AS frame FROM n) SELECT session, frame FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY frame) AS r FROM k) WHERE r <= 4")
def even_frames(spark, d):
    return episodes.even_frames(st.frames(spark, d).groupBy("session").agg(F.count("*").alias("n_frames")), 4)


@query(f"""WITH {st.FRAMES}, c AS (SELECT session, count(*) AS want, count(*) FILTER (WHERE NOT (frame = 0 AND session % 2 = 0)) AS have FROM f GROUP BY session)
SELECT f.session, frame, round(CASE WHEN have >= want AND NOT (frame = 0 AND f.session % 2 = 0) THEN value ELSE 0 END, 6) AS imu0, round(CASE WHEN have >= want AND NOT (frame = 0 AND f.session % 2 = 0) THEN magnitude ELSE 0 END, 6) AS action5,
 10 AS n_imu, 6 AS n_gps, 7 AS n_action, round(CASE WHEN frame % 3 <> 0 THEN lat ELSE 0 END, 6) AS gps0, round(CASE WHEN frame % 3 <> 0 THEN lon ELSE 0 END, 6) AS gps1, 2 AS n_audio FROM f JOIN c USING (session)""")
def frame_payload(spark, d):
    f = st.frames(spark, d)
    imu = f.filter(~((F.col("frame") == 0) & (F.col("session") % 2 == 0))).select(
        "session", "frame", F.array("value", "speed", "lat", "lon", "value", "magnitude").alias("values")
    )
    gps = f.filter("frame % 3 <> 0").select("session", "frame", F.array("lat", "lon").alias("values"))
    out = episodes.frame_payload(f.select("session", "frame"), imu, gps, None, 2)
    at = lambda c, k, n: F.round(F.get(c, F.lit(k)), 6).alias(n)
    return out.select(
        "session", "frame", at("imu", 0, "imu0"), at("action", 5, "action5"),
        *(F.size(c).alias(f"n_{c}") for c in ("imu", "gps", "action", "audio")), at("gps", 0, "gps0"),
        at("gps", 1, "gps1"),
    )


@query(f"""WITH {st.FRAMES} SELECT session, frame, round(coalesce(value - lag(value) OVER w, -value), 6) AS dx, round(coalesce(speed - lag(speed) OVER w, -speed), 6) AS dy, round(coalesce(lat - lag(lat) OVER w, -lat), 6) AS dz, round(coalesce(lon - lag(lon) OVER w, 1 - lon), 6) AS dw, 0e0 AS move
FROM f WINDOW w AS (PARTITION BY session ORDER BY frame)""")
def derived_actions(spark, d):
    zero = [F.lit(0.0)] * 6
    f = st.frames(spark, d).withColumn("imu", F.array(*zero, "value", "speed", "lat", "lon"))
    out = episodes.derive_actions(f, frame="frame")
    at = lambda k, n: F.round(F.get("action", F.lit(k)), 6).alias(n)
    return out.select("session", "frame", at(3, "dx"), at(4, "dy"), at(5, "dz"), at(6, "dw"), at(0, "move"))


@query("""WITH r AS (SELECT o_custkey AS run, o_orderkey AS epoch, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey % 50)::DOUBLE END AS val_loss FROM orders)
SELECT run, epoch, val_loss FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY val_loss, epoch) AS n FROM r WHERE val_loss IS NOT NULL) WHERE n = 1""")
def best_checkpoint(spark, d):
    o = st.read(spark, d, "orders")
    k = F.col("o_orderkey")
    return episodes.best_checkpoint(
        o.select(
            F.col("o_custkey").alias("run"), k.alias("epoch"),
            F.when(k % 7 == 0, None).otherwise((k % 50).cast("double")).alias("val_loss"),
        )
    )


_SAID = f"""{st.SENSOR}, {st.TRANSCRIPTS}, segs AS (SELECT session, k AS segment, k * 4 AS start_frame, k * 4 + 4 AS end_frame, ((session + k) % 12)::DOUBLE AS magnitude FROM (SELECT session, unnest(range(0, max(ord) // 2 + 1)) AS k FROM r GROUP BY session)),
f AS (SELECT session, event_id, row_number() OVER (PARTITION BY session ORDER BY t, event_id) - 1 AS frame FROM s),
o AS (SELECT g.session, g.segment, trim(string_agg(trim(text), ' ' ORDER BY ord)) AS said FROM segs g JOIN r ON r.session = g.session AND least(end_frame, r_end) - greatest(start_frame, r_start) > 0.1 GROUP BY ALL),
b AS (SELECT g.session, g.segment, avg((event_id % 3 <> 0)::INT) > 0.6 AS still FROM segs g JOIN f ON f.session = g.session AND frame >= start_frame AND frame < end_frame GROUP BY ALL),
v AS (SELECT session, avg(event_id % 30) AS kmh FROM f GROUP BY session),
k AS (SELECT g.*, coalesce(o.said, '') AS said, lower(coalesce(o.said, '')) AS t, coalesce(still, false) AS is_stationary, CASE WHEN still IS NULL THEN 0.3 ELSE 0.75 END::DOUBLE AS gps_conf, kmh AS speed_kmh,
 CASE WHEN magnitude > 8 THEN 'high' WHEN magnitude > 2 THEN 'medium' ELSE 'low' END AS motion_level FROM segs g LEFT JOIN o USING (session, segment) LEFT JOIN b USING (session, segment) LEFT JOIN v USING (session)),
w AS (SELECT *, {_ACTION} AS a_word, {_SCENARIO} AS s_word FROM k)"""


def _labelled(spark, d) -> DataFrame:
    texts = st.transcripts(spark, d)
    counts = texts.groupBy("session").agg(F.floor(F.max("ord") / 2).alias("_m"))
    segs = series.numbered(counts, F.lit(0), F.col("_m"), "segment").select("session", "segment")
    segs = segs.withColumns(
        {
            "start_frame": F.col("segment") * 4, "end_frame": F.col("segment") * 4 + 4,
            "magnitude": ((F.col("session") + F.col("segment")) % 12).cast("double"),
        }
    )
    gps = st.frames(spark, d).select(
        "session", "frame", (F.col("event_id") % 3 != 0).alias("is_stationary"),
        (F.col("event_id") % 30).cast("double").alias("speed_kmh"),
    )
    return labeling.segment_labels(segs, texts, gps, 1.0)


@query(f"""WITH {_SAID} SELECT session, segment, is_stationary, motion_level, gps_conf, said AS text, coalesce(a_word, CASE WHEN is_stationary THEN 'idle' WHEN motion_level <> 'low' THEN 'navigate' ELSE 'other' END) AS action_type,
 coalesce(s_word, CASE WHEN speed_kmh > 15 THEN 'driving' WHEN speed_kmh > 3 THEN 'food_delivery' ELSE 'general' END) AS scenario,
 'motion' || CASE WHEN said <> '' THEN ',whisper' ELSE '' END || CASE WHEN speed_kmh IS NOT NULL THEN ',gps' ELSE '' END AS sources FROM w""")
def label_segments(spark, d):
    return _labelled(spark, d).select(
        "session", "segment", "is_stationary", "motion_level", "gps_conf", "text", "action_type", "scenario", "sources"
    )


_SURE = """printf('%.2f', 0.4e0 * CASE WHEN a_word IS NOT NULL THEN 0.85e0 WHEN is_stationary THEN 0.6e0 WHEN motion_level = 'high' THEN 0.5e0 WHEN motion_level = 'medium' THEN 0.4e0 ELSE 0.3e0 END
 + 0.3e0 * CASE motion_level WHEN 'high' THEN 0.8e0 WHEN 'medium' THEN 0.7e0 ELSE 0.6e0 END + 0.3e0 * gps_conf)::DOUBLE"""
_COUNTED = lambda c: f"(SELECT string_agg(v || ':' || n, ',' ORDER BY v) FROM (SELECT {c} AS v, count(*) AS n FROM z GROUP BY {c})) AS {c}s"


@query(f"""WITH {_SAID}, z AS (SELECT a_word, gps_conf, is_stationary, motion_level, coalesce(a_word, CASE WHEN is_stationary THEN 'idle' WHEN motion_level <> 'low' THEN 'navigate' ELSE 'other' END) AS action_type,
 coalesce(s_word, CASE WHEN speed_kmh > 15 THEN 'driving' WHEN speed_kmh > 3 THEN 'food_delivery' ELSE 'general' END) AS scenario FROM w)
SELECT count(*) AS total, round(avg({_SURE}), 3) AS avg_confidence, count(*) FILTER (WHERE is_stationary) AS stationary_count, {_COUNTED('action_type')}, {_COUNTED('scenario')}, {_COUNTED('motion_level')} FROM z""")
def label_summary(spark, d):
    flat = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["value"], x["n"])), ",").alias(c)
    return labeling.label_summary(_labelled(spark, d)).select(
        "total", "avg_confidence", "stationary_count", flat("action_types"), flat("scenarios"), flat("motion_levels")
    )


_RESULT = """'[{"from_name":"action_type","value":{"choices":["a' || quality || '"]}},{"from_name":"instruction_hi","value":{"text":["' || CASE WHEN doc_id % 2 = 0 THEN 'hi' ELSE '' END || '"]}}]'"""
_TASKS = f"""t AS (SELECT doc_id AS id, 's' || doc_id % 20 AS session_id, CASE WHEN doc_id % 5 <> 0 THEN doc_id // 2 END AS segment_index, quality, toxic, {_RESULT} AS result FROM labels),
a AS (SELECT *, 0 AS place, 'p' || toxic AS annotator FROM t WHERE quality = 1 UNION ALL SELECT *, 1, 'q' FROM t WHERE toxic = 0),
x AS (SELECT coalesce(segment_index, id) AS episode_index, id, place, quality, annotator, row_number() OVER (PARTITION BY coalesce(segment_index, id) ORDER BY id DESC, place DESC) AS n FROM a)"""


def _tasks(spark, d) -> DataFrame:
    k = F.col("doc_id")
    quality = F.col("quality").cast("string")
    result = F.concat(
        F.lit('[{"from_name":"action_type","value":{"choices":["a'), quality,
        F.lit('"]}},{"from_name":"instruction_hi","value":{"text":["'), F.when(k % 2 == 0, "hi").otherwise(""),
        F.lit('"]}}]'),
    )
    data = F.struct(
        F.concat(F.lit("s"), (k % 20).cast("string")).alias("session_id"),
        F.lit(None).cast("long").alias("frame_index"),
        F.when(k % 5 != 0, F.floor(k / 2)).cast("long").alias("segment_index"), (k * 10).alias("start_frame"),
        (k * 10 + 10).alias("end_frame"),
    )
    note = lambda gone, who: F.struct(
        gone.alias("was_cancelled"), result.alias("result"), who.alias("completed_by"),
        F.lit("2024").alias("created_at"),
    )
    both = F.array(
        note(F.col("quality") != 1, F.concat(F.lit("p"), F.col("toxic").cast("string"))),
        note(F.when(F.col("toxic") != 0, True), F.lit("q")),
    )
    return st.read(spark, d, "labels").select(k.alias("id"), data.alias("data"), both.alias("annotations"))


@query(f"WITH {_TASKS} SELECT id AS task_id, session_id, segment_index, id * 10 AS start_frame, place, result AS annotation, annotator FROM a")
def pull_annotations(spark, d):
    return labeling.pull_annotations(_tasks(spark, d)).select(
        "task_id", "session_id", "segment_index", "start_frame", "place", "annotation", "annotator"
    )


@query(_SQL["pull_annotations"])
def paged_annotations(spark, d):
    """The same, read back from pages of 100 tasks through the paged source."""
    path = scratch_path(spark, "tasks")
    pages.write_pages(_tasks(spark, d), path)
    return labeling.pull_annotations(pages.read_tasks(spark, path)).select(
        "task_id", "session_id", "segment_index", "start_frame", "place", "annotation", "annotator"
    )


def _index(spark, d) -> DataFrame:
    return labeling.annotation_index(labeling.pull_annotations(_tasks(spark, d)), ["task_id", "place"])


@query(f"""WITH {_TASKS} SELECT 'ep/' || e.id AS episode_path, episode_index, 'a' || quality AS action_type, '' AS scenario, CASE WHEN x.id % 2 = 0 THEN 'hi' ELSE '' END AS instruction_hi, 2 AS quality, annotator
FROM x LEFT JOIN (SELECT doc_id * 3 AS id FROM documents) e ON e.id = x.episode_index WHERE n = 1""")
def annotation_lines(spark, d):
    number = F.col("doc_id") * 3  # every document an episode, of each third annotation
    e = st.read(spark, d, "documents").select(
        number.alias("episode_index"), F.concat(F.lit("ep/"), number.cast("string")).alias("path")
    )
    return labeling.annotation_lines(_index(spark, d), e).select(
        "episode_path", "episode_index", "action_type", "scenario", "instruction_hi", "quality", "annotator"
    )


@query(f"""WITH {_TASKS} SELECT episode_index, 'a' || quality AS action_type, CASE WHEN id % 2 = 0 THEN 'hi' ELSE '' END AS instruction_hi, 2 AS quality, annotator, true AS is_human_labeled, '[]' AS bboxes_json FROM x WHERE n = 1""")
def labels_group(spark, d):
    out = labeling.labels_group(_index(spark, d))
    return out.select(
        "episode_index",
        *(
            f"labels.{c}"
            for c in ("action_type", "instruction_hi", "quality", "annotator", "is_human_labeled", "bboxes_json")
        ),
    )


@query(f"WITH {_TASKS} SELECT count(*) AS total, count(x.episode_index) AS updated, count(*) - count(x.episode_index) AS skipped FROM documents e LEFT JOIN (SELECT episode_index FROM x WHERE n = 1) x ON x.episode_index = e.doc_id * 3")
def export_summary(spark, d):
    e = st.read(spark, d, "documents").select((F.col("doc_id") * 3).alias("episode_index"))
    return labeling.export_summary(e, _index(spark, d))


_SPOKEN = """c AS (SELECT conv_id AS session, turn AS ord, turn // 3 AS segment, trim(CASE WHEN turn % 7 = 3 THEN '  ' ELSE text END) AS text, CASE WHEN turn % 2 = 0 THEN 'hi' ELSE '?' END AS language,
 CASE WHEN turn % 4 = 0 THEN 0.5 ELSE greatest(0, least(1, exp(CASE WHEN turn % 5 = 0 THEN -0.5 ELSE 0.2 - (turn % 5) / 4e0 END))) END AS confidence FROM conversations)"""


def _spoken(spark, d) -> DataFrame:
    turn = F.col("turn")
    parts = st.read(spark, d, "conversations").select(
        F.col("conv_id").alias("session"), turn.alias("ord"), F.floor(turn / 3).alias("segment"), F.when(
            turn % 7 == 3, "  "
        ).otherwise(F.col("text")).alias("text"), F.when(turn % 2 == 0, "hi").alias("language"),
        (turn % 4).alias("n_tokens"), F.when(turn % 5 != 0, 0.2 - (turn % 5) / 4).alias("avg_logprob"),
    )
    return transcripts.clean(parts)


@query(f"WITH {_SPOKEN} SELECT session, ord, text, language, round(confidence, 6) AS confidence FROM c WHERE text <> ''")
def transcript_parts(spark, d):
    return _spoken(spark, d).select("session", "ord", "text", "language", *r6("confidence"))


@query(f"""WITH {_SPOKEN}, g AS (SELECT DISTINCT session, segment FROM c), k AS (SELECT session, segment, string_agg(text, ' ' ORDER BY ord) AS text, avg(confidence) AS confidence, arg_min(language, ord) AS language FROM c WHERE text <> '' GROUP BY ALL)
SELECT session, segment, coalesce(text, '') AS text, round(coalesce(confidence, 0), 6) AS confidence, coalesce(language, '?') AS language FROM g LEFT JOIN k USING (session, segment)""")
def transcript_segments(spark, d):
    c = st.read(spark, d, "conversations")
    segs = c.select(F.col("conv_id").alias("session"), F.floor(F.col("turn") / 3).alias("segment")).distinct()
    return transcripts.by_segment(segs, _spoken(spark, d), ["session", "segment"]).select(
        "session", "segment", "text", *r6("confidence"), "language"
    )


_QUEUE = """q AS (SELECT o_custkey AS session_id, o_orderkey AS chunk_index, ['pending', 'uploading', 'done', 'failed'][(o_orderkey % 4 + 1)::INT] AS status FROM orders)"""


def _queue(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.element_at(
        F.array(*map(F.lit, (ingest.PENDING, ingest.UPLOADING, ingest.DONE, ingest.FAILED))), (k % 4 + 1).cast("int")
    )
    return st.read(spark, d, "orders").select(
        F.col("o_custkey").alias("session_id"), k.alias("chunk_index"), status.alias("status")
    )


@query(f"WITH {_QUEUE} SELECT session_id, chunk_index, status FROM q WHERE status IN ('pending', 'uploading') ORDER BY session_id, chunk_index")
def unfinished_uploads(spark, d):
    return ingest.unfinished(_queue(spark, d))


@query(f"""WITH {_QUEUE}, n AS (SELECT session_id, chunk_index, CASE WHEN status IN ('done', 'failed') THEN status WHEN chunk_index % 3 = 0 THEN 'done' WHEN chunk_index % 3 = 1 AND chunk_index % 2 = 0 THEN 'failed' WHEN chunk_index % 3 = 1 THEN 'uploading' ELSE status END AS status FROM q)
SELECT session_id, count(*) FILTER (WHERE status = 'pending') AS queued, count(*) FILTER (WHERE status = 'done') AS uploaded, count(*) FILTER (WHERE status = 'failed') AS failed FROM n GROUP BY session_id""")
def settled_uploads(spark, d):
    q = _queue(spark, d)
    k = F.col("chunk_index")
    told = q.filter(k % 3 != 2).select(
        "session_id", "chunk_index", F.lit(True).alias("started"),
        F.when(k % 3 == 0, True).when(k % 2 == 0, False).alias("ok"),
    )
    return ingest.upload_stats(ingest.settle(q, told))


@query(f"WITH {_QUEUE}, k AS (SELECT * FROM q WHERE chunk_index % 5 <> 0) SELECT session_id, count(*) FILTER (WHERE status = 'pending') AS queued FROM (SELECT * FROM k UNION ALL SELECT session_id, chunk_index, 'pending' FROM q WHERE chunk_index % 5 = 0) GROUP BY session_id")
def enqueued_chunks(spark, d):
    q = _queue(spark, d)
    return ingest.pending_count(ingest.enqueue(q.filter("chunk_index % 5 <> 0"), q.select("session_id", "chunk_index")))


@query(f"WITH {_QUEUE} SELECT session_id, count(*) AS received, max(chunk_index) AS max_chunk, session_id % 3 = 0 AS is_finalized, CASE WHEN session_id % 3 = 0 THEN 'queued' ELSE 'receiving' END AS assembly_status FROM q GROUP BY session_id")
def ingest_sessions(spark, d):
    q = _queue(spark, d)
    return ingest.sessions(q, q.filter("session_id % 3 = 0"))


@query(f"""WITH {st.CHUNKS}, n AS (SELECT *, CASE WHEN chunk % 2 = 0 THEN '' ELSE 's' || session || '-' || chunk END AS name, lead(chunk) OVER w - chunk - 1 AS missing, start_time - lag(end_time) OVER w > 5 AS late FROM c WINDOW w AS (PARTITION BY session ORDER BY chunk))
SELECT session, coalesce(arg_min(name, chunk) FILTER (WHERE name <> ''), session::VARCHAR) AS session_id, count(*) AS chunk_count, string_agg(chunk, ',' ORDER BY chunk) AS chunks, round(max(end_time) - min(start_time), 6) AS seconds,
 coalesce(sum(missing) FILTER (WHERE missing > 0), 0)::BIGINT AS missing, count(*) FILTER (WHERE late) AS late FROM n GROUP BY session""")
def assemble_session(spark, d):
    k = F.col("chunk")
    c = st.chunks(spark, d).withColumn(
        "session_id",
        F.when(k % 2 == 0, "").otherwise(
            F.concat(F.lit("s"), F.col("session").cast("string"), F.lit("-"), k.cast("string"))
        ),
    )
    return assembly.assemble(c).select(
        "session", "session_id", "chunk_count",
        F.array_join(F.col("chunk_indices").cast("array<string>"), ",").alias("chunks"), *r6("seconds"), "missing",
        "late",
    )


@query(f"""WITH {st.FRAMES} SELECT session, row_number() OVER (PARTITION BY session ORDER BY frame) - 1 AS place, 16000 AS rate, round(CASE WHEN max(abs(value)) OVER (PARTITION BY session) > 0 THEN value / max(abs(value)) OVER (PARTITION BY session) ELSE value END, 6) AS sample
 FROM f WHERE (frame // 64) % 5 <> 3""")
def assembled_audio(spark, d):
    """Chunks of 64 values; each fifth has another rate and is left out."""
    chunk = F.floor(F.col("frame") / 64).alias("chunk")
    held = st.frames(spark, d).groupBy("session", chunk).agg(F.array_sort(F.collect_list(F.struct("frame", "value"))).alias("v"))
    chunks = held.select(
        "session", "chunk", F.when(F.col("chunk") % 5 == 3, 8_000).otherwise(16_000).alias("rate"),
        F.transform("v", lambda x: x["value"]).alias("samples"),
    )
    out = assembly.placed_audio(chunks).select("session", "first", "rate", F.posexplode("samples").alias("k", "sample"))
    return out.select("session", (F.col("first") + F.col("k")).alias("place"), "rate", F.round("sample", 6).alias("sample"))


@query(f"WITH {st.CHUNKS} SELECT session, chunk % 50 AS chunk FROM c INTERSECT SELECT session, (chunk + 7) % 45 FROM c")
def common_chunks(spark, d):
    c = st.chunks(spark, d)
    return assembly.common_chunks(
        c.withColumn("chunk", F.col("chunk") % 50), c.withColumn("chunk", (F.col("chunk") + 7) % 45)
    )


@query(f"""WITH {st.CHUNKS} SELECT session::VARCHAR AS session_id, round(CASE WHEN session % 5 = 0 THEN 0 ELSE max(end_time) END - min(start_time), 2) AS duration, CASE WHEN session % 2 = 0 THEN 'hi' ELSE '?' END AS language, session % 3 = 0 AS has_video, false AS has_audio, false AS has_imu FROM c GROUP BY session""")
def session_summaries(spark, d):
    k = F.col("session")
    s = st.chunks(spark, d).groupBy("session").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time")
    )
    s = s.select(
        k.cast("string").alias("session_id"), "start_time", F.when(k % 5 != 0, F.col("end_time")).alias("end_time"),
        F.when(k % 2 == 0, "hi").alias("language"), F.when(k % 3 == 0, True).alias("has_video"),
    )
    return catalog.session_summary(s).select("session_id", "duration", "language", "has_video", "has_audio", "has_imu")


@query("""WITH p AS (SELECT vec_id, i, (floor(abs(embedding[i % 64 + 1]::DOUBLE) * 1000)::BIGINT % 256 + i * 7) % 256 AS v FROM embeddings, range(768) t(i)),
b AS (SELECT vec_id, (i // 48) // 2 * 8 + (i // 3 % 16) // 2 AS block, i % 3 AS channel, avg(v / 255e0) AS mean, stddev_pop(v / 255e0) AS dev FROM p GROUP BY ALL),
n AS (SELECT vec_id, sqrt(sum(mean * mean + dev * dev)) AS size, sum(mean + dev) AS total, sum(mean) FILTER (WHERE block = 0 AND channel = 0) AS first,
 sum(dev) FILTER (WHERE block = 63 AND channel = 2) AS last FROM b GROUP BY vec_id)
SELECT vec_id, 512 AS n, round(first / size, 6) AS first, round(last / size, 6) AS last, round(total / size, 6) AS total FROM n""")
def image_embedding(spark, d):
    """Frames of 16 x 16 pixels and three channels, so blocks have deviations."""
    value = F.transform(
        F.sequence(F.lit(0), F.lit(767)),
        lambda i: (F.floor(F.abs(F.get("embedding", i % 64).cast("double")) * 1000) % 256 + i * 7) % 256,
    )
    raw = F.unhex(F.array_join(F.transform(value, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    f = st.read(spark, d, "embeddings").select(
        "vec_id", raw.alias("image"), F.lit(16).alias("height"), F.lit(16).alias("width"), F.lit(3).alias("channels")
    )
    e = images.embed_images(f, ["vec_id"])
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return e.select(
        "vec_id", F.size("embedding").alias("n"), F.round(F.get("embedding", F.lit(0)), 6).alias("first"),
        F.round(F.get("embedding", F.lit(383)), 6).alias("last"), F.round(total, 6).alias("total"),
    )


@query(f"""WITH {st.FRAMES} SELECT session, frame, CASE WHEN magnitude > 8 THEN 'high' WHEN magnitude > 2 THEN 'medium' ELSE 'low' END AS level, CASE WHEN magnitude > 8 THEN 0.8 WHEN magnitude > 2 THEN 0.7 ELSE 0.6 END::DOUBLE AS sure FROM (SELECT session, frame, magnitude * 3 AS magnitude FROM f)""")
def motion_levels(spark, d):
    level, sure = tx.motion_level(F.col("magnitude") * 3, F.lit(10))
    return st.frames(spark, d).select("session", "frame", level.alias("level"), sure.alias("sure"))


_ATTEMPTS = f"""WITH {st.CHUNKS}, k AS (SELECT session, chunk, floor(start_time * 1000)::BIGINT AS t, (session + chunk) % 5 AS bad FROM c)"""


@query(_ATTEMPTS + """SELECT 'u' || session AS session_id, (chunk % 1000000)::INT AS chunk_index, CASE WHEN bad >= 3 THEN 'failed' ELSE 'done' END AS status, least(bad + 1, 3)::INT AS attempt,
t + CASE bad WHEN 0 THEN 500 WHEN 1 THEN 3000 WHEN 2 THEN 7500 ELSE 15500 END AS at_ms FROM k""")
def upload_outcomes(spark, d):
    """Uploads of all chunks, of which (session + chunk) % 5 attempts fail, each after half a second."""
    c = st.chunks(spark, d).withColumn("bad", (F.col("session") + F.col("chunk")) % 5)
    start = F.floor(F.col("start_time") * 1000)
    own = F.struct(F.lit("queued").alias("kind"), F.lit(0).alias("attempt"), start.alias("ms"))
    at = {1: 500, 2: 3000, 3: 7500}  # what is heard of each attempt, after its waits
    told = [
        F.when(F.col("bad") >= n - 1, F.struct(F.when(F.col("bad") >= n, "error").otherwise("ok").alias("kind"), F.lit(n).alias("attempt"), (start + ms).alias("ms")))
        for n, ms in at.items()
    ]
    records = c.select(
        F.concat(F.lit("u"), F.col("session").cast("string")).alias("session_id"), (F.col("chunk") % 1_000_000).cast("int").alias("chunk_index"),
        F.explode(F.array_compact(F.array(own, *told))).alias("r"),
    ).select("session_id", "chunk_index", "r.kind", "r.attempt", F.timestamp_millis("r.ms").alias("at"))
    return uploads.latest_status(uploads.settled(records)).select(
        "session_id", "chunk_index", "status", "attempt", F.unix_millis("at").alias("at_ms")
    )


@query()
def training_curve(spark, d):
    """Losses of a small policy, from the payload of all frames (six inertial channels and two of GPS) to the 7 actions."""
    f = st.frames(spark, d)
    imu = f.select("session", "frame", F.array("value", "speed", "lat", "lon", "value", "magnitude").alias("values"))
    gps = f.select("session", "frame", F.array("lat", "lon").alias("values"))
    rows = episodes.frame_payload(f.select("session", "frame"), imu, gps, None, 2).select(
        "session", "frame", F.concat(F.slice("imu", 1, 6), F.slice("gps", 1, 2)).alias("features"), F.col("action").alias("actions")
    )
    path = scratch_path(spark, "mini-batches")
    training.deal(rows, path, 4, ["session", "frame"])
    run = training.train(spark, path, scratch_path(spark, "checkpoints"), epochs=4, rate=0.02, warmup=2, hidden=16)
    return run.table(spark).select("epoch", *r6("lr"), *(F.round(c, 5).alias(c) for c in ("train_loss", "val_loss")))
