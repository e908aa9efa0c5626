"""Queries of the recording engine for the driver, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import formats, geo, text, vector
from wearlake.operators import assembly, catalog, episodes, folds, intervals, labeling, series, terms, validation
from wearlake.plans import standins as st
from wearlake.registry import query, r6
from wearlake.sources import writers

_RUNS = f"""WITH {st.SENSOR}, a AS (SELECT *, speed < 2 AS slow FROM s),
b AS (SELECT *, CASE WHEN slow <> lag(slow) OVER w THEN 1 ELSE 0 END AS turned FROM a WINDOW w AS (PARTITION BY session ORDER BY t)),
d AS (SELECT *, sum(turned) OVER (PARTITION BY session ORDER BY t) AS run FROM b),
g AS (SELECT *, slow AND max(t) OVER (PARTITION BY session, run) - min(t) OVER (PARTITION BY session, run) >= 5 AS is_stationary FROM d),
h AS (SELECT *, CASE WHEN lag(is_stationary) OVER (PARTITION BY session ORDER BY t) AND NOT is_stationary THEN 1 ELSE 0 END AS started FROM g),
m AS (SELECT *, sum(started) OVER (PARTITION BY session ORDER BY t) AS segment_id FROM h)"""


@query(_RUNS + """ SELECT session, segment_id::BIGINT AS segment_id, is_stationary, count(*) AS n, round(min(t), 6) AS t_first, round(max(t), 6) AS t_last, round(avg(value), 6) AS mean_value
 FROM m GROUP BY ALL""")
def gps_stationary_segments(spark, d):
    rows = series.stationary(st.sensor(spark, d), tie="event_id")
    out = rows.groupBy("session", F.col("segment_id").cast("long").alias("segment_id"), "is_stationary")
    return out.agg(
        F.count("*").alias("n"), F.round(F.min("t"), 6).alias("t_first"), F.round(F.max("t"), 6).alias("t_last"),
        F.round(F.avg("value"), 6).alias("mean_value"),
    )


HAV = """CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL AND {c} IS NOT NULL AND {d} IS NOT NULL THEN
 2 * 6371000.0::DOUBLE * asin(sqrt(greatest(0e0, least(1e0, pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2))))) END"""


MOTION = f"""p AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(t) OVER w AS pt FROM s WINDOW w AS (PARTITION BY session ORDER BY t, event_id)),
q AS (SELECT *, coalesce({HAV.format(a='plat', b='lat', c='plon', d='lon')}, 0) AS distance_m,
 fmod(degrees(atan2(sin(radians(lon - plon)) * cos(radians(lat)), cos(radians(plat)) * sin(radians(lat)) - sin(radians(plat)) * cos(radians(lat)) * cos(radians(lon - plon)))) + 360, 360) AS head FROM p),
motion AS (SELECT *, coalesce(distance_m / greatest(t - pt, 1e-6) * 3.6, 0) AS speed_kmh, coalesce(head, lead(head) OVER w, 0) AS heading, sum(distance_m) OVER (PARTITION BY session ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS total_m
 FROM q WINDOW w AS (PARTITION BY session ORDER BY t, event_id))"""


@query(f"""WITH {st.SENSOR}, {MOTION} SELECT session, event_id, round(distance_m, 6) AS distance_m, round(speed_kmh, 6) AS speed_kmh, round(heading, 6) AS heading, round(total_m, 4) AS total_m FROM motion""")
def gps_motion(spark, d):
    return series.motion(st.sensor(spark, d), tie="event_id").select(
        "session", "event_id", *r6("distance_m", "speed_kmh", "heading"), F.round("total_m", 4).alias("total_m")
    )


_GRID = f"""WITH {st.SENSOR}, ends AS (SELECT session, min(t) AS a, max(t) AS b FROM s GROUP BY session),
g AS (SELECT session, a + k * 3600e0 AS t FROM (SELECT session, a, unnest(range(0, ceil((b - a) / 3600e0)::BIGINT + 1)) AS k FROM ends))"""


@query(_GRID + """, p AS (SELECT g.session, g.t, s.t AS pt, s.value AS pv FROM g ASOF LEFT JOIN s ON g.session = s.session AND g.t >= s.t),
n AS (SELECT g.session, g.t, s.t AS nt, s.value AS nv FROM g ASOF LEFT JOIN s ON g.session = s.session AND g.t <= s.t)
SELECT p.session, round(p.t, 6) AS t, round(CASE WHEN pt IS NULL THEN nv WHEN nt IS NULL OR pt = p.t THEN pv ELSE pv + (nv - pv) * ((p.t - pt) / (nt - pt)) END, 6) AS value
FROM p JOIN n ON p.session = n.session AND p.t = n.t""")
def interp_resample(spark, d):
    s = st.sensor(spark, d)
    return series.interpolate(s, series.grid(s, 3600.0), ["value"], tie="event_id").select("session", *r6("t", "value"))


@query(_GRID.replace(" + 1)", ")") + """, p AS (SELECT g.session, g.t, s.t AS pt, s.value AS v, s.magnitude AS m FROM g ASOF LEFT JOIN s ON g.session = s.session AND g.t >= s.t),
n AS (SELECT g.session, g.t, s.t AS nt, s.value AS v, s.magnitude AS m FROM g ASOF LEFT JOIN s ON g.session = s.session AND g.t <= s.t)
SELECT p.session, round(p.t, 6) AS t, round(CASE WHEN nt IS NULL OR pt = p.t THEN p.v ELSE p.v + (n.v - p.v) * ((p.t - pt) / (nt - pt)) END, 6) AS value,
 round(CASE WHEN nt IS NULL OR pt = p.t THEN p.m ELSE p.m + (n.m - p.m) * ((p.t - pt) / (nt - pt)) END, 6) AS magnitude
FROM p JOIN n ON p.session = n.session AND p.t = n.t""")
def imu_grid(spark, d):
    s = st.sensor(spark, d)
    times = series.grid(s, 3600.0, closed=False)
    return series.interpolate(s, times, ["value", "magnitude"], tie="event_id").select("session", *r6("t", "value", "magnitude"))


@query(_GRID + """ SELECT g.session, round(g.t, 6) AS t, s.kind FROM g ASOF JOIN s ON g.session = s.session AND g.t >= s.t""")
def asof_ffill(spark, d):
    s = st.sensor(spark, d)
    return series.as_of(s, series.grid(s, 3600.0), ["kind"], tie="event_id").select("session", *r6("t"), "kind")


@query(f"""WITH {st.TRANSCRIPTS}, {st.SPANS}, o AS (SELECT l.session, l.segment, r.ord, trim(r.text) AS text FROM l JOIN r USING (session)
 WHERE least(l_end, r_end) - greatest(l_start, r_start) > 0.1)
SELECT l.session, l.segment, coalesce(string_agg(o.text, ' ' ORDER BY o.ord), '') AS text FROM l LEFT JOIN o USING (session, segment) GROUP BY ALL""")
def overlap_text(spark, d):
    return intervals.overlap_text(
        st.spans(spark, d), st.transcripts(spark, d), ["session", "segment"], 5.0
    ).select("session", "segment", "text")


@query(f"""WITH {st.TRANSCRIPTS}, {st.SPANS}, o AS (SELECT l.session, l.segment, trim(r.text) AS text, row_number() OVER (PARTITION BY l.session, l.segment ORDER BY least(l_end, r_end) - greatest(l_start, r_start) DESC, r.ord) AS n
 FROM l JOIN r USING (session) WHERE least(l_end, r_end) - greatest(l_start, r_start) > 0)
SELECT l.session, l.segment, coalesce(nullif(o.text, ''), 'record egocentric task') AS text FROM l LEFT JOIN o ON l.session = o.session AND l.segment = o.segment AND o.n = 1""")
def overlap_best(spark, d):
    return intervals.best_overlap(
        st.spans(spark, d), st.transcripts(spark, d), ["session", "segment"], 5.0, "record egocentric task"
    ).select("session", "segment", "text")


@query(f"""WITH {st.FRAMES}, u AS (SELECT session, frame // 15 AS segment, min(frame) AS a, max(frame) + 1 AS b FROM f GROUP BY ALL)
SELECT u.session, u.segment, count(*) AS frames, round(avg(f.value), 6) AS mean_value FROM u JOIN f ON u.session = f.session AND f.frame >= a AND f.frame < b GROUP BY ALL""")
def frame_band_join(spark, d):
    f = st.frames(spark, d)
    segments = series.uniform(f, 15).drop("motion_magnitude")
    return intervals.frames_in(segments, f).groupBy("session", "segment").agg(
        F.count("*").alias("frames"), F.round(F.avg("value"), 6).alias("mean_value")
    )


@query(f"""WITH {st.FRAMES} SELECT session, frame // 30 AS segment, min(frame) AS start_frame, max(frame) + 1 AS end_frame, round(avg(magnitude), 6) AS motion_magnitude FROM f GROUP BY ALL""")
def uniform_segments(spark, d):
    return series.uniform(st.frames(spark, d), 30).select(
        "session", "segment", "start_frame", "end_frame", *r6("motion_magnitude")
    )


_HYST = f"""WITH {st.FRAMES}, a AS (SELECT *, CASE WHEN magnitude > 3 THEN 1 WHEN magnitude < 1 THEN 0 END AS sig FROM f),
b AS (SELECT *, coalesce(last_value(sig IGNORE NULLS) OVER (PARTITION BY session ORDER BY frame ROWS UNBOUNDED PRECEDING), 0) AS on_ FROM a),
g AS (SELECT *, coalesce(lag(on_) OVER (PARTITION BY session ORDER BY frame), 0) AS was FROM b),
h AS (SELECT *, sum(CASE WHEN on_ = 1 AND was = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY session ORDER BY frame) AS k FROM g),
x AS (SELECT session, min(frame) AS start_frame, max(CASE WHEN on_ = 1 THEN frame END) + 1 AS end_frame, avg(magnitude) AS m FROM h WHERE on_ = 1 OR was = 1 GROUP BY session, k)"""


@query(_HYST + """ SELECT session, start_frame, end_frame, round(least(1, m / 6), 6) AS confidence, round(m, 6) AS motion_magnitude FROM x
UNION ALL SELECT session, 0, max(frame) + 1, 0.5, round(avg(magnitude), 6) FROM f WHERE session NOT IN (SELECT session FROM x) GROUP BY session""")
def hysteresis_segments(spark, d):
    return series.hysteresis(st.frames(spark, d)).select(
        "session", "start_frame", "end_frame", *r6("confidence", "motion_magnitude")
    )


@query(f"WITH {st.CHUNKS}, n AS (SELECT *, lead(chunk) OVER (PARTITION BY session ORDER BY chunk) - chunk - 1 AS missing FROM c) SELECT session, chunk AS after_chunk, missing FROM n WHERE missing > 0")
def chunk_gaps(spark, d):
    return assembly.missing_runs(st.chunks(spark, d))


@query(f"WITH {st.CHUNKS}, n AS (SELECT *, start_time - lag(end_time) OVER (PARTITION BY session ORDER BY chunk) AS gap FROM c) SELECT session, chunk, round(gap, 6) AS gap FROM n WHERE gap > 5")
def temporal_gaps(spark, d):
    return assembly.time_gaps(st.chunks(spark, d)).select("session", "chunk", *r6("gap"))


@query(f"""WITH {st.CHUNKS}, n AS (SELECT *, lead(chunk) OVER (PARTITION BY session ORDER BY chunk) - chunk - 1 AS missing FROM c) SELECT session, count(DISTINCT chunk) AS found, max(chunk) - min(chunk) + 1 - count(DISTINCT chunk) AS missing, round(100e0 * count(DISTINCT chunk) / (max(chunk) - min(chunk) + 1), 2) AS percent,
 round(max(end_time) - min(start_time), 6) AS seconds, floor((max(end_time) - min(start_time)) * 30)::BIGINT AS frames,
 coalesce(string_agg(chunk || '+' || missing, ',' ORDER BY chunk) FILTER (WHERE missing > 0), '') AS gaps FROM n GROUP BY session""")
def coverage_stats(spark, d):
    return assembly.coverage(st.chunks(spark, d)).select(
        "session", "found", "missing", "percent", *r6("seconds"), "frames",
        F.array_join(
            F.transform("gaps", lambda g: F.concat_ws("+", g["after_chunk"], g["missing"])), ","
        ).alias("gaps"),
    )


@query(f"""WITH {st.CHUNKS}, x AS (SELECT session, unnest(range(min(chunk), max(chunk) + 1)) AS chunk FROM c GROUP BY session) SELECT session, count(*) AS absent FROM x ANTI JOIN c USING (session, chunk) GROUP BY session""")
def missing_chunk_ids(spark, d):
    return assembly.absent_chunks(st.chunks(spark, d)).groupBy("session").agg(F.count("*").alias("absent"))


@query(f"""WITH {st.SENSOR} SELECT session, event_id, round(t, 6) AS t, kind FROM (SELECT *, row_number() OVER (PARTITION BY session, floor(t / 60) ORDER BY t, event_id) AS n FROM s) WHERE n = 1""")
def dedup_keep_first(spark, d):
    s = st.sensor(spark, d).withColumn("minute", F.floor(F.col("t") / 60))
    return series.first_by_time(
        s, ["session", "minute"], ["t", "event_id"]
    ).select("session", "event_id", *r6("t"), "kind")


@query(f"""WITH {st.SENSOR} SELECT session, event_id, round((value - avg(value) OVER w) / CASE WHEN stddev_samp(value) OVER w < 1e-8 THEN 1 ELSE coalesce(stddev_samp(value) OVER w, 1) END, 6) AS value_z FROM s WINDOW w AS (PARTITION BY session)""")
def zscore_normalize(spark, d):
    return series.z_score(st.sensor(spark, d), ["value"]).select("session", "event_id", *r6("value_z"))


@query(f"""WITH {st.SENSOR} SELECT session, event_id, round((lat - min(lat) OVER w) / greatest(max(lat) OVER w - min(lat) OVER w, 1e-9) * 2 - 1, 6) AS lat_n, round((lon - min(lon) OVER w) / greatest(max(lon) OVER w - min(lon) OVER w, 1e-9) * 2 - 1, 6) AS lon_n,
 round((event_id % 500 - min(event_id % 500) OVER w) / greatest(max(event_id % 500) OVER w - min(event_id % 500) OVER w, 1e-9), 6) AS alt_n, round(greatest(0, least(1, (event_id % 160) / 120e0)), 6) AS speed_n,
 round(sin(radians(speed * 40)), 6) AS heading_sin, round(cos(radians(speed * 40)), 6) AS heading_cos FROM s WINDOW w AS (PARTITION BY session)""")
def geo_embedding(spark, d):
    s = st.sensor(spark, d).withColumns(
        {"alt": F.col("event_id") % 500, "speed_kmh": F.col("event_id") % 160, "heading": F.col("speed") * 40}
    )
    names = ("lat_n", "lon_n", "alt_n", "speed_n", "heading_sin", "heading_cos")
    return series.geo_embedding(s).select(
        "session", "event_id", *(F.round(F.get("embedding", F.lit(k)), 6).alias(n) for k, n in enumerate(names))
    )


@query(f"""WITH {st.SENSOR} SELECT session, event_id, round(CASE WHEN max(abs(value)) OVER w < 1e-8 THEN value ELSE value / max(abs(value)) OVER w END, 6) AS value_p FROM s WINDOW w AS (PARTITION BY session)""")
def peak_normalize(spark, d):
    return series.peak(st.sensor(spark, d), "value").select("session", "event_id", *r6("value_p"))


@query(f"""WITH {st.SENSOR}, g AS (SELECT session, t - lag(t) OVER (PARTITION BY session ORDER BY t) AS d FROM s) SELECT session, round(median(d), 6) AS median_gap, round(max(d), 6) AS max_gap FROM g GROUP BY session""")
def median_gap(spark, d):
    return series.gaps(st.sensor(spark, d)).select("session", *r6("median_gap", "max_gap"))


@query(f"""WITH {st.SENSOR} SELECT session, event_id, round(value - coalesce(lag(value) OVER w, 0), 6) AS d_value, round(speed - coalesce(lag(speed) OVER w, 1), 6) AS d_speed FROM s WINDOW w AS (PARTITION BY session ORDER BY t, event_id)""")
def quat_delta(spark, d):
    return series.deltas(
        st.sensor(spark, d), ["value", "speed"], [0.0, 1.0], tie="event_id"
    ).select("session", "event_id", *r6("d_value", "d_speed"))


@query(f"""WITH {st.EPISODES} SELECT id, CASE WHEN row_number() OVER (ORDER BY id) <= greatest(1, floor(count(*) OVER () * 0.8)) THEN 'train' ELSE 'val' END AS split FROM e""")
def train_val_split(spark, d):
    return series.train_share(st.episodes(spark, d).select("id"), ["id"])


@query(f"""WITH {st.EPISODES} SELECT session, id, (row_number() OVER (PARTITION BY session ORDER BY id) - 1 + 5)::BIGINT AS episode_index FROM e WHERE frames >= 10""")
def episode_numbering(spark, d):
    e = st.episodes(spark, d).filter("frames >= 10")
    return episodes.numbered(e, ["id"], "episode_index", base=5).select("session", "id", "episode_index")


def _query_vector(spark, d) -> list[float]:
    return st.read(spark, d, "embeddings").filter("vec_id = 0").first()["embedding"]


@query("""WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0) SELECT vec_id AS id, label, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 6) AS similarity FROM embeddings, q
ORDER BY list_cosine_similarity(embedding::DOUBLE[], q.v) DESC, vec_id LIMIT 10""")
def semantic_topk(spark, d):
    e = st.read(spark, d, "embeddings").withColumnRenamed("vec_id", "id")
    return catalog.semantic_top_k(e, _query_vector(spark, d), 10).select("id", "label", *r6("similarity"))


@query(f"""WITH {st.EPISODES}, m AS (SELECT id, {HAV.format(a='12.97::DOUBLE', b='lat', c='77.59::DOUBLE', d='lon')} AS distance_m FROM e) SELECT id, round(distance_m, 4) AS distance_m FROM m WHERE distance_m <= 30000""")
def geo_radius(spark, d):
    return catalog.geo_radius(st.episodes(spark, d), 12.97, 77.59, 30_000.0).select(
        "id", F.round("distance_m", 4).alias("distance_m")
    )


@query("SELECT doc_id AS id, lang FROM documents WHERE contains(lower(text), 'of the') ORDER BY doc_id LIMIT 20")
def text_search(spark, d):
    docs = st.read(spark, d, "documents").withColumnRenamed("doc_id", "id")
    return catalog.text_search(docs, "of the", 20, ["text"]).select("id", "lang")


@query(f"""WITH {st.EPISODES} SELECT scenario, grouping(scenario)::INT AS is_total, count(*) AS episodes, count(DISTINCT session) AS sessions, round(sum(frames / 30e0), 6) AS seconds, round(sum(frames / 30e0) / 3600, 6) AS hours FROM e GROUP BY ROLLUP (scenario)""")
def catalog_stats_rollup(spark, d):
    e = st.episodes(spark, d).withColumn("seconds", F.col("frames") / 30.0)
    return catalog.stats_by(e, "scenario", "session", "seconds").withColumns(
        {c: F.round(c, 6) for c in ("seconds", "hours")}
    )


@query(f"WITH {st.EPISODES} SELECT id, frames, scenario FROM e WHERE session = 7 ORDER BY id")
def session_episodes(spark, d):
    return st.episodes(spark, d).filter("session = 7").select("id", "frames", "scenario").orderBy("id")


@query(f"WITH {st.EPISODES} SELECT count(*) FILTER (WHERE status <> 'F') AS kept, count(*) FILTER (WHERE status = 'F') AS deleted FROM e")
def delete_session_count(spark, d):
    stay, gone = catalog.delete(st.episodes(spark, d), F.col("status") == "F")
    return stay.agg(F.count("*").alias("kept"), F.lit(gone).cast("long").alias("deleted"))


@query(f"""WITH {st.EPISODES}, u AS (SELECT *, 0 AS fresh FROM e UNION ALL SELECT id, session, frames + 1, 'updated', status, lat, lon, price, 1 FROM e WHERE id % 5 = 0)
SELECT id, frames, scenario FROM (SELECT *, row_number() OVER (PARTITION BY session, id ORDER BY fresh DESC) AS n FROM u) WHERE n = 1""")
def upsert_latest(spark, d):
    e = st.episodes(spark, d)
    new = e.filter("id % 5 = 0").withColumn("frames", F.col("frames") + 1).withColumn("scenario", F.lit("updated"))
    return catalog.upsert(e, new, ["session", "id"], "id").select("id", "frames", "scenario")


@query(f"WITH {st.EPISODES} SELECT id FROM e WHERE session NOT IN (SELECT session FROM e WHERE frames > 400)")
def cascade_delete(spark, d):
    e = st.episodes(spark, d)
    return catalog.cascade(e, e.filter("frames > 400").select("session"), "session").select("id")


@query(f"""WITH {st.EPISODES} SELECT count(*) AS episodes, sum(frames)::BIGINT AS frames, round(sum(frames / 30e0), 6) AS seconds, count(DISTINCT session) AS sessions,
 (SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT DISTINCT substr(scenario, 1, 2) AS p FROM e)) AS languages FROM e""")
def dataset_stats(spark, d):
    e = st.episodes(spark, d).withColumn(
        "session", F.col("session").cast("string")
    ).withColumn("instruction", F.col("scenario"))
    return catalog.dataset_stats(e).withColumn("seconds", F.round("seconds", 6))


@query(f"""WITH {st.EPISODES} SELECT count(DISTINCT session) AS sessions, count(*) AS episodes, round(sum(frames / 30e0) / 3600, 1) AS hours, round(100e0 * count(*) FILTER (WHERE status = 'O') / count(*)) AS percent_done FROM e""")
def session_kpis(spark, d):
    e = st.episodes(spark, d)
    return e.agg(
        F.countDistinct("session").alias("sessions"), F.count("*").alias("episodes"),
        F.round(F.sum(F.col("frames") / 30.0) / 3600, 1).alias("hours"),
        F.round(100 * F.count_if(F.col("status") == "O") / F.count("*")).alias("percent_done"),
    )


def _like(words: list[str]) -> str:
    return " OR ".join(f"contains(t, '{w}')" for w in words)


_ACTION = "CASE " + " ".join(f"WHEN {_like(w)} THEN '{a}'" for a, w in text.ACTIONS.items()) + " END"
_SCENARIO = "CASE " + " ".join(f"WHEN {_like(w)} THEN '{a}'" for a, w in text.SCENARIOS.items()) + " END"
_LABELS = f"""WITH k AS (SELECT doc_id, text AS said, lower(text) AS t, ['high', 'medium', 'low'][(doc_id % 3 + 1)::INT] AS motion_level, doc_id % 4 = 0 AS is_stationary,
 CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 25)::DOUBLE END AS speed_kmh, [0.8, 0.7, 0.6][(doc_id % 3 + 1)::INT]::DOUBLE AS motion_conf FROM documents),
w AS (SELECT *, {_ACTION} AS a_word, {_SCENARIO} AS s_word FROM k),
x AS (SELECT *, coalesce(a_word, CASE WHEN is_stationary THEN 'idle' WHEN motion_level IN ('high', 'medium') THEN 'navigate' ELSE 'other' END) AS action_type,
 CASE WHEN a_word IS NOT NULL THEN 0.85 WHEN is_stationary THEN 0.6 WHEN motion_level = 'high' THEN 0.5 WHEN motion_level = 'medium' THEN 0.4 ELSE 0.3 END::DOUBLE AS action_conf,
 coalesce(s_word, CASE WHEN speed_kmh > 15 THEN 'driving' WHEN speed_kmh > 3 THEN 'food_delivery' ELSE 'general' END) AS scenario FROM w)"""


def _segments(spark, d) -> DataFrame:
    docs = st.read(spark, d, "documents")
    k = F.col("doc_id")
    return docs.select(
        "doc_id", "text", F.element_at(
            F.array(F.lit("high"), F.lit("medium"), F.lit("low")), (k % 3 + 1).cast("int")
        ).alias("motion_level"),
        (k % 4 == 0).alias("is_stationary"), F.when(k % 5 != 0, (k % 25).cast("double")).alias("speed_kmh"), F.element_at(
            F.array(F.lit(0.8), F.lit(0.7), F.lit(0.6)), (k % 3 + 1).cast("int")
        ).alias("motion_conf"), F.lit(0.5).alias("gps_conf"),
    )


_TOLD = "'motion' || CASE WHEN said <> '' THEN ',whisper' ELSE '' END || CASE WHEN speed_kmh IS NOT NULL THEN ',gps' ELSE '' END"


@query(_LABELS + f" SELECT doc_id, action_type, action_conf, scenario, round(0.4 * action_conf + 0.3 * motion_conf + 0.15, 2) AS confidence, {_TOLD} AS sources FROM x")
def action_scenario_label(spark, d):
    return labeling.auto_label(_segments(spark, d), "general").select(
        "doc_id", "action_type", "action_conf", "scenario", "confidence", "sources"
    )


def _replaced(x: str) -> str:
    for a, b in text.HINTS:
        x = f"replace({x}, '{a}', '{b}')"
    return x


_TEMPLATE = lambda k: "CASE action_type " + " ".join(
    f"WHEN '{a}' THEN '{t[k]}'" for a, t in text.TEMPLATES.items()
) + f" ELSE '{text.DEFAULT_TEMPLATE[k]}' END"


@query(_LABELS + f""" SELECT doc_id, CASE WHEN length(said) > 3 THEN said ELSE {_TEMPLATE(0)} END AS instruction_hi,
 CASE WHEN length(said) > 3 THEN CASE WHEN {_replaced('said')} <> said THEN {_replaced('said')} ELSE '[' || action_type || ']' END ELSE {_TEMPLATE(1)} END AS instruction_en,
 {_TOLD} AS sources FROM x""")
def instruction_build(spark, d):
    return labeling.auto_label(_segments(spark, d), "general").select(
        "doc_id", "instruction_hi", "instruction_en", "sources"
    )


@query(_LABELS + """ SELECT 'action_type' AS "column", action_type AS value, count(*) AS n FROM x GROUP BY action_type UNION ALL SELECT 'scenario', scenario, count(*) FROM x GROUP BY scenario
 UNION ALL SELECT 'motion_level', motion_level, count(*) FROM x GROUP BY motion_level""")
def auto_label_summary(spark, d):
    return labeling.counts(
        labeling.auto_label(_segments(spark, d), "general"), ["action_type", "scenario", "motion_level"]
    )


_VOCAB = "[" + ", ".join(f"'{w}'" for w in text.VOCABULARY) + "]"
_CAP = text.DIMENSIONS - len(text.VOCABULARY)
_MD5 = "0"
for _k in range(4):
    _MD5 = f"((({_MD5}) * {2**32 % _CAP} + ('0x' || substr(md5(g), {8 * _k + 1}, 8))::BIGINT) % {_CAP})"


@query(f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{text.TOKEN}')) AS tok FROM documents),
z AS (SELECT doc_id, list_position({_VOCAB}, tok) - 1 AS slot FROM t WHERE list_contains({_VOCAB}, tok)
 UNION ALL SELECT doc_id, {len(text.VOCABULARY)} + {_MD5} FROM (SELECT doc_id, substr(tok, j, 2) AS g FROM (SELECT doc_id, tok, unnest(range(1, length(tok))) AS j FROM t))),
c AS (SELECT doc_id, slot, count(*) AS n FROM z GROUP BY ALL)
SELECT doc_id, slot::BIGINT AS slot, n, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 6) AS weight FROM c""")
def embed_text_tf(spark, d):
    from pyspark.sql import Window

    n = terms.embed_term_counts(st.read(spark, d, "documents")).groupBy("doc_id", "slot").agg(F.sum("n").alias("n"))
    return n.withColumn(
        "weight", F.round(F.col("n") / F.sqrt(F.sum(F.col("n") * F.col("n")).over(Window.partitionBy("doc_id"))), 6)
    )


@query("""SELECT doc_id, array_to_string(list_transform(range(1, 51), lambda j: CASE WHEN j <= length(text) THEN unicode(substr(text, j::INT, 1)) % 32000 ELSE 0 END), ',') AS tokens,
 array_to_string(list_transform(range(1, 51), lambda j: (j <= length(text))::INT), ',') AS mask FROM documents""")
def tokenize_codepoints(spark, d):
    ids, mask = text.code_points(F.col("text"), 50), text.attention_mask(F.col("text"), 50)
    return st.read(spark, d, "documents").select(
        "doc_id", *(F.array_join(c.cast("array<string>"), ",").alias(n) for c, n in ((ids, "tokens"), (mask, "mask")))
    )


@query(f"""WITH {st.EPISODES} SELECT session, CASE WHEN count(*) >= 2 THEN 'LINESTRING(' || string_agg(frames || ' ' || id, ', ' ORDER BY id) || ')' END AS line FROM e GROUP BY session""")
def wkt_lines(spark, d):
    points = F.array_sort(F.collect_list(F.struct(F.col("id").alias("lat"), F.col("frames").alias("lon"))))
    return st.episodes(spark, d).groupBy("session").agg(points.alias("points")).select(
        "session", geo.wkt_line(F.col("points")).alias("line")
    )


@query(f"""WITH {st.EPISODES} SELECT id, 'POINT(' || frames || ' ' || session || ')' AS point FROM e""")
def wkt_format(spark, d):
    return st.episodes(spark, d).select("id", geo.wkt_point(F.col("session"), F.col("frames")).alias("point"))


@query("SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: printf('%.8f', x::DOUBLE)), ',') || ']' AS literal FROM embeddings")
def vector_literal(spark, d):
    return st.read(spark, d, "embeddings").select("vec_id", vector.literal(F.col("embedding")).alias("literal"))


def _annotation_json(spark, d) -> DataFrame:
    lab = st.read(spark, d, "labels")
    body = F.concat(F.lit('[{"from_name":"action_type","value":{"choices":["a'), F.col("quality").cast("string"), F.lit('"]}},{"from_name":"quality","value":{"rating":'), F.col("toxic").cast("string"), F.lit("}},"),
                    F.lit('{"from_name":"instruction_hi","value":{"text":["'), F.when(F.col("doc_id") % 2 == 0, F.lit("hi")).otherwise(F.lit("")), F.lit(
                        '"]}},{"from_name":"instruction_en","value":{"text":["en"]}},'
                    ),
                    F.lit('{"from_name":"objects","value":{"x":1.5,"width":2}}]'))
    return lab.select("doc_id", body.alias("annotation"))


@query("SELECT doc_id, 'a' || quality AS action_type, '' AS scenario, CASE WHEN doc_id % 2 = 0 THEN 'hi' ELSE '' END AS instruction_hi, 'en' AS instruction_en, toxic::INT AS quality, 1 AS n_boxes, 'unknown' AS box_label FROM labels")
def annotation_parse(spark, d):
    p = labeling.parse_annotations(_annotation_json(spark, d))
    return p.select(
        "doc_id", "action_type", "scenario", "instruction_hi", "instruction_en", "quality",
        F.size("bboxes").alias("n_boxes"), F.col("bboxes")[0]["label"].alias("box_label"),
    )


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.source WHEN d.doc_id % 2 = 0 THEN 'hi' ELSE 'en' END AS instruction, l.doc_id IS NOT NULL AS annotated FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def annotation_apply(spark, d):
    a = labeling.latest(labeling.parse_annotations(_annotation_json(spark, d)), "doc_id", "annotation")
    e = st.read(spark, d, "documents").select("doc_id", F.col("source").alias("instruction"))
    return labeling.apply_annotations(e, a, "doc_id").select("doc_id", "instruction", "annotated")


@query("""SELECT 'quality' AS "column", quality::VARCHAR AS value, count(*) AS n FROM labels GROUP BY quality UNION ALL SELECT 'toxic', toxic::VARCHAR, count(*) FROM labels GROUP BY toxic""")
def label_stats(spark, d):
    return labeling.counts(st.read(spark, d, "labels"), ["quality", "toxic"])


@query("""WITH t AS (SELECT d.doc_id, count(l.doc_id) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.doc_id)
SELECT count(*) AS tasks, count(*) FILTER (WHERE n > 0) AS annotated, count(*) FILTER (WHERE n = 0) AS pending, sum(n)::BIGINT AS annotations, round(100e0 * count(*) FILTER (WHERE n > 0) / count(*), 1) AS percent FROM t""")
def labeling_completion(spark, d):
    n = st.read(spark, d, "labels").groupBy("doc_id").agg(F.count("*").alias("n"))
    t = st.read(spark, d, "documents").select("doc_id").distinct().join(n, "doc_id", "left")
    return labeling.completion(t.withColumn("n_annotations", F.coalesce("n", F.lit(0))))


def _validated(spark, d) -> DataFrame:
    e = st.episodes(spark, d)
    k = F.col("id")
    flags = {f"has_{c}": k % 11 != n for n, c in enumerate(validation.REQUIRED)}
    values = F.array(
        (k % 130).cast("double"), F.when(k % 17 == 0, F.lit(float("nan"))).otherwise(0.0),
        F.when(k % 19 == 0, F.lit(float("-inf"))).otherwise(0.0),
    )
    return e.withColumns(flags | {
        "path": k.cast("string"), "height": (
            k % 100 + 20
        ).cast("int"), "width": (k % 70 * 30).cast("int"), "channels": (k % 5).cast("int"), "audio_rows": F.col("frames") - (k % 23 == 0).cast("long"),
        "imu_rows": F.col("frames") + (k % 13 == 0).cast("long"), "action_rows": F.col("frames") + (k % 29 == 0).cast("long"), "instruction": F.when(
            k % 6 == 0, " "
        ).otherwise("go"), "action_values": values,
    })


_NAMED = ", ".join(f"'{c}'" for c in validation.REQUIRED)
_VALID = f"""WITH {st.EPISODES}, v AS (
 SELECT id, 'missing_dataset' AS "check", [{_NAMED}][(id % 11 + 1)::INT] AS detail FROM e WHERE id % 11 < {len(validation.REQUIRED)} UNION ALL SELECT id, 'min_frames', frames::VARCHAR FROM e WHERE frames < 5
 UNION ALL SELECT id, 'channels', (id % 5)::VARCHAR FROM e WHERE id % 5 NOT IN (1, 3, 4) UNION ALL SELECT id, 'height', (id % 100 + 20)::VARCHAR FROM e WHERE id % 100 + 20 < 32
 UNION ALL SELECT id, 'width', (id % 70 * 30)::VARCHAR FROM e WHERE id % 70 * 30 < 32 OR id % 70 * 30 > 1920
 UNION ALL SELECT id, 'alignment', 'audio:' || (frames - 1) FROM e WHERE id % 23 = 0 UNION ALL SELECT id, 'alignment', 'imu:' || (frames + 1) FROM e WHERE id % 13 = 0 UNION ALL SELECT id, 'alignment', 'action:' || (frames + 1) FROM e WHERE id % 29 = 0
 UNION ALL SELECT id, 'instruction', 'empty' FROM e WHERE id % 6 = 0
 UNION ALL SELECT id, 'action_range', 'over limit' FROM e WHERE id % 130 > 100 UNION ALL SELECT id, 'nan', 'action' FROM e WHERE id % 17 = 0 UNION ALL SELECT id, 'inf', 'action' FROM e WHERE id % 19 = 0)"""


@query(_VALID + ' SELECT id::VARCHAR AS path, "check", detail FROM v')
def validation_errors(spark, d):
    return validation.validate(_validated(spark, d))


@query(_VALID + " SELECT count(*) AS total, count(*) FILTER (WHERE n IS NULL) AS valid, count(n) AS invalid, sum(coalesce(n, 0))::BIGINT AS errors FROM e LEFT JOIN (SELECT id, count(*) AS n FROM v GROUP BY id) USING (id)")
def validation_report(spark, d):
    return validation.report(_validated(spark, d))


@query(f"""WITH {st.FRAMES} SELECT session, frame, round(value * 2, 6) AS w0, round(coalesce(lead(value) OVER (PARTITION BY session ORDER BY frame), 0) * 2, 6) AS w1 FROM f""")
def audio_window(spark, d):
    w = intervals.window_rows(st.frames(spark, d), "frame", "value", 2)
    return w.select(
        "session", "frame", F.round(F.col("window")[0] * 2, 6).alias("w0"),
        F.round(F.col("window")[1] * 2, 6).alias("w1"),
    )


_NAMES = "CASE id % 4 WHEN 0 THEN 's-' || session WHEN 1 THEN '0F8FAD5B-D9CB-469F-A165-' || lpad(id::VARCHAR, 12, '0') WHEN 2 THEN '-' || session ELSE 'x' END"


@query(f"""WITH {st.EPISODES} SELECT id, coalesce(regexp_matches({_NAMES}, '^[a-zA-Z0-9][a-zA-Z0-9_-]{{1,127}}$'), false) AS ok, coalesce(TRY_CAST(list_last(string_split(CASE WHEN id % 3 = 0 THEN 'ep_x' ELSE 'ep_' || id END, '_')) AS BIGINT), -1) AS episode_index,
 lpad((frames // 60)::VARCHAR, 2, '0') || ':' || lpad((frames % 60)::VARCHAR, 2, '0') AS clock FROM e""")
def format_checks(spark, d):
    k, text_ = F.col("id"), F.col("session").cast("string")
    uuid = F.concat(F.lit("0F8FAD5B-D9CB-469F-A165-"), F.lpad(k.cast("string"), 12, "0"))
    name = F.when(
        k % 4 == 0, F.concat(F.lit("s-"), text_)
    ).when(k % 4 == 1, uuid).when(k % 4 == 2, F.concat(F.lit("-"), text_)).otherwise("x")
    stem = F.when(k % 3 == 0, "ep_x").otherwise(F.concat(F.lit("ep_"), k.cast("string")))
    return st.episodes(spark, d).select(
        "id", formats.session_name_ok(name).alias("ok"), formats.episode_index(stem).alias("episode_index"),
        formats.clock(F.col("frames")).alias("clock"),
    )


@query(f"""WITH {st.EPISODES} SELECT id, round(CASE WHEN frames * 5 < 500 THEN 3e-4 * (frames * 5 + 1) / 500 ELSE 1e-6 + (3e-4 - 1e-6) / 2 * (1 + cos(pi() * (frames * 5 - 499) / 3000)) END, 9) AS rate FROM e""")
def warmup_rate(spark, d):
    return st.episodes(spark, d).select(
        "id", F.round(formats.learning_rate(F.col("frames") * 5, 3000), 9).alias("rate")
    )


@query(f"""WITH {st.SENSOR} SELECT session, floor(t / 30)::BIGINT AS part, count(*) AS n, round(avg(value), 6) AS mean FROM s GROUP BY ALL""")
def tumbling_chunks(spark, d):
    s = st.sensor(spark, d)
    return s.groupBy("session", F.floor(F.col("t") / 30).cast("long").alias("part")).agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean")
    )


@query(f"""WITH {st.SENSOR} SELECT session, arg_max(event_id, t) AS event_id, count(*) AS received FROM s GROUP BY session""")
def latest_fix(spark, d):
    return st.sensor(spark, d).groupBy("session").agg(
        F.max_by("event_id", "t").alias("event_id"), F.count("*").alias("received")
    )


@query("SELECT kind, n FROM (SELECT event_type AS kind, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, kind LIMIT 3)")
def top_places(spark, d):
    return catalog.top_values(st.read(spark, d, "events").withColumnRenamed("event_type", "kind"), "kind")


@query(f"""WITH RECURSIVE {st.SENSOR}, o AS (SELECT session, event_id, t, lat AS za, lon AS zb, row_number() OVER (PARTITION BY session ORDER BY t, event_id) AS n FROM s),
k AS (SELECT session, event_id, n, t, za AS a, zb AS b, 0e0 AS va, 0e0 AS vb, 1e-4::DOUBLE AS p00, 0e0 AS p01, 1e-4::DOUBLE AS p11 FROM o WHERE n = 1
 UNION ALL SELECT session, event_id, n, t, a + dt * va + g * (za - (a + dt * va)), b + dt * vb + g * (zb - (b + dt * vb)), va + h * (za - (a + dt * va)), vb + h * (zb - (b + dt * vb)), (1 - g) * q00, (1 - g) * q01, q11 - h * q01 FROM (
  SELECT *, q00 / (q00 + 1e-2::DOUBLE) AS g, q01 / (q00 + 1e-2::DOUBLE) AS h FROM (
   SELECT o.session, o.event_id, o.n, o.t, za, zb, a, b, va, vb, dt, p00 + 2 * dt * p01 + dt * dt * p11 + 1e-4::DOUBLE * pow(dt, 4) / 4 AS q00, p01 + dt * p11 + 1e-4::DOUBLE * pow(dt, 3) / 2 AS q01, p11 + 1e-4::DOUBLE * dt * dt AS q11
   FROM (SELECT o.*, a, b, va, vb, p00, p01, p11, CASE WHEN o.t > k.t THEN o.t - k.t ELSE 1e0 END AS dt FROM k JOIN o ON o.session = k.session AND o.n = k.n + 1) o)))
SELECT session, event_id, round(a, 6) AS lat_smooth, round(b, 6) AS lon_smooth FROM k""")
def kalman_smooth(spark, d):
    out = folds.kalman(
        st.sensor(spark, d).select("session", "event_id", "t", "lat", "lon"), ["lat", "lon"], tie="event_id"
    )
    return out.select("session", "event_id", *r6("lat_smooth", "lon_smooth"))


_JOIN = "{{'a': {p}.a, 'b': {q}.b, 'c': greatest({p}.c, {q}.c), 'm': ({p}.m * ({p}.b - {p}.a) + {q}.m * ({q}.b - {q}.a)) / ({p}.b - {p}.a + {q}.b - {q}.a)}}"


@query(_HYST.replace("WITH ", "WITH RECURSIVE ", 1) + f""", y AS (SELECT session, start_frame AS a, end_frame AS b, least(1e0, m / 6) AS c, m FROM x
 UNION ALL SELECT session, 0, max(frame) + 1, 5e-1, avg(magnitude) FROM f WHERE session NOT IN (SELECT session FROM x) GROUP BY session),
u AS (SELECT session, list({{'a': a::BIGINT, 'b': b::BIGINT, 'c': c::DOUBLE, 'm': m::DOUBLE}} ORDER BY a) AS q, list({{'a': a::BIGINT, 'b': b::BIGINT, 'c': c::DOUBLE, 'm': m::DOUBLE}}) FILTER (WHERE false) AS d, false AS again FROM y GROUP BY session
 UNION ALL SELECT session,
  CASE WHEN len(q) = 0 THEN d WHEN short AND len(q) > 1 THEN q[3:] ELSE q[2:] END,
  CASE WHEN len(q) = 0 THEN q WHEN short AND len(q) > 1 THEN list_append(coalesce(d, []), {_JOIN.format(p='q[1]', q='q[2]')})
   WHEN short AND len(d) > 0 THEN list_append(d[:-2], {_JOIN.format(p='d[-1]', q='q[1]')}) ELSE list_append(coalesce(d, []), q[1]) END,
  CASE WHEN len(q) = 0 THEN false ELSE again OR (short AND (len(q) > 1 OR coalesce(len(d), 0) > 0)) END
 FROM (SELECT *, len(q) > 0 AND q[1].b - q[1].a < 15 AS short FROM u) WHERE len(q) > 0 OR again),
z AS (SELECT session, unnest(d) AS r FROM u WHERE len(q) = 0 AND NOT again)
SELECT session, r.a AS start_frame, r.b AS end_frame, round(r.c, 6) AS confidence, round(r.m, 6) AS motion_magnitude FROM z""")
def merge_short_segments(spark, d):
    return folds.merge_short(series.hysteresis(st.frames(spark, d))).select(
        "session", "start_frame", "end_frame", *r6("confidence", "motion_magnitude")
    )


@query(f"""WITH RECURSIVE {st.SENSOR}, r AS (SELECT session, event_id, row_number() OVER (PARTITION BY session ORDER BY t, event_id) AS n, value / 100 AS gx, speed / 10 AS gy, magnitude AS gz FROM s),
o AS (SELECT *, sqrt(gx * gx + gy * gy + gz * gz) AS w FROM r),
p AS (SELECT session, event_id, n, w * 1e-2 > 1e-10 AS turned, CASE WHEN w > 0 THEN gx * sin(w * 5e-3) / w END AS a, CASE WHEN w > 0 THEN gy * sin(w * 5e-3) / w END AS b, CASE WHEN w > 0 THEN gz * sin(w * 5e-3) / w END AS c, cos(w * 5e-3) AS d FROM o),
k AS (SELECT session, 0::BIGINT AS event_id, 0::BIGINT AS n, 0e0 AS x, 0e0 AS y, 0e0 AS z, 1e0 AS w FROM p WHERE n = 1
 UNION ALL SELECT session, event_id, n, CASE WHEN turned THEN x2 / sqrt(x2 * x2 + y2 * y2 + z2 * z2 + w2 * w2) ELSE x END, CASE WHEN turned THEN y2 / sqrt(x2 * x2 + y2 * y2 + z2 * z2 + w2 * w2) ELSE y END,
  CASE WHEN turned THEN z2 / sqrt(x2 * x2 + y2 * y2 + z2 * z2 + w2 * w2) ELSE z END, CASE WHEN turned THEN w2 / sqrt(x2 * x2 + y2 * y2 + z2 * z2 + w2 * w2) ELSE w END FROM (
   SELECT p.session, p.event_id, p.n, turned, x, y, z, w, w * a + x * d + y * c - z * b AS x2, w * b - x * c + y * d + z * a AS y2, w * c + x * b - y * a + z * d AS z2, w * d - x * a - y * b - z * c AS w2
   FROM k JOIN p ON p.session = k.session AND p.n = k.n + 1))
SELECT session, event_id, round(x, 6) AS qx, round(y, 6) AS qy, round(z, 6) AS qz, round(w, 6) AS qw FROM k WHERE n > 0""")
def quaternion_integrate(spark, d):
    s = st.sensor(spark, d).select(
        "session", "event_id", "t", (F.col("value") / 100).alias("gx"), (F.col("speed") / 10).alias("gy"),
        F.col("magnitude").alias("gz"),
    )
    return folds.orientation(s, tie="event_id").select("session", "event_id", *r6("qx", "qy", "qz", "qw"))


# a second-order Butterworth high-pass at 0.5 of 100 Hz, run forwards and backwards over a series extended by 9 at both ends
_K = math.tan(math.pi * 0.01 / 2)
_B0 = 1 / (1 + math.sqrt(2) * _K + _K * _K)
_A1, _A2 = 2 * (_K * _K - 1) * _B0, (1 - math.sqrt(2) * _K + _K * _K) * _B0
_B0, _A1, _A2 = (f"({x!r}::DOUBLE)" for x in (_B0, _A1, _A2))
_PASS = f"""{_B0} * {{v}} + z1 AS y, -2 * {_B0} * {{v}} - {_A1} * ({_B0} * {{v}} + z1) + z2 AS z1, {_B0} * {{v}} - {_A2} * ({_B0} * {{v}} + z1) AS z2"""


@query(f"""WITH RECURSIVE {st.SENSOR}, f AS (SELECT session, event_id, value AS x, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY session) AS n FROM s WINDOW w AS (PARTITION BY session ORDER BY t, event_id)),
e AS (SELECT session, i, n, x AS v FROM f WHERE n > 9 UNION ALL SELECT a.session, -b.i, a.n, 2 * a.x - b.x FROM f a JOIN f b ON a.session = b.session AND a.i = 0 AND b.i BETWEEN 1 AND 9 WHERE a.n > 9
 UNION ALL SELECT a.session, 2 * (a.n - 1) - b.i, a.n, 2 * a.x - b.x FROM f a JOIN f b ON a.session = b.session AND a.i = a.n - 1 AND b.i BETWEEN a.n - 10 AND a.n - 2 WHERE a.n > 9),
u AS (SELECT session, i, n, {_PASS.format(v='v')} FROM (SELECT *, -{_B0} * v AS z1, {_B0} * v AS z2 FROM e WHERE i = -9)
 UNION ALL SELECT session, i, n, {_PASS.format(v='v')} FROM (SELECT e.session, e.i, e.n, e.v, z1, z2 FROM u JOIN e ON e.session = u.session AND e.i = u.i + 1)),
r AS (SELECT session, i, {_PASS.format(v='v')} FROM (SELECT session, i, y AS v, -{_B0} * y AS z1, {_B0} * y AS z2 FROM u WHERE i = n + 8)
 UNION ALL SELECT session, i, {_PASS.format(v='v')} FROM (SELECT u.session, u.i, u.y AS v, r.z1, r.z2 FROM r JOIN u ON u.session = r.session AND u.i = r.i - 1))
SELECT f.session, event_id, round(coalesce(r.y, x), 6) AS value_hp FROM f LEFT JOIN r ON r.session = f.session AND r.i = f.i""")
def gravity_highpass(spark, d):
    return folds.remove_gravity(
        st.sensor(spark, d).select("session", "event_id", "t", "value"), ["value"], tie="event_id"
    ).select("session", "event_id", *r6("value_hp"))


@query(f"""WITH {st.FRAMES}, h AS (SELECT k, CASE WHEN k = 0 THEN 1e0 ELSE sin(pi() * k / 3) / (pi() * k / 3) END * (SELECT sum(pow(2.5e0 * sqrt(1 - (k / 30e0) * (k / 30e0)), 2 * j) / (factorial(j::INT)::DOUBLE * factorial(j::INT)::DOUBLE)) FROM range(0, 25) t(j)) AS w FROM range(-30, 31) t(k)),
n AS (SELECT session, count(*) AS n FROM f GROUP BY session), m AS (SELECT session, unnest(range(0, ceil(n / 3e0)::BIGINT)) AS place FROM n)
SELECT m.session, 16000 AS rate, place, round(sum(value * w) / (SELECT sum(w) FROM h), 6) AS sample FROM m JOIN f ON f.session = m.session AND frame BETWEEN 3 * place - 30 AND 3 * place + 30 JOIN h ON k = 3 * place - frame GROUP BY ALL""")
def audio_resample(spark, d):
    f = st.frames(spark, d)
    pcm = f.groupBy("session", F.floor(F.col("frame") / 4096).alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("frame", "value"))), lambda x: x["value"]).alias("samples")
    ).withColumn("rate", F.lit(48_000))
    out = folds.resample_blocks(pcm, 16_000).select("session", "rate", "first", F.posexplode("samples").alias("k", "sample"))
    return out.select("session", "rate", (F.col("first") + F.col("k")).alias("place"), F.round("sample", 6).alias("sample"))


_FEATURES = ", ".join(f'"{k.replace(".", "_")}":"{v}"' for k, v in writers.FEATURES.items()).replace(", ", ",")


@query(f"""WITH {st.EPISODES} SELECT '{{"total_episodes":' || count(*) || ',"total_frames":' || sum(frames) || ',"languages":["' || (SELECT string_agg(p, '","' ORDER BY p) FROM (SELECT DISTINCT substr(scenario, 1, 2) AS p FROM e)) ||
 '"],"fps":30.0,"features":{{{_FEATURES}}}}}' AS info FROM e""")
def dataset_info(spark, d):
    return writers.dataset_info(st.episodes(spark, d).withColumn("instruction", F.col("scenario")))


_INSTRUCTION = f"CASE WHEN length(said) > 3 THEN said ELSE {_TEMPLATE(0)} END"


@query(_LABELS + f""" SELECT doc_id, '{{"score":' || round(0.4 * action_conf + 0.3 * motion_conf + 0.15, 2)::VARCHAR || ',"result":[{{"from_name":"action_type","type":"choices","value":"' || action_type || '"}},{{"from_name":"scenario","type":"choices","value":"' || scenario ||
 '"}},{{"from_name":"instruction_hi","type":"textarea","value":' || to_json({_INSTRUCTION})::VARCHAR || '}}]}}' AS prediction FROM x""")
def prediction_json(spark, d):
    return labeling.predictions(labeling.auto_label(_segments(spark, d), "general")).select("doc_id", "prediction")
