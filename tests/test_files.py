"""Readers and sinks of files, and operators whose rows needn't fit one task."""

import json
import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.operators import assembly, catalog, composites, episodes, labeling, series, transcripts
from wearlake.sources import readers, writers


def test_chunk_folders_win_over_flat_files(spark, tmp_path):
    for name in ("video_0001.mp4", "video_0003.mp4", "audio_0002.wav"):
        (tmp_path / name).write_bytes(b"x")
    assert [tuple(r) for r in readers.list_chunks(spark, str(tmp_path)).collect()] == [(1, False), (3, False)]
    flat = readers.chunk_paths(readers.list_chunks(spark, str(tmp_path)), "/base").first()
    assert flat["video"] == "/base/video_0001.mp4" and flat["meta"] == "/base/chunk_meta_0001.json"
    for n in (2, 12):
        folder = tmp_path / "chunks" / f"chunk_{n:04d}"
        folder.mkdir(parents=True)
        (folder / f"video_{n:04d}.mp4").write_bytes(b"x")
    found = readers.list_chunks(spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [(2, True), (12, True)]
    nested = readers.chunk_paths(found, "/base").collect()[1]
    assert nested["imu"] == "/base/chunks/chunk_0012/imu_0012.csv" and nested["gps"] == "/base/chunks/chunk_0012/gps_0012.csv"


def test_json_documents_without_the_damaged_ones(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"chunk": 1, "rate": 2.5}))
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text(json.dumps({"chunk": 3, "more": True}, indent=1))
    got = readers.read_json(spark, str(tmp_path), "chunk long, rate double")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2.5), (3, None)]


def test_session_metadata_below_a_folder(spark, tmp_path):
    for name, frames in (("one", 30), ("two", 60)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(json.dumps({"session_id": name, "video_frames": frames}))
        (tmp_path / name / "other.json").write_text(json.dumps({"session_id": "no"}))
    got = readers.read_sessions(spark, str(tmp_path)).select("session_id", "video_frames", "language")
    assert sorted(tuple(r) for r in got.collect()) == [("one", 30, None), ("two", 60, None)]
    assert [r["video_frames"] for r in readers.find_session(spark, str(tmp_path), "two").collect()] == [60]
    assert readers.find_session(spark, str(tmp_path), "three").count() == 0


def test_processed_series_come_back(spark, tmp_path):
    df = spark.createDataFrame([("s", 1.5, None), ("s", 2.5, 4.0)], "session string, t double, value double")
    writers.write_processed(df, str(tmp_path / "p"))
    assert sorted(readers.read_processed(spark, str(tmp_path / "p")).collect()) == sorted(df.collect())


def test_raw_counts_to_units(spark):
    names = ("accel_x", "accel_y", "accel_z", "gyro_x", "gyro_y", "gyro_z")
    raw = spark.createDataFrame([(16384, -8192, 0, 131, -262, 0)], ", ".join(f"{c} int" for c in names))
    got = readers.raw_imu(raw).first()
    want = (9.81, -4.905, 0.0, math.radians(1), math.radians(-2), 0.0)
    assert all(abs(got[c] - w) < 1e-12 for c, w in zip(names, want))


def test_frame_times_and_their_file(spark, tmp_path):
    assert [r["timestamp"] for r in readers.frame_times(spark, 3, 2.0, 10.0).orderBy("frame_index").collect()] == [10.0, 10.5, 11.0]
    with pytest.raises(ValueError):
        readers.frame_times(spark, 0, 30.0)
    (tmp_path / "f.csv").write_text("frame_index,timestamp\n1,0.5\n0,0.25\n")
    assert [tuple(r) for r in readers.read_frame_times(spark, str(tmp_path / "f.csv")).collect()] == [(0, 0.25), (1, 0.5)]


def test_csv_of_a_closed_range(spark, tmp_path):
    fixes = spark.createDataFrame([(k / 2, 12.0 + k, 77.0) for k in range(6)], "timestamp double, lat double, lon double")
    writers.write_fixes(fixes, str(tmp_path / "g"), 0.5, 1.5)
    got = readers.read_gps(spark, str(tmp_path / "g")).collect()
    assert [r["timestamp"] for r in got] == [0.5, 1.0, 1.5] and got[0]["fix_quality"] == 1 and got[0]["lat"] == 13.0
    writers.write_csv(fixes.filter("lat < 13"), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["timestamp", "lat", "lon"]


def test_json_sinks_and_summaries(spark, tmp_path):
    rows = spark.createDataFrame([("s", 0), ("s", 1)], "session string, episode_index int")
    writers.write_json(rows, str(tmp_path / "j"))
    assert sorted(tuple(r) for r in spark.read.schema(rows.schema).json(str(tmp_path / "j")).collect()) == [("s", 0), ("s", 1)]
    info = json.loads(writers.run_info(rows, "s", "kitchen", 90).first()["info"])
    assert (info["num_episodes"], info["session_id"], info["total_frames"], info["action_dim"]) == (2, "s", 90, 7)
    listed = spark.createDataFrame([("s", 45, "hi there")], "session string, frames long, instruction string")
    card = writers.dataset_card(catalog.dataset_stats(listed)).first()["card"]
    assert "1 episodes, 45 frames, 1.5 seconds, 1 sessions" in card


def test_search_of_one_scenario_only(spark):
    rows = [(k, [float(k), 1.0], "a" if k % 2 else "b") for k in range(1, 9)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, scenario string")
    got = catalog.semantic_top_k(df, [1.0, 0.0], 2, where=F.col("scenario") == "b").collect()
    assert [r["id"] for r in got] == [8, 6]


def test_blend_rounds_as_python_does(spark):
    some = [(a, m, g) for a in (0.85, 0.6, 0.5, 0.4, 0.3) for m in (0.8, 0.7, 0.6, 0.4, 0.3) for g in (0.75, 0.5, 0.3)]
    df = spark.createDataFrame(some, "a double, m double, g double")
    for r in df.withColumn("x", labeling.blend(F.col("a"), F.col("m"), F.col("g"))).collect():
        assert r["x"] == round(0.4 * r["a"] + 0.3 * r["m"] + 0.3 * r["g"], 2), r


def test_ranges_of_any_length(spark):
    df = spark.createDataFrame(
        [("long", 0, 39_999), ("one", 7, 7), ("none", 3, 2), ("below", -3, 1), ("null", None, 4)], "name string, a long, b long"
    )
    for spread in (False, True):
        got = series.numbered(df, F.col("a"), F.col("b"), "k", 1000, spread)
        n = {r["name"]: (r["n"], r["low"], r["high"], r["kinds"]) for r in got.groupBy("name").agg(
            F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"), F.countDistinct("k").alias("kinds")
        ).collect()}
        assert n == {"long": (40_000, 0, 39_999, 40_000), "one": (1, 7, 7, 1), "below": (5, -3, 1, 5)}
    spread = series.numbered(df, F.col("a"), F.col("b"), "k", 1000, True).withColumn("p", F.spark_partition_id())
    rows = [r["count"] for r in spread.groupBy("p").count().collect()]
    assert len(rows) > 4 and max(rows) < 15_000


def test_a_grid_beyond_ten_million_points(spark):
    ends = spark.createDataFrame([("s", 0.0), ("s", 1_000_000.0)], "session string, t double")
    assert series.grid(ends, 1 / 12.0).count() == 12_000_001
    holes = assembly.absent_chunks(spark.createDataFrame([("s", 0), ("s", 11_000_001)], "session string, chunk long"))
    assert holes.count() == 11_000_000


def test_gaps_and_differences_over_blocks(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab") if k % 9 else None, float(rng.randrange(400)), k, rng.random()) for k in range(300)]
    df = spark.createDataFrame(rows, "session string, t double, n long, value double")
    by = {s: sorted(r[1:] for r in rows if r[0] == s) for s in ("a", "b", None)}
    for block in (7.0, 86_400.0):
        got = {r["n"]: r["d_value"] for r in series.deltas(df, ["value"], [0.5], tie="n", block=block).collect()}
        want = {r[1]: r[2] - (v[k - 1][2] if k else 0.5) for v in by.values() for k, r in enumerate(v)}
        assert got == want
        gaps = {r["session"]: (r["median_gap"], r["max_gap"]) for r in series.gaps(df, block=block).collect()}
        for s, v in by.items():
            d = np.diff([r[0] for r in v])
            assert gaps[s] == (float(np.median(d)), float(d.max()))
    lone = series.gaps(spark.createDataFrame([("x", 1.0), ("y", None)], "session string, t double")).collect()
    assert [tuple(r) for r in lone] == [("x", None, None)]


def test_the_cut_is_found_without_numbering_all_rows(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    got = series.train_share(df, ["k"], 0.37, 16, 100)
    assert "Range" in got._jdf.queryExecution().executedPlan().toString()
    keys = sorted(r["k"] for r in df.collect())
    assert sorted(r["k"] for r in got.filter("split = 'train'").collect()) == keys[: int(5000 * 0.37)]
    hot = spark.range(900).select(F.when(F.col("id") < 700, 5).otherwise(F.col("id")).alias("k"))
    seen = {(r["k"] == 5, r["split"]): r["count"] for r in series.train_share(hot, ["k"], 0.5, 8, 50).groupBy("k", "split").count().collect() if r["k"] == 5}
    assert seen == {(True, "train"): 450, (True, "val"): 250}


def test_listing_of_written_episodes(spark, tmp_path):
    rows = [("s", 0, 1, "later", 2.0), ("s", 0, 0, "first", 1.0), ("t", 0, 0, "", 5.0), ("t", 0, 1, None, 6.0), ("t", 1, 0, "x", 7.0)]
    df = spark.createDataFrame(rows, "session_id string, episode_index int, frame_index long, instruction string, timestamp double")
    path = str(tmp_path / "e")
    writers.write_episodes(df, path, ("session_id", "episode_index"))
    want = [("s", 0, 2, "first"), ("t", 0, 2, ""), ("t", 1, 1, "x")]
    assert [tuple(r) for r in episodes.list_episodes(spark, path).collect()] == want
    held = spark.read.parquet(f"{path}/{episodes.LISTING}").filter("session_id = 's'").first()
    assert (held["first_timestamp"], held["last_timestamp"]) == (1.0, 2.0)
    bare = str(tmp_path / "bare")  # written by something else: no listing, the frames are read
    df.write.partitionBy("session_id", "episode_index").parquet(bare)
    assert [tuple(r) for r in episodes.list_episodes(spark, bare).collect()] == want
    (tmp_path / "bare" / "session_id=s" / "episode_index=0" / "part-damaged.parquet").write_bytes(b"no parquet")
    assert [tuple(r) for r in episodes.list_episodes(spark, bare).collect()] == want


def test_inertial_stage_against_plain_numbers(spark):
    rng = np.random.default_rng(5)
    t = np.arange(200) / 100.0
    x = rng.normal(size=(200, 6))
    names = [*composites.ACCEL, *composites.GYRO]
    df = spark.createDataFrame(pd.DataFrame({"session": "s", "t": t} | dict(zip(names, x.T))))
    got = composites.imu_stage(df, 30.0).orderBy("t").toPandas()
    times = np.arange(math.ceil(Fraction(float(t[-1] - t[0])) * 30)) / 30.0
    assert np.allclose(got["t"], times)
    gyro = np.stack([np.interp(times, t, x[:, k]) for k in (3, 4, 5)], axis=1)
    z = (gyro - gyro.mean(axis=0)) / gyro.std(axis=0, ddof=1)
    assert np.allclose(got[[f"{c}_z" for c in composites.GYRO]].to_numpy(), z, atol=1e-9)
    assert abs(got["accel_z_z"].mean()) < 1e-9


def test_speech_in_slices(spark):
    parts = spark.createDataFrame([(0.0, 1.25), (1.25, 2.0)], "start double, end double")
    got = transcripts.speech_slices(parts, 10).orderBy("start").collect()
    assert [(r["first_sample"], r["end_sample"]) for r in got] == [(0, 12), (12, 20)]


def test_audio_in_place_is_the_joined_audio(spark):
    rng = np.random.default_rng(8)
    rows = [("a", k, 8000 if k == 2 else 16_000, rng.normal(size=3 + k).tolist()) for k in (4, 0, 2, 1)]
    rows += [("b", 7, 8000, [0.0, 0.0]), ("b", 9, 8000, []), (None, 1, 8000, [2.0, -4.0]), ("c", 1, 8000, None)]
    chunks = spark.createDataFrame(rows, "session string, chunk long, rate int, samples array<double>")
    whole = {r["session"]: r["samples"] for r in assembly.concat_audio(chunks.filter("size(samples) > 0")).collect()}
    got = assembly.placed_audio(chunks).collect()
    for name in ("a", "b", None):
        own = sorted((r["first"], r["samples"]) for r in got if r["session"] == name)
        assert [x for _, xs in own for x in xs] == whole[name]
        assert [f for f, _ in own] == list(np.cumsum([0] + [len(xs) for _, xs in own])[:-1])
    assert {(r["session"], r["chunk"]) for r in got} == {("a", 0), ("a", 1), ("a", 4), ("b", 7), (None, 1)}
