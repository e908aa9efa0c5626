"""Stages, episodes, images, sources and sinks against brute force and on small files."""

import io
import json
import math
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.functions import formats, geo
from wearlake.operators import assembly, catalog, composites, episodes, folds, images, intervals, jobs, labeling, series, transcripts, validation
from wearlake.sources import readers, writers

IMU = "session long, t double, accel_x double, accel_y double, accel_z double, gyro_x double, gyro_y double, gyro_z double"


def frame(spark, rows, kinds):
    return spark.createDataFrame(rows, kinds)


def test_interpolation_across_blocks_and_ties(spark):
    rng = np.random.default_rng(4)
    for block in (1.0, 7.0, 1e9):
        t, g = np.sort(rng.uniform(-20, 90, 60)), np.sort(np.concatenate((rng.uniform(-30, 100, 80), [0.0])))
        v = rng.normal(size=60)
        s = frame(spark, pd.DataFrame({"session": 1, "t": t, "v": v}), "session long, t double, v double")
        d = frame(spark, pd.DataFrame({"session": 1, "t": g}), "session long, t double")
        out = series.interpolate(s, d, ["v"], block=block).toPandas().sort_values("t")
        assert np.allclose(out["v"], np.interp(g, t, v))
        last = series.as_of(s, d, ["v"], block=block).toPandas().sort_values("t")
        assert np.allclose(last["v"], v[np.clip(np.searchsorted(t, g, side="right") - 1, 0, 59)])
    tied = frame(
        spark, [(1, 0.0, 5, 1.0), (1, 0.0, 7, 2.0), (1, 0.0, 6, 3.0)], "session long, t double, id long, v double"
    )
    at = frame(spark, [(1, 0.0), (2, 1.0)], "session long, t double")
    assert {r["session"]: r["v"] for r in series.as_of(tied, at, ["v"], tie="id").collect()} == {1: 2.0, 2: None}
    empty = tied.filter("false")
    assert series.interpolate(empty, at, ["v"], tie="id").count() == 2 and series.interpolate(
        tied, at.filter("false"), ["v"]
    ).count() == 0


def test_a_damaged_number_is_an_error(spark):
    df = frame(spark, [(1, 0.0), (1, 1e15)], "session long, t double")
    with pytest.raises(Exception, match="too long"):
        series.grid(df, 1.0).count()


def high_pass_by_equations(x, rate, cut=0.5):
    """The zero-phase filter from its difference equation; the start state solves the steady-state equations."""
    w = math.tan(math.pi * min(cut / (rate / 2), 0.99) / 2)
    a0 = 1 + math.sqrt(2) * w + w * w
    b, a = np.array([1, -2, 1]) / a0, np.array([a0, 2 * (w * w - 1), 1 - math.sqrt(2) * w + w * w]) / a0
    zi = np.linalg.solve(np.array([[1 + a[1], -1], [a[2], 1]]), np.array([b[1] - a[1] * b[0], b[2] - a[2] * b[0]]))

    def once(s):
        z, out = zi * s[0], []
        for v in s:
            y = b[0] * v + z[0]
            z = np.array([b[1] * v - a[1] * y + z[1], b[2] * v - a[2] * y])
            out.append(y)
        return np.array(out)

    wide = np.concatenate((2 * x[0] - x[9:0:-1], x, 2 * x[-1] - x[-2:-11:-1]))
    return once(once(wide)[::-1])[::-1][9:-9]


def test_high_pass_against_equations():
    x = 9.81 + np.random.default_rng(2).normal(0, 1, 200)
    for rate in (100.0, 30.0):
        assert np.allclose(folds.high_pass(x, rate), high_pass_by_equations(x, rate), atol=1e-9)


def test_resample_against_the_sum():
    x = np.random.default_rng(3).normal(size=90)
    for rate, to in ((48_000, 16_000), (44_100, 16_000), (8_000, 16_000), (16_000, 16_000)):
        d = math.gcd(rate, to)
        up, down = to // d, rate // d
        most = max(up, down)
        taps = np.sinc(np.arange(-10 * most, 10 * most + 1) / most) * np.kaiser(20 * most + 1, 5.0)
        taps *= up / taps.sum()
        want = [
            sum(
                x[k] * taps[m * down - k * up + 10 * most] for k in range(len(x)) if abs(m * down - k * up) <= 10 * most
            ) for m in range(-(-len(x) * up // down))
        ]
        assert np.allclose(folds.resample(x, rate, to), want if up != down else x)


def test_folds_are_the_same_over_small_batches(spark):
    rng = np.random.default_rng(6)
    rows = [(s, float(k), float(rng.normal()), float(rng.normal())) for s, n in ((1, 40), (2, 1), (3, 17), (None, 5)) for k in range(n)]
    df = frame(spark, rows, "session long, t double, x double, y double")
    whole = folds.kalman(df, ["x", "y"]).toPandas()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        cut = folds.kalman(df, ["x", "y"]).toPandas()
        turned = folds.orientation(df.withColumn("z", F.lit(0.3)), ("x", "y", "z")).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = ["session", "t"]
    assert np.allclose(whole.sort_values(by)[["x_smooth", "y_smooth"]], cut.sort_values(by)[["x_smooth", "y_smooth"]])
    assert np.allclose((turned[["qx", "qy", "qz", "qw"]] ** 2).sum(axis=1), 1)
    assert folds.kalman(df.filter("false"), ["x"]).count() == 0


def merged(rows, least):
    """Passes over the list until none changes anything."""
    rows = list(rows)
    while True:
        out, k, changed = [], 0, False
        while k < len(rows):
            s, e, c, m = rows[k]
            if e - s < least and k + 1 < len(rows):
                s2, e2, c2, m2 = rows[k + 1]
                out.append((s, e2, max(c, c2), (m * (e - s) + m2 * (e2 - s2)) / ((e - s) + (e2 - s2))))
                k, changed = k + 2, True
            elif e - s < least and out:
                s0, e0, c0, m0 = out.pop()
                out.append((s0, e, max(c0, c), (m0 * (e0 - s0) + m * (e - s)) / ((e0 - s0) + (e - s))))
                k, changed = k + 1, True
            else:
                out.append(rows[k])
                k += 1
        rows = out
        if not changed:
            return rows


def test_merge_short_against_passes(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for s in range(25):
        at, own = 0, []
        for _ in range(rng.integers(1, 8)):
            size = int(rng.integers(1, 30))
            own.append((at, at + size, float(rng.uniform()), float(rng.uniform(0, 5))))
            at += size
        rows += [(s, *r) for r in own]
        want[s] = merged(own, 15)
    got = folds.merge_short(
        frame(spark, rows, "session long, start_frame long, end_frame long, confidence double, motion_magnitude double")
    ).toPandas()
    for s, w in want.items():
        assert np.allclose(got[got.session == s].sort_values("start_frame").drop(columns="session"), w)


def test_windows_of_blocks(spark):
    rng = np.random.default_rng(1)
    pcm = {1: rng.normal(size=100).tolist(), 2: [], 3: [1.0]}
    audio = frame(spark, list(pcm.items()), "session long, samples array<double>")
    rows = [(s, k, int(a)) for s in (1, 2, 3, 4) for k, a in enumerate((-3, 0, 5, 15, 16, 90, 99, 100, 500))]
    got = intervals.block_windows(
        frame(spark, rows, "session long, frame long, at long"), intervals.sample_blocks(audio, 16), "at", 21,
        ["session", "frame"], 16,
    ).collect()
    assert len(got) == len(rows)
    for r in got:
        own = pcm.get(r["session"], [])[max(r["at"], 0) :][:21]
        assert np.allclose(r["window"], own + [0.0] * (21 - len(own)))


def test_imu_stage_is_its_steps(spark):
    rng = np.random.default_rng(5)
    t = np.arange(60) / 100
    x = np.concatenate(
        (rng.normal(0, 0.3, (60, 2)), rng.normal(9.81, 0.1, (60, 1)), rng.normal(0, 0.5, (60, 3))), axis=1
    )
    rows = [(1, *map(float, (a, *b))) for a, b in zip(t, x)] + [(2, 0.0, 1.0, 2.0, 3.0, 0.0, 0.0, 0.0)]
    got = composites.imu_stage(frame(spark, rows, IMU)).toPandas()
    own = got[got.session == 1].sort_values("t")
    flat = np.column_stack([high_pass_by_equations(x[:, k], 100.0) for k in range(3)] + [x[:, k] for k in range(3, 6)])
    grid = t[0] + np.arange(math.ceil((t[-1] - t[0]) * 30)) / 30
    want = np.column_stack([np.interp(grid, t, flat[:, k]) for k in range(6)])
    names = [*composites.ACCEL, *composites.GYRO]
    assert np.allclose(own[names], want, atol=1e-9)
    assert np.allclose(own[[f"{c}_z" for c in names]], (want - want.mean(axis=0)) / want.std(axis=0, ddof=1), atol=1e-6)
    q, out = np.array([0.0, 0, 0, 1]), []
    for g in want[:, 3:]:
        a = np.linalg.norm(g) / 30
        v, w = g / np.linalg.norm(g) * math.sin(a / 2), math.cos(a / 2)
        q = np.array([*(q[3] * v + w * q[:3] + np.cross(q[:3], v)), q[3] * w - q[:3] @ v])
        out.append(q)
    assert np.allclose(own[["qx", "qy", "qz", "qw"]], out, atol=1e-9)
    assert got[got.session == 2][["accel_x", "accel_z_z"]].to_numpy().tolist() == [[1.0, 0.0]]


def test_audio_stage_is_its_steps(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=700)
    audio = frame(
        spark, [(1, 48_000, x.tolist()), (2, 16_000, [0.0] * 50)], "session long, rate int, samples array<double>"
    )
    times = [(1, k, k / 1000 - 0.001) for k in range(20)] + [(2, 0, 0.0)]
    got = composites.audio_stage(audio, frame(spark, times, "session long, frame long, t double"), block=64).toPandas()
    y = folds.resample(x, 48_000, 16_000)
    y = y / np.abs(y).max()
    count = max(1, int(float(np.median(np.diff([t for s, _, t in times if s == 1]))) * 16_000))
    for r in got[got.session == 1].itertuples():
        at = int(r.t * 16_000)
        own = y[max(0, at) : max(0, at + count)][:count]
        assert len(r.window) == count and np.allclose(r.window, np.pad(own, (0, count - len(own))))
    assert list(got[got.session == 2]["window"].iloc[0]) == [0.0] * int(16_000 / 30)


def test_flow_segments(spark):
    m = [(1, k, 5.0 if 10 <= k < 40 or 45 <= k < 50 else 0.5) for k in range(60)] + [(2, 0, 9.0)]
    got = {
        (r["session"], r["start_frame"], r["end_frame"], r["confidence"], r["motion_magnitude"])
        for r in composites.flow_segments(frame(spark, m, "session long, frame long, magnitude double")).collect()
    }
    assert (2, 0, 1, 0.5, 0.0) in got and [(a, b) for s, a, b, *_ in got if s == 1] == [(10, 50)]


def test_gps_stage(spark):
    rows = [(1, float(k), 12.9 + max(0, k - 8) * 5e-4, 77.5) for k in range(20)]
    got = composites.gps_stage(
        frame(spark, rows, "session long, t double, lat double, lon double"), fps=2.0
    ).toPandas().sort_values("t")
    assert len(got) == 39 and got["t"].iloc[-1] == 19.0
    assert got["is_stationary"].iloc[0] and not got["is_stationary"].iloc[-1] and got["segment_id"].iloc[-1] == 1
    assert got["place_name"].iloc[0] == "tile_12.900_77.500" and got["total_m"].is_monotonic_increasing


def test_align_streams_without_gps_and_audio(spark):
    frames = frame(spark, [(1, 0, 0.5), (2, 0, 0.0)], "session long, frame long, t double")
    imu = frame(
        spark, [(1, 0.0, 0.0, 0, 0, 0, 0, 0), (1, 1.0, 2.0, 0, 0, 0, 0, 4)],
        "session long, t double, accel_x double, accel_y long, accel_z long, gyro_x long, gyro_y long, gyro_z long",
    )
    got = {r["session"]: r for r in composites.align_streams(frames, imu, None, None).collect()}
    assert got[1]["imu"] == [
        1.0, 0, 0, 0, 0, 2.0
    ] and got[2]["imu"] == [0.0] * 6 and got[1]["gps"] == [0.0] * 6 and got[1]["audio"] == []


def test_episode_round_trip(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = [(f"s{s}", e, k, rng.normal(size=10).tolist(), "उठाओ") for s in (1, 2) for e in (0, 1) for k in range(5 + e)]
    df = frame(
        spark, rows, "session_id string, episode_index int, frame_index long, imu array<double>, instruction string"
    )
    path = str(tmp_path / "ep")
    writers.write_episodes(df, path, ("session_id", "episode_index"))
    back = episodes.load_episode(spark, path, "s2", 1).toPandas()
    want = {k: np.array(v) for s, e, k, v, _ in rows if (s, e) == ("s2", 1)}
    assert back["frame_index"].tolist() == list(range(6)) and np.allclose(
        np.stack(back["imu"]), [want[k] for k in range(6)]
    ) and (back["instruction"] == "उठाओ").all()
    assert np.allclose(back["timestamp"], np.arange(6) / 30) and list(back["gps"].iloc[0]) == [0.0] * 6
    q = np.array([want[k][6:] for k in range(6)])
    assert np.allclose(
        np.stack(back["action"])[:, 3:], np.vstack((np.array([0, 0, 0, 1]) - q[0], np.diff(q, axis=0)))
    ) and not np.stack(back["action"])[:, :3].any()
    listed = [tuple(r) for r in episodes.list_episodes(spark, path).collect()]
    assert listed == [("s1", 0, 5, "उठाओ"), ("s2", 0, 5, "उठाओ"), ("s1", 1, 6, "उठाओ"), ("s2", 1, 6, "उठाओ")]
    plan = episodes.list_episodes(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert episodes.LISTING in plan and "imu" not in plan and spark.read.parquet(path).count() == 22
    index = episodes.frame_index(frame(spark, [("a", 2), ("b", 1)], "path string, frames long"))
    assert sorted(tuple(r) for r in index.collect()) == [("a", 0), ("a", 1), ("b", 0)]
    with pytest.raises(ValueError):
        writers.write_episodes(df.filter("false"), str(tmp_path / "none"))
    kept = str(tmp_path / "kept")
    assert writers.delete_sessions(
        spark.read.parquet(path), kept, ["s1"]
    ) == 11 and spark.read.parquet(kept).count() == 11


def test_cutting_skips_short_segments_and_numbers_the_rest(spark):
    segs = frame(
        spark, [(1, 0, 0, 5), (1, 1, 5, 40), (1, 2, 40, 90)],
        "session long, segment long, start_frame long, end_frame long",
    )
    lengths = frame(spark, [(1, 60)], "session long, n_frames long")
    texts = frame(spark, [(1, 0, "zero"), (1, 1, ""), (1, 5, "later")], "session long, ord long, text string")
    got = [
        tuple(r) for r in episodes.cut_episodes(segs, lengths, texts, "default", base=7).orderBy("episode_index").select(
            "segment", "start_frame", "end_frame", "episode_index", "instruction"
        ).collect()
    ]
    assert got == [(1, 5, 40, 7, ""), (2, 40, 60, 8, "later")]


def test_actions_of_narrow_inertial_rows(spark):
    df = frame(spark, [(1, 0, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])], "session long, frame_index long, imu array<double>")
    assert episodes.derive_actions(df, 6).first()["action"] == [
        0, 0, 0, 0, 4, 5, 6
    ] and episodes.derive_actions(df, 3).first()["action"] == [0.0] * 7


def test_fixed_is_cs(spark):
    rng = np.random.default_rng(1)
    values = [
        0.0, 1.0005, 0.0005, 0.0015, 2.5e-4, -1.0005, 12.9, 77.5625, 0.0625, 1e-9, 123456.7895,
        *rng.uniform(-200, 200, 500), *(np.round(rng.uniform(0, 90, 500), 3) + 0.0005),
    ]
    got = frame(spark, [(float(v),) for v in values], "v double").select(
        formats.fixed(F.col("v"), 3).alias("a"), formats.fixed(F.col("v"), 0).alias("b")
    ).collect()
    assert [r["a"] for r in got] == [f"{v:.3f}" for v in values] and [r["b"].lstrip("-") for r in got] == [
        f"{v:.0f}".lstrip("-") for v in values
    ]


def test_places(spark):
    fixes = frame(
        spark, [(1, 12.90004, 77.5, 0.0), (1, 12.90004, 77.5, 5.26), (1, 1.0, 2.0, 9.0), (2, 3.0, 4.0, None)],
        "session long, lat double, lon double, total_m double",
    )
    assert catalog.places_wanted(fixes).count() == 3
    names = "struct<neighbourhood:string,suburb:string,city_district:string,city:string,display_name:string>"
    found = frame(
        spark, [(12.9, 77.5, ("", "Jayanagar", None, "B", "x")), (1.0, 2.0, (None, None, None, None, "d" * 70))],
        f"lat_r double, lon_r double, place {names}",
    )
    tagged = catalog.tag_places(fixes, found)
    assert sorted(r["place_name"] for r in tagged.collect()) == sorted(
        ["Jayanagar"] * 2 + ["d" * 60, "tile_3.000_4.000"]
    )
    got = {r["session"]: r for r in catalog.gps_summary(tagged).collect()}
    assert [
        tuple(x) for x in got[1]["top_places"]
    ] == [(2, "Jayanagar"), (1, "d" * 60)] and got[1]["total_dist_m"] == 9.0 and got[2]["total_dist_m"] == 0.0


def test_radius_near_the_date_line(spark):
    rows = [(k, float(a), float(b)) for k, (a, b) in enumerate(((0, 179.99), (0, -179.99), (89.99, 0), (89.99, 180), (10, 20), (10, 20.05), (10, 21)))]
    df = frame(spark, rows, "id long, lat double, lon double")
    found = lambda a, b, m: [r["id"] for r in catalog.geo_radius(df, a, b, m).collect()]
    assert sorted(found(0.0, 180.0, 5000.0)) == [0, 1] and sorted(
        found(89.995, 90.0, 5000.0)
    ) == [2, 3] and found(10.0, 20.0, 6000.0) == [4, 5]


def test_images(spark):
    rng = np.random.default_rng(3)
    for shape in ((64, 64, 3), (20, 35, 1), (5, 9, 4), (8, 8)):
        x = rng.integers(0, 256, shape).astype(np.uint8)
        y = (x if x.ndim == 3 else x[:, :, None]) / 255
        h, w, out = max(1, y.shape[0] // 8), max(1, y.shape[1] // 8), []
        for a in range(8):
            for b in range(8):
                block = y[a * h : (a + 1) * h, b * w : (b + 1) * w, :3].reshape(-1, min(y.shape[2], 3))
                out += [
                    *(block.mean(axis=0) if len(block) else np.zeros(block.shape[1])),
                    *(block.std(axis=0) if len(block) else np.zeros(block.shape[1])),
                ]
        want = np.pad(out, (0, 512 - len(out)))
        assert np.allclose(images.block_features(x), want / np.linalg.norm(want))
    df = frame(
        spark, [(1, bytes(range(12)), 2, 2, 3), (2, None, 1, 1, 1)],
        "k long, image binary, height int, width int, channels int",
    )
    got = {r["k"]: r["embedding"] for r in images.embed_images(df, ["k"]).collect()}
    assert len(got[1]) == 512 and got[2] is None
    assert np.allclose(
        {r["k"]: r["pixels"] for r in images.to_rgb(df).collect()}[1][:6], np.array([2, 1, 0, 5, 4, 3]) / 255
    )
    v = frame(
        spark, [([[1.0, 2.0], [3.0, 6.0], [9.0, 9.0]], [1, 1, 0]), ([[1.0, 2.0]], [0])],
        "v array<array<double>>, m array<int>",
    )
    assert [r[0] for r in v.select(images.masked_mean(F.col("v"), F.col("m"))).collect()] == [[2.0, 4.0], [0.0, 0.0]]
    one = frame(
        spark, [([0.485, 0.456, 0.406, 1.0],)], "p array<double>"
    ).select(images.normalised_pixels(F.col("p"))).first()[0]
    assert np.allclose(one, [0, 0, 0, (1 - 0.485) / 0.229])


def test_sources_and_sinks(spark, tmp_path):
    meta = tmp_path / "in"
    for name, body in (("a", {"session_id": "A", "start_time": 1.0}), ("b", {"session_id": "B"})):
        (meta / name).mkdir(parents=True)
        (meta / name / "metadata.json").write_text(json.dumps(body))
    assert readers.find_session(
        spark, str(meta), "B"
    ).count() == 1 and readers.find_session(spark, str(meta), "C").count() == 0
    (tmp_path / "times.csv").write_text("frame_index,timestamp\n1,0.5\n0,0.25\n")
    assert [
        tuple(r) for r in readers.read_frame_times(spark, str(tmp_path / "times.csv")).collect()
    ] == [(0, 0.25), (1, 0.5)]
    assert readers.read_frame_times(spark, None, 3, 2.0, 1.0).collect()[2]["timestamp"] == 2.0
    with pytest.raises(ValueError):
        readers.read_frame_times(spark, None)
    tasks = [
        {
            "id": 1, "data": {"session_id": "s", "segment_index": 4},
            "annotations": [
                {"was_cancelled": True, "result": []},
                {"result": [{"from_name": "quality", "value": {"rating": 3}}], "completed_by": 7},
            ],
        },
        {"id": 2, "data": {}, "annotations": []},
    ]
    (tmp_path / "tasks.json").write_text(json.dumps(tasks))
    pulled = labeling.pull_annotations(readers.read_tasks(spark, str(tmp_path / "tasks.json")))
    assert [(r["task_id"], r["segment_index"], r["annotator"]) for r in pulled.collect()] == [(1, 4, "7")]
    assert labeling.annotation_index(
        pulled, ["task_id"]
    ).first()["quality"] == 3 and labeling.of_session(pulled, "x").count() == 0 and labeling.of_session(
        pulled, None
    ).count() == 1
    (tmp_path / "eps").mkdir()
    (tmp_path / "eps" / "a.json").write_text('{"frames": 9}')
    (tmp_path / "eps" / "b.json").write_text("{broken")
    read = readers.read_damaged(spark, str(tmp_path / "eps"), "frames long")
    full = read.withColumns(
        {f"has_{d}": F.lit(True) for d in validation.REQUIRED}
        | {c: F.lit(64) for c in ("height", "width")}
        | {"channels": F.lit(3), "instruction": F.lit("go"), "action_values": F.array(F.lit(0.0))}
        | {f"{m}_rows": F.col("frames") for m in ("audio", "imu", "action")}
    )
    assert [
        (r["path"][-6:], r["check"]) for r in validation.validate(full).collect()
    ] == [("b.json", "open_file")] and validation.report(full).first()["invalid"] == 1
    x = np.sin(np.arange(160) / 9)
    made = writers.write_wav(
        frame(spark, [("w", 8000, x.tolist())], "name string, rate int, samples array<double>"), str(tmp_path / "wav")
    ).collect()
    back = readers.read_wav(spark, made[0]["path"]).first()
    assert back["rate"] == 8000 and np.allclose(back["samples"], x, atol=1e-3)
    imu = frame(spark, [(1.0, 2.0), (2.0, 3.0)], "timestamp double, accel_x double")
    writers.append_imu(imu, str(tmp_path / "imu"))
    writers.append_imu(imu.union(frame(spark, [(3.0, 4.0)], "timestamp double, accel_x double")), str(tmp_path / "imu"))
    assert spark.read.parquet(str(tmp_path / "imu")).count() == 3
    calls = []
    stages = [("a", lambda s: calls.append("a") or 1), ("b", lambda s: calls.append("b") or s["a"] + 1)]
    state = str(tmp_path / "state")
    assert writers.run_stages(spark, state, stages) == {"a": 1, "b": 2} and writers.run_stages(
        spark, state, [*stages, ("c", lambda s: 5)]
    )["c"] == 5 and calls == ["a", "b"]
    assert [
        tuple(r) for r in writers.stage_table(spark, writers.load_state(spark, state), ["a", "z"]).collect()
    ] == [("a", True, "1"), ("z", False, None)]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("s/x.csv", "1")
    assert [p.endswith("s/x.csv") for p in writers.land(spark, raw.getvalue(), str(tmp_path / "land"))] == [True]
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("../out", "1")
    with pytest.raises(ValueError):
        writers.land(spark, raw.getvalue(), str(tmp_path / "land"))
    walk = readers.synthetic_gps(spark, 2, 50).toPandas()
    assert len(walk) == 100 and (
        walk["speed_kmh"] >= 0
    ).all() and walk["heading"].between(0, 360).all() and readers.synthetic_imu(spark, 2, 30).count() == 60
    with pytest.raises(NotImplementedError):
        readers.decode_video(imu)
    files = frame(
        spark, [("s", "/x/episodes/episode_1.h5"), ("s", "/x/other.h5"), ("t", "/y/a.h5"), ("t", "/y/a.txt")],
        "session string, path string",
    )
    assert sorted(
        r["path"] for r in validation.episode_files(files).collect()
    ) == ["/x/episodes/episode_1.h5", "/y/a.h5"]
    assert [
        r["path"] for r in assembly.path_list([files.filter("session = 't'"), files.filter("session = 's'")]).collect()
    ][0] == "/y/a.h5"


def test_wav_widths(tmp_path):
    import wave

    for width in (1, 2, 3, 4):
        for channels in (1, 2):
            x = np.array([0.5, -0.5, 0.25, -0.25] * channels)
            full = 1 << (8 * width - 1)
            ints = [int(v * full) for v in x]
            data = b"".join(
                (i + 128).to_bytes(1, "little")
                if width == 1
                else i.to_bytes(width, "little", signed=True)
                for i in ints
            )
            out = io.BytesIO()
            with wave.open(out, "wb") as w:
                w.setnchannels(channels)
                w.setsampwidth(width)
                w.setframerate(9)
                w.writeframes(data)
            rate, y = readers.decode_wav(out.getvalue())
            assert rate == 9 and np.allclose(y, x.reshape(-1, channels).mean(axis=1))


def test_concatenated_audio_and_chunks(spark):
    chunks = frame(
        spark, [(1, 0, 8, [0.5, -1.0]), (1, 2, 8, [2.0]), (1, 1, 16, [9.0])],
        "session long, chunk long, rate int, samples array<double>",
    )
    got = assembly.concat_audio(chunks).first()
    assert got["samples"] == [0.25, -0.5, 1.0] and got["rate"] == 8
    rows = frame(
        spark, [(1, 0, 0, 1.0, "a"), (1, 1, 0, 1.0, "b"), (1, 1, 1, 2.0, "c")],
        "session long, chunk long, row long, timestamp double, v string",
    )
    assert sorted(r["v"] for r in assembly.series_of_chunks(rows).collect()) == ["a", "c"]
    both = assembly.concat_frames([rows.select("session", "v"), rows.select("session", "chunk")])
    assert both.count() == 6 and both.filter("v is null").count() == 3
    assert [
        tuple(r) for r in assembly.video_manifest(
            frame(spark, [(1, 5, "b"), (1, 2, "a")], "session long, chunk long, video string")
        ).collect()
    ] == [(1, 0, "a"), (1, 1, "b")]


def test_prediction_by_place(spark):
    tasks = frame(spark, [(1, 0), (1, 1)], "session long, segment long")
    labels = frame(
        spark, [(1, 0, "idle", "general", "x", "y", 0.5)],
        "session long, segment long, action_type string, scenario string, instruction_hi string, instruction_en string, confidence double",
    )
    got = {r["segment"]: r["prediction"] for r in labeling.with_predictions(tasks, labels).collect()}
    assert json.loads(got[0])["result"][0]["value"] == "idle" and got[1] is None
    assert labeling.task_fields(labels).columns == [
        "action_type", "scenario", "instruction_hi", "instruction_en", "confidence"
    ]


def test_tile_and_position_text(spark):
    row = frame(spark, [(12.34567, -0.0005)], "lat double, lon double").select(
        geo.tile_name(F.col("lat"), F.col("lon")), formats.path_time(F.lit("2024-03-05 06:07:08").cast("timestamp")),
        formats.data_url(F.lit(b"ab")),
    ).first()
    assert row[0] == f"tile_{12.34567:.3f}_{-0.0005:.3f}" and row[1] == "2024-03-05-0607" and row[2] == "data:image/jpeg;base64,YWI="


def test_tasks_and_records(spark, tmp_path):
    frames = frame(spark, [(1, k, bytes([k])) for k in range(5)], "session long, frame long, jpeg binary")
    segs = frame(
        spark, [(1, 0, 0, 4, 0.5), (1, 1, 4, 90, None)],
        "session long, segment long, start_frame long, end_frame long, confidence double",
    )
    labels = frame(
        spark, [(1, 0, "idle", "general", "x", "y", 0.5)],
        "session long, segment long, action_type string, scenario string, instruction_hi string, instruction_en string, confidence double",
    )
    got = {r["segment"]: json.loads(r["task"]) for r in labeling.segment_tasks(segs, frames, labels).collect()}
    assert got[0]["data"][
        "frame_index"
    ] == 2 and got[0]["data"]["image"] == "data:image/jpeg;base64,Ag==" and got[0]["predictions"][0]["score"] == 0.5
    assert got[1]["data"]["frame_index"] == 4 and got[1]["data"]["confidence"] == 0.0 and "predictions" not in got[1]
    tasks = labeling.frame_tasks(frames.withColumnsRenamed({"session": "session_id", "frame": "frame_index"}))
    assert json.loads(tasks.first()["task"])["data"]["frame_index"] == 0
    assert writers.task_batches(tasks, "frame_index", 2).groupBy("batch").count().agg(F.max("count")).first()[0] <= 2
    parts = frame(
        spark, [(1, 1, "b", 1.23456, 2.0, None, 0.55555), (1, 0, "a", 0.0, 1.0, "hi", 1.0)],
        "session long, ord long, text string, start double, end double, language string, confidence double",
    )
    told = transcripts.transcription(transcripts.records(parts)).first()
    assert told["text"] == "a b" and told["language"] == "hi" and told["segments"][1]["start"] == 1.235
    assert series.segment_records(
        frame(spark, [(0.123456, 2.0)], "confidence double, motion_magnitude double")
    ).first()["confidence"] == 0.1235
    assert [
        r["frame"] for r in series.first_rows(frames, ["frame"], 2).collect()
    ] == [0, 1] and series.first_rows(frames, ["frame"], 2, "session").count() == 2
    writers.write_results(str(tmp_path / "out"), segments=segs, transcription=parts)
    assert spark.read.json(str(tmp_path / "out" / "segments")).count() == 2
    writers.write_session_meta(segs, str(tmp_path / "meta"), "2024-01-01")
    assert spark.read.json(str(tmp_path / "meta")).first()["assembled_at"] == "2024-01-01"


def test_jobs(spark):
    new = jobs.queue_jobs(frame(spark, [("j", "s", 1), ("k", "t", 1)], "job_id string, session_id string, now long"))
    updates = frame(
        spark, [("j", 3, "running", None), ("j", 5, None, "down"), ("j", 4, "failed", None), ("x", 9, "done", None)],
        "job_id string, updated_at long, status string, error string",
    )
    got = {r["job_id"]: r for r in jobs.advance(new, updates).collect()}
    assert (
        got["j"]["status"], got["j"]["error"], got["j"]["updated_at"], got["j"]["stage"]
    ) == ("failed", "down", 5, "queued") and got["k"]["updated_at"] == 1 and len(got) == 2


def test_high_pass_in_blocks(spark):
    """A series in many blocks as in one; short series, blocks of one row and equal times included."""
    rng = np.random.default_rng(11)
    rows = [("a", k, k * 0.01, 9.8 + float(x), float(y)) for k, (x, y) in enumerate(rng.normal(size=(501, 2)))]
    rows += [("b", k, k * 0.01, float(k), 1.0) for k in range(9)] + [("c", k, float(k // 3), float(x), 2.0) for k, x in enumerate(rng.normal(size=33))]
    df = frame(spark, rows, "session string, n long, t double, ax double, ay double").repartition(5)
    for size, block in ((16, 0.5), (64, 3600.0), (65_536, 1.0)):
        got = folds.remove_gravity(df, ["ax", "ay"], tie="n", size=size, block=block).toPandas().sort_values(["session", "n"])
        assert len(got) == len(rows)
        for s, part in got.groupby("session"):
            for c in ("ax", "ay"):
                own = np.array([r[3 if c == "ax" else 4] for r in rows if r[0] == s])
                want = high_pass_by_equations(own, 100.0) if len(own) > 9 else own
                assert np.allclose(part[f"{c}_hp"], want, atol=1e-9), (s, c, size)
    assert abs(got[got.session == "a"].ax_hp.mean()) < 1
    assert folds.remove_gravity(df.filter("false"), ["ax"]).count() == 0


def test_resample_in_blocks(spark):
    rng = np.random.default_rng(12)
    for rate, to, sizes in ((48_000, 16_000, (40, 64)), (16_000, 48_000, (40,)), (44_100, 16_000, (700,)), (8_000, 8_000, (5,))):
        rows = {s: rng.normal(size=n) for s, n in (("a", 1501), ("b", 3), ("c", sizes[0] * 2))}
        for size in sizes:
            blocks = [(s, k // size, x[k : k + size].tolist(), rate) for s, x in rows.items() for k in range(0, len(x), size)]
            got = folds.resample_blocks(frame(spark, blocks, "session string, block long, samples array<double>, rate int"), to).collect()
            for s, x in rows.items():
                parts = sorted((r["first"], r["samples"]) for r in got if r["session"] == s and r["samples"])
                assert [f for f, _ in parts] == np.concatenate(([0], np.cumsum([len(v) for _, v in parts])[:-1])).tolist()
                assert np.allclose(np.concatenate([v for _, v in parts]), folds.resample(x, rate, to), atol=1e-9), (rate, s)


def test_series_in_many_blocks_as_in_one(spark):
    """Motion, runs and segments don't depend on where a series is cut; equal times at cuts, empty blocks and nulls included."""
    rng = np.random.default_rng(13)
    rows = []
    for s, n in (("a", 300), ("b", 1), ("c", 2), (None, 40)):
        t = np.cumsum(rng.choice([0.0, 0.5, 1.0, 30.0], n))
        speed = np.where(rng.random(n) < 0.1, 9.0, np.where(np.arange(n) // 17 % 2, 0.5, 6.0))
        level = np.repeat(rng.choice([0.2, 2.0, 4.0], n // 6 + 1), 6)[:n]
        rows += [(s, k, float(t[k]), 12.0 + float(rng.normal()) * 1e-3, 77.0, float(speed[k]), float(level[k])) for k in range(n)]
    rows[5] = (*rows[5][:3], None, 77.0, None, 1.0)
    df = frame(spark, rows, "session string, n long, t double, lat double, lon double, speed double, magnitude double").repartition(4)
    results = []
    for block, frames_ in ((2.0, 7), (40.0, 64), (1e9, 65_536)):
        moved = series.motion(df, tie="n", block=block)
        still = series.stationary(df, tie="n", block=block)
        a = sorted(((r.session or "", r.n, round(r.distance_m, 6), round(r.speed_kmh, 4), round(r.heading, 6), round(r.total_m, 5)) for r in moved.collect()))
        b = sorted(((r.session or "", r.n, str(r.is_stationary), r.segment_id) for r in still.collect()))
        c = sorted(((r.session or "", r.start_frame, r.end_frame, round(r.motion_magnitude, 9)) for r in series.hysteresis(df, i="n", block=frames_).collect()))
        results.append((a, b, c))
    assert results[0] == results[1] == results[2] and len(results[0][0]) == len(results[0][1]) == len(rows)
    assert max(r[3] for r in results[0][1]) > 3 and len(results[0][2]) > 8


def test_a_long_series_is_many_tasks(spark):
    """Two million rows of one session: no task of the run and segment windows gets most of them."""
    df = spark.range(2_000_000).selectExpr("'s' AS session", "id AS n", "id * 1.0D AS t", "12 + id * 1e-7 AS lat", "77D AS lon", "CASE WHEN id % 100 < 50 THEN 0D ELSE 9D END AS speed")
    cut = df.withColumn("_block", F.floor(F.col("t") / 86_400))
    spread = cut.repartition(8, "session", "_block").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 4 and max(r["count"] for r in spread) < 1_000_000
    out = series.stationary(df, tie="n").agg(F.count("*").alias("n"), F.max("segment_id").alias("k")).first()
    assert tuple(out) == (2_000_000, 20_000)
