import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.operators import folds, intervals, series
from wearlake.sources import readers


def test_high_pass_removes_gravity():
    rng = np.random.default_rng(1)
    x = 9.81 + rng.normal(0, 0.1, 300)
    assert abs(folds.high_pass(x, 100.0).mean()) < 1
    assert np.allclose(folds.high_pass(np.full(50, 3.0), 100.0), 0, atol=1e-9)
    assert (folds.high_pass(np.arange(9.0), 100.0) == np.arange(9.0)).all()


def test_resample_length_and_level():
    x = np.sin(np.arange(4800) * 2 * math.pi * 440 / 48000)
    y = folds.resample(x, 48000, 16000)
    assert abs(len(y) - 1600) <= 2
    assert abs(np.abs(y[200:-200]).max() - 1) < 0.02


def test_identity_quaternion(spark):
    df = spark.createDataFrame(pd.DataFrame({"session": 1, "t": np.arange(20.0), "gx": 0.0, "gy": 0.0, "gz": 0.0}))
    out = folds.orientation(df).toPandas()
    assert (out[["qx", "qy", "qz"]] == 0).all().all() and (out["qw"] == 1).all()


def test_kalman_against_matrix_form(spark):
    rng = np.random.default_rng(3)
    t = np.cumsum(rng.uniform(0.5, 2, 40))
    z = np.cumsum(rng.normal(size=40))
    got = folds.kalman(
        spark.createDataFrame(pd.DataFrame({"session": 1, "t": t, "z": z})), ["z"]
    ).toPandas().sort_values("t")["z_smooth"].to_numpy()
    x, p, want = np.array([z[0], 0.0]), np.eye(2) * 1e-4, [z[0]]
    for k in range(1, 40):
        dt = t[k] - t[k - 1]
        f = np.array([[1, dt], [0, 1]])
        q = 1e-4 * np.array([[dt**4 / 4, dt**3 / 2], [dt**3 / 2, dt**2]])
        x, p = f @ x, f @ p @ f.T + q
        g = p[:, 0] / (p[0, 0] + 1e-2)
        x, p = x + g * (z[k] - x[0]), p - np.outer(g, p[0])
        want.append(x[0])
    assert np.allclose(got, want, atol=1e-9)


def test_merge_short(spark):
    df = pd.DataFrame(
        [(1, 0, 5, 0.8, 2.0), (1, 5, 40, 0.9, 3.0), (1, 40, 50, 0.7, 1.5)],
        columns=["session", "start_frame", "end_frame", "confidence", "motion_magnitude"],
    )
    out = folds.merge_short(spark.createDataFrame(df)).toPandas()
    assert ((out.end_frame - out.start_frame) >= 15).all() and out.start_frame.min() == 0 and out.end_frame.max() == 50


def test_interpolation_is_numpys(spark):
    t, v, g = np.array([0.0, 1, 3, 7]), np.array([1.0, 5, -2, 4]), np.array([-1.0, 0, 0.5, 2.9, 3, 6, 9])
    s = spark.createDataFrame(pd.DataFrame({"session": 1, "t": t, "v": v}))
    out = series.interpolate(
        s, spark.createDataFrame(pd.DataFrame({"session": 1, "t": g})), ["v"]
    ).toPandas().sort_values("t")
    assert np.allclose(out["v"], np.interp(g, t, v))


def test_hysteresis_against_state_machine(spark):
    rng = np.random.default_rng(5)
    frames, want = [], []
    for session in range(30):
        m = rng.uniform(0, 5, 25)
        frames += [(session, i, float(x)) for i, x in enumerate(m)]
        start, got = None, []
        for i, x in enumerate(m):
            if start is None and x > 3:
                start = i
            elif start is not None and x < 1:
                got.append((session, start, i))
                start = None
        if start is not None:
            got.append((session, start, len(m)))
        want += got or [(session, 0, len(m))]
    out = series.hysteresis(spark.createDataFrame(frames, "session long, frame long, magnitude double"))
    assert sorted(tuple(r) for r in out.select("session", "start_frame", "end_frame").collect()) == sorted(want)
    with pytest.raises(ValueError):
        series.hysteresis(out, high=1.0, low=2.0)


def test_overlaps_without_duplicates(spark):
    rng = np.random.default_rng(2)
    make = lambda n: [
        (1, k, float(a), float(a + w)) for k, (a, w) in enumerate(zip(rng.uniform(0, 50, n), rng.uniform(0, 20, n)))
    ]
    a, b = make(40), make(40)
    got = intervals.overlaps(
        spark.createDataFrame(a, "session long, i long, l_start double, l_end double"),
        spark.createDataFrame(b, "session long, j long, r_start double, r_end double"), 5.0,
    )
    want = sorted((x[1], y[1]) for x in a for y in b if min(x[3], y[3]) - max(x[2], y[2]) > 0)
    assert sorted((r["i"], r["j"]) for r in got.collect()) == want


def test_wav_round_trip():
    x = np.sin(np.arange(1600) / 10)
    rate, y = readers.decode_wav(readers.encode_wav(x, 16000))
    assert rate == 16000 and np.allclose(x, y, atol=1e-3)


def test_sensor_csv(spark, tmp_path):
    (tmp_path / "imu.csv").write_text("timestamp,accel_x,gyro_x\n2,1,180\n1,0,0\n")
    rows = readers.read_imu(spark, str(tmp_path / "imu.csv"), degrees=True).collect()
    assert [
        r["timestamp"] for r in rows
    ] == [1, 2] and abs(rows[1]["gyro_x"] - math.pi) < 1e-9 and rows[0]["accel_z"] == 0
    with pytest.raises(ValueError):
        readers.read_gps(spark, str(tmp_path / "imu.csv"))


def test_many_small_groups_come_in_few_batches():
    """Groups aren't one call each, wherever batches are cut, and null keys are one group."""
    p = pd.DataFrame({"s": [None, None, 1, 1, 1, 2, 3, 3, 4, 4, 4, 4], "v": range(12)})
    for cuts in ([], [1], [3, 4], [5, 6, 8], list(range(1, 12))):
        got = list(folds.whole_groups(iter([p.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, 12])]), ["s"]))
        assert pd.concat(got)["v"].tolist() == list(range(12))
        assert sum(len(folds.group_starts(g, ["s"])) for g in got) == 5 and len(got) <= min(5, len(cuts) + 2)


def test_high_pass_of_many_series_is_that_of_each():
    rng = np.random.default_rng(3)
    sizes = np.array([10, 11, 500, 64, 1024, 17])
    x = rng.normal(size=sizes.sum()).cumsum()
    x[12] = np.nan
    want = np.concatenate([folds.high_pass(v, 100.0) for v in np.split(x, np.cumsum(sizes)[:-1])])
    assert np.allclose(folds.high_pass_many(x, sizes, 100.0), want, atol=1e-9, equal_nan=True)


def test_small_series_need_no_call_each(spark, monkeypatch):
    """No operator of short series, segments or recordings runs a Python call a group, but for series of many blocks."""
    df = spark.range(100).select((F.col("id") % 5).alias("session"), F.col("id").cast("double").alias("t"), F.sin(F.col("id").cast("double")).alias("a"))
    out = folds.remove_gravity(df, ["a"])
    got = {(r.session, r.t): r.a_hp for r in out.collect()}
    for k in range(5):
        rows = sorted((r.t, r.a) for r in df.filter(F.col("session") == k).collect())
        want = folds.high_pass(np.array([a for _, a in rows]), 100.0)
        assert np.allclose([got[k, t] for t, _ in rows], want, atol=1e-9)
    segments = spark.createDataFrame([(s, 10 * k, 10 * k + 10, 0.5, 1.0 * k) for s in range(4) for k in range(5)], "session long, start_frame long, end_frame long, confidence double, motion_magnitude double")
    merged = folds.merge_short(segments, 15)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and sorted(tuple(r)[:3] for r in merged.collect()) == [(s, a, b) for s in range(4) for a, b in ((0, 20), (20, 50))]
    pcm = spark.range(6).select("id", (F.col("id") % 2).alias("session"), F.floor(F.col("id") / 2).alias("block")).select(
        "session", "block", F.transform(F.sequence(F.lit(1), F.lit(64)), lambda x: x * 1.0).alias("samples"), F.lit(48_000).alias("rate"))
    rated = folds.resample_blocks(pcm, 16_000)
    assert "FlatMapGroups" not in rated._jdf.queryExecution().executedPlan().toString() and rated.count() == 6
