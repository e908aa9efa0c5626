"""Tracking, dense flow, resizing and blur against known shifts and direct sums."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.operators import composites, flow, images
from wearlake.plans import standins as st
from wearlake.video_queries import flow_magnitudes, segment_motion_levels, video_pixels

FRAMES = "session long, frame long, image binary, height int, width int, channels int"


@pytest.fixture(scope="module")
def texture():
    x = np.random.default_rng(0).random((160, 160)) * 255
    x = flow.separable(x, flow.gaussian(9, 2.0), flow.gaussian(9, 2.0))
    return (x - x.min()) / (x.max() - x.min()) * 255


def shot(texture, down=0.0, across=0.0, side=96):
    y, x = np.mgrid[:side, :side]
    return np.rint(flow.sampled(texture, y + 30 - down, x + 30 - across))


def raw(x):
    return bytearray(np.repeat(x.astype(np.uint8)[:, :, None], 3, axis=2).tobytes())


def test_corners_against_sums():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 255, (24, 20)).astype(float)
    gx, gy = flow.gradients(x)
    mirror = lambda k, n: -k if k < 0 else 2 * (n - 1) - k if k >= n else k
    value = np.zeros(x.shape)
    for i in range(1, 23):
        for j in range(1, 19):
            s = np.zeros((2, 2))
            for a in range(-3, 4):
                for b in range(-3, 4):
                    g = np.array([gx[mirror(i + a, 24), mirror(j + b, 20)], gy[mirror(i + a, 24), mirror(j + b, 20)]])
                    s += np.outer(g, g)
            value[i, j] = np.linalg.eigvalsh(s)[0]
    ranked = sorted(((-value[i, j], i, j) for i in range(24) for j in range(20)))
    want = []
    for v, i, j in ranked:
        near = value[max(0, i - 1) : i + 2, max(0, j - 1) : j + 2].max()
        if -v >= 0.3 * value.max() and -v >= near - 1e-6 and all((i - a) ** 2 + (j - b) ** 2 >= 49 for a, b in want):
            want.append((i, j))
    assert [tuple(p) for p in flow.corners(x).astype(int)] == want
    assert len(flow.corners(np.full((20, 20), 7.0))) == 0


@pytest.mark.parametrize(("down", "across"), [(0, 0), (1.5, -2.25), (5, 3), (0, 9)])
def test_known_shift(texture, down, across):
    first, second = shot(texture), shot(texture, down, across)
    points = flow.corners(first)
    to, found = flow.track(flow.pyramid(first), flow.pyramid(second), points)
    inner = found & (points > 25).all(axis=1) & (points < 70).all(axis=1)
    assert inner.sum() > 3 and np.abs(to[inner] - points[inner] - [down, across]).max() < 0.05
    d, a = flow.dense(first, second)
    assert np.abs(d[20:-20, 20:-20] - down).max() < 0.15 and np.abs(a[20:-20, 20:-20] - across).max() < 0.15


def test_quadratic_against_least_squares():
    x = np.random.default_rng(2).random((12, 13)) * 100
    got = flow.quadratic(x)
    g = flow.gaussian(5, 1.2)
    for i, j in ((2, 2), (5, 7), (9, 10)):
        rows, values, weights = [], [], []
        for a in range(-2, 3):
            for b in range(-2, 3):
                rows.append([1, b, a, b * b, a * a, a * b])
                values.append(x[i + a, j + b])
                weights.append(np.sqrt(g[a + 2] * g[b + 2]))
        w = np.array(weights)
        c = np.linalg.lstsq(np.array(rows) * w[:, None], np.array(values) * w, rcond=None)[0]
        assert np.allclose([t[i, j] for t in got], [c[1], c[2], c[3], c[4], c[5] / 2])


def test_blocks_are_as_one_pass(spark, texture):
    """Magnitudes of a session in blocks equal those of one loop over all its frames."""
    shots = [shot(texture, 0, 0.6 * k if k < 14 else 8.4 + 3.5 * (k - 14), 64) for k in range(27)]
    want, points = [0.0], flow.corners(shots[0])
    for k in range(1, 27):
        to, found = flow.track(flow.pyramid(shots[k - 1]), flow.pyramid(shots[k]), points)
        want.append(float(np.linalg.norm((to - points)[found], axis=1).mean()) if found.any() else 0.0)
        points = flow.corners(shots[k]) if k % 10 == 0 or len(points) < 10 else to[found]
    df = spark.createDataFrame([(1, k, raw(x), 64, 64, 3) for k, x in enumerate(shots)], FRAMES).repartition(5)
    got = {r.frame: r.magnitude for r in flow.magnitudes(df).collect()}
    assert np.allclose([got[k] for k in range(27)], want, atol=1e-9) and len(got) == 27
    assert abs(np.mean(want[2:13]) - 0.6) < 0.05 and abs(np.mean(want[16:]) - 3.5) < 0.3


def test_awkward_frames(spark, texture):
    x, y = shot(texture, side=48), shot(texture, 0, 2, 48)
    rows = [(1, k, raw(x if k % 2 else y), 48, 48, 3) for k in range(12) if k != 5]  # a hole at 5
    rows += [(1, 3, None, 48, 48, 3), (2, 0, raw(x), 48, 48, 3), (3, 0, None, 48, 48, 3), (3, 1, raw(x), 48, 48, 3)]
    rows += [(4, 0, raw(x), 48, 48, 3), (4, 1, bytearray(b"abc"), 48, 48, 3), (4, 2, bytearray(48), 4, 4, 3), (4, 3, raw(y), 48, 48, 3)]
    rows += [(5, k, raw(np.full((48, 48), 9)), 48, 48, 3) for k in range(3)]
    got = {(r.session, r.frame): r.magnitude for r in flow.magnitudes(spark.createDataFrame(rows, FRAMES)).collect()}
    assert set(got) == {(r[0], r[1]) for r in rows}
    assert got[1, 0] == got[1, 6] == 0 and all(abs(got[1, k] - 2) < 0.2 for k in (1, 2, 3, 4, 7, 8, 9, 10, 11))
    assert all(v == 0 for (s, _), v in got.items() if s > 1)
    assert flow.magnitudes(spark.createDataFrame([], FRAMES)).count() == 0


def test_still_frames_make_few_segments(spark, texture):
    df = spark.createDataFrame([(1, k, raw(shot(texture, side=48)), 48, 48, 3) for k in range(30)], FRAMES)
    found = composites.video_segments(df, high=100.0).collect()
    assert [(r.start_frame, r.end_frame, r.confidence) for r in found] == [(0, 30, 0.5)]


def test_moving_frames_make_a_segment(spark, texture):
    place = np.cumsum([0.0] * 20 + [4.0] * 20 + [0.0] * 20)
    df = spark.createDataFrame([(1, k, raw(shot(texture, 0, 0.3 * p)), 96, 96, 3) for k, p in enumerate(place)], FRAMES)
    found = composites.video_segments(df, high=1.0, low=0.5).collect()
    assert [(r.start_frame, r.end_frame) for r in found] == [(20, 40)] and 1.0 < found[0].motion_magnitude < 1.4


def test_motion_levels(spark, texture):
    rows = [(s, k, raw(shot(texture, 0, v * k)), 96, 96, 3) for s, v in ((1, 0), (2, 3), (3, 9)) for k in range(4)]
    df = spark.createDataFrame(rows, FRAMES)
    spans = [(1, 0, 4), (2, 0, 4), (2, 0, 1), (2, 2, 9), (3, 0, 3), (9, 0, 5), (1, 1, 30)]
    got = flow.segment_motion(spark.createDataFrame(spans, "session long, start_frame long, end_frame long"), df)
    want = {
        (1, 0): ("low", 0.6), (2, 0): ("medium", 0.7), (3, 0): ("high", 0.8), (9, 0): ("low", 0.3), (1, 1): ("low", 0.3),
        (2, 2): ("low", 0.3),
    }
    seen = {(r.session, r.start_frame, r.end_frame): (r.motion_level, r.motion_confidence) for r in got.collect()}
    assert seen.pop((2, 0, 1)) == ("low", 0.4)
    assert {k[:2]: v for k, v in seen.items()} == want


def test_stand_in_moves_as_it_says(spark):
    sf = "/root/testdata/sf0.001"
    own = flow_magnitudes(spark, sf).toPandas()
    assert len(own) == st.read(spark, sf, "embeddings").count()
    by = own.groupby(own.frame // 10).magnitude.median()
    assert by[0] == 0 and abs(by[1] - 2) < 0.2 and abs(by[2] - 4) < 0.4
    levels = segment_motion_levels(spark, sf).toPandas()
    assert set(levels[levels.segment == 0].motion_level) == {"low"}


def test_resized_and_blurred_against_sums():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (9, 7, 3)).astype(np.uint8)
    got = flow.resized(x, 5, 16)
    for i in range(5):
        for j in range(16):
            y, z = min(max((i + 0.5) * 9 / 5 - 0.5, 0), 8), min(max((j + 0.5) * 7 / 16 - 0.5, 0), 6)
            a, b = min(int(y), 7), min(int(z), 5)
            u, v = y - a, z - b
            p = x.astype(float)
            want = (1 - u) * ((1 - v) * p[a, b] + v * p[a, b + 1]) + u * ((1 - v) * p[a + 1, b] + v * p[a + 1, b + 1])
            assert np.allclose(got[i, j], want)
    blurred = images.blurred(x, [(2, 1, 4, 5), (-3, -3, 2, 2), (6, 8, 50, 50)], kernel=3)
    assert (blurred[0] == x[0]).all() and (blurred[:, :2] == x[:, :2]).all() and (blurred[8, 6] == x[8, 6]).all()
    g = flow.gaussian(3, 0.8)
    part = x[1:6, 2:6].astype(float)
    own = sum(g[a] * g[b] * part[1 + a : 2 + a, 1 + b : 2 + b] for a in range(3) for b in range(3))[0, 0]
    assert (blurred[3, 4] == np.rint(own)).all() or (blurred[2 + 1, 3 + 1] - np.rint(own)).max() <= 1


def test_video_stage(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, (10, 12, 3)).astype(np.uint8)
    df = spark.createDataFrame([(1, 0, bytearray(x.tobytes()), 10, 12, 3), (1, 1, None, 10, 12, 3), (1, 2, bytearray(b"x"), 10, 12, 3)], FRAMES)
    got = {r.frame: r for r in images.video_stage(df.withColumn("pixel", F.lit(1)), 6, 4).collect()}
    want = np.rint(flow.resized(x, 4, 6))[:, :, ::-1].ravel() / 255
    assert np.allclose(got[0].pixels, want) and (got[0].height, got[0].width, len(got[0].image)) == (4, 6, 72)
    assert got[1].pixels is None and got[2].pixels is None and got[2].height == 10


def test_channel_sums_add_in_order_without_a_row_of_steps(spark):
    rng = np.random.default_rng(5)
    rows = [(k, None if k == 3 else [float(v) for v in rng.random(3 * k)]) for k in range(6)]
    df = spark.createDataFrame(rows, "id long, pixels array<float>").select("*", images.channel_sums(F.col("pixels")).alias("sums"))
    for r in df.collect():
        assert r.sums == (None if r.id == 3 else [sum(r.pixels[k::3], 0.0) for k in range(3)])


def test_displacements_of_a_stack_are_those_of_its_pairs(texture):
    """Fits made once an image and pairs worked through together, against each pair alone and sums over whole windows."""
    stack = np.stack([shot(texture, 0.5 * k, 1.25 * k, 40) for k in range(4)])
    down, across = flow.displacements(stack)
    for k in range(3):
        d, a = flow.dense(stack[k], stack[k + 1])
        assert np.allclose(down[k], d, atol=1e-9) and np.allclose(across[k], a, atol=1e-9)
    means = [np.hypot(down[k], across[k]).mean() for k in range(3)]
    assert np.isclose(flow.dense_magnitude(list(stack)), np.mean(means))
    for shape, size in (((5, 9, 4), 7), ((2, 1, 30), 15), ((1, 6, 8), 15)):
        x = np.random.default_rng(6).random(shape)
        ones = np.ones(size)
        assert np.allclose(flow.window_sums(flow.window_sums(x, size, -2), size, -1), flow.separable(x, ones, ones))


def test_segments_of_small_frames_are_many_tasks(spark, texture):
    df = spark.createDataFrame([(s, k, raw(shot(texture, 0, k, 24)), 24, 24, 3) for s in range(6) for k in range(3)], FRAMES)
    spans = spark.createDataFrame([(s, 0, 3) for s in range(6)], "session long, start_frame long, end_frame long")
    plan = flow.segment_motion(spans, df)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan  # tasks that aren't put together by their bytes


def test_tracking_is_many_tasks_and_done_once(spark, texture):
    df = spark.createDataFrame([(s, k, raw(shot(texture, 0, k, 24)), 24, 24, 3) for s in range(6) for k in range(3)], FRAMES)
    assert flow.magnitudes(df).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = composites.video_segments(df)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan  # the magnitudes are read, not tracked anew for each use


def test_sums_of_the_stage_are_those_of_its_pixels(spark):
    rng = np.random.default_rng(8)
    shots = [rng.integers(0, 256, (h, w, 3)).astype(np.uint8) for h, w in ((10, 12), (1, 7), (30, 9))]
    rows = [(1, k, bytearray(x.tobytes()), *x.shape) for k, x in enumerate(shots)]
    rows += [(1, 3, None, 10, 12, 3), (1, 4, bytearray(b"x"), 10, 12, 3), (1, 5, bytearray(), 0, 0, 3)]
    faces = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip("xywh", b))) for b in ((2, 1, 5, 6), (-3, 8, 9, 9))))
    for df, boxes in ((spark.createDataFrame(rows, FRAMES), None), (spark.createDataFrame(rows, FRAMES).withColumn("faces", faces), "faces")):
        out = images.video_stage(df, 16, 14, boxes, 5, sums=True)
        assert out.columns == [c for c in df.columns if c != "image"] + ["n", "sums"]
        whole = images.video_stage(df, 16, 14, boxes, 5).select("*", images.channel_sums(F.col("pixels")).alias("own"))
        want = {r.frame: (r.height, r.width, None if r.pixels is None else len(r.pixels), r.own) for r in whole.collect()}
        assert {r.frame: (r.height, r.width, r.n, r.sums) for r in out.collect()} == want
        assert [want[k][2] for k in range(6)] == [672] * 3 + [None] * 3 and want[4][:2] == (10, 12)


def test_pixels_stay_in_their_task(spark):
    plan = video_pixels(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "pixels" not in plan  # 0.6 MB a frame, which Spark would buffer for Python


def test_few_frames_are_drawn_at_a_time_in_many_tasks(spark):
    vectors = [[float(k + j) for j in range(64)] for k in range(500)]
    rows = pd.DataFrame({"session": 7, "frame": range(500), "embedding": vectors, "first": [vectors[0]] * 500, "moved": np.arange(500.0)})
    parts = list(st.drawn(iter([rows, rows.iloc[:0], rows.iloc[:3]]), 64))
    assert max(p["image"].map(len).sum() for p in parts) <= 1 << 20
    assert [k for p in parts for k in p["frame"]] == [*range(500), 0, 1, 2]
    drawn = st.video(spark, "/root/testdata/sf0.001")
    assert drawn.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
