"""The vector index against whole scans, the spheroid and the cell cover against brute force."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlake.operators import catalog, geocells, vectorindex


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    centre = rng.standard_normal((12, 16)) * 3
    rows = [(k, (centre[k % 12] + rng.standard_normal(16)).tolist(), f"g{k % 2}") for k in range(1500)]
    rows += [(2000, rows[0][1], "g0"), (2001, [0.0] * 16, "g0"), (2002, None, "g0"), (2003, [float("nan")] * 16, "g1")]
    rows += [(2004, [1.0, 2.0], "g1"), (2005, [None] * 16, "g1"), (2006, [-x for x in rows[0][1]], "g1")]
    return spark.createDataFrame(rows, "id long, embedding array<double>, scenario string")


def _scan(rows, query, k, keep=lambda r: True):
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1)
    ok = [r for r in rows if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all() and len(r.embedding) == 16 and keep(r)]
    score = sorted(((-round(float(unit(r.embedding) @ unit(query)), 12), r.id) for r in ok))
    return [(i, -s) for s, i in score[:k]]


def test_index_against_scan(spark, vectors, tmp_path):
    index = vectorindex.build(vectors, f"{tmp_path}/i")
    index = vectorindex.load(spark, index.path)
    rows = vectors.collect()
    asked = [r for r in rows if r.id % 100 == 0 and r.id < 2000] + [r for r in rows if r.id in (2001, 2006)]
    queries = spark.createDataFrame([(r.id, r.embedding) for r in asked] + [(9999, None), (9998, [1.0])], "query_id long, embedding array<double>")
    got = {}
    for r in vectorindex.search(queries, index, 7, exact=True).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.similarity))
    assert set(got) == {r.id for r in asked}
    for r in asked:
        want = _scan(rows, r.embedding, 7)
        assert [i for _, i, _ in sorted(got[r.id])] == [i for i, _ in want]
        assert np.allclose([s for _, _, s in sorted(got[r.id])], [s for _, s in want])
    near = {(r.query_id, r.id) for r in vectorindex.search(queries, index, 7).collect()}
    hits = sum((q, i) in near for q, found in got.items() for _, i, _ in found)
    assert hits >= 0.9 * sum(map(len, got.values())) and index.probes < len(index.reach) / 2


def test_index_reads_probed_partitions_only(spark, vectors, tmp_path):
    index = vectorindex.build(vectors, f"{tmp_path}/i")
    one = vectors.filter("id = 5").select(F.col("id").alias("query_id"), "embedding")
    found = vectorindex.search(one, index, 3, probes=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_list", plan)
    lists = {r["_list"] for r in index.rows(spark).filter(F.col("id").isin([r.id for r in found.collect()])).select("_list").collect()}
    assert len(lists) == 1


def test_filtered_search_goes_on(spark, vectors, tmp_path):
    """Rows that a filter leaves lie in far lists; the exact way finds them."""
    index = vectorindex.build(vectors, f"{tmp_path}/i")
    rows = vectors.collect()
    one = vectors.filter("id = 6").select(F.col("id").alias("query_id"), "embedding")
    got = vectorindex.search(one, index, 5, probes=1, exact=True, where=F.col("scenario") == "g1").orderBy("rank").collect()
    assert [r.id for r in got] == [i for i, _ in _scan(rows, rows[6].embedding, 5, lambda r: r.scenario == "g1")]
    top = catalog.semantic_top_k(vectors.filter("size(embedding) = 16 and not exists(embedding, x -> x is null or isnan(x))"), rows[6].embedding, 5, where=F.col("scenario") == "g1")
    assert [r.id for r in got] == [r.id for r in top.collect()]


def test_index_of_nothing(spark, vectors, tmp_path):
    index = vectorindex.build(vectors.filter("id > 5000"), f"{tmp_path}/i")
    assert vectorindex.search(vectors.select(F.col("id").alias("query_id"), "embedding"), index, 3).count() == 0


def _geodesic(lat1, lon1, lat2, lon2):
    """The distance in plain numbers, iterated to rest, with another form of the series."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    turn = lam = math.radians((lon2 - lon1 + 540) % 360 - 180)
    for _ in range(200):
        ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if ss == 0:
            return 0.0
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(ss, cs)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        c2a = 1 - sa * sa
        cm = cs - 2 * math.sin(u1) * math.sin(u2) / c2a if c2a > 1e-15 else 0.0
        c = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        old, lam = lam, turn + (1 - c) * f * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
        if abs(lam - old) < 1e-14:
            break
    u = c2a * (a * a - b * b) / (b * b)
    k = (math.sqrt(1 + u) - 1) / (math.sqrt(1 + u) + 1)
    big, small = (1 + k * k / 4) / (1 - k), k * (1 - 3 * k * k / 8)
    off = small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
    return b * big * (sigma - off)


def _dms(d, m, s):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


def _distances(spark, pairs):
    from wearlake.functions import geo

    df = spark.createDataFrame([(k, *map(lambda x: None if x is None else float(x), p)) for k, p in enumerate(pairs)], "k int, a double, b double, c double, d double")
    return [r.m for r in df.select("k", geo.geodesic(*map(F.col, "abcd")).alias("m")).orderBy("k").collect()]


def test_published_geodesics(spark):
    """Flinders Peak to Buninyong (54972.271 m on a very close ellipsoid), quarter meridian, a degree of the equator."""
    flinders = (_dms(-37, 57, 3.72030), _dms(144, 25, 29.52440), _dms(-37, 39, 10.15610), _dms(143, 55, 35.38390))
    got = _distances(spark, [flinders, (0, 0, 90, 0), (0, 0, 0, 1), (90, 10, -90, 50), (10, 20, 10, 20)])
    assert np.allclose(got, [54972.271, 10001965.729, 111319.491, 20003931.459, 0.0], atol=2e-3)


def test_geodesics_against_numbers(spark):
    rng = np.random.default_rng(1)
    pairs = [(np.degrees(np.arcsin(a)), b, np.degrees(np.arcsin(c)), d) for a, b, c, d in zip(rng.uniform(-1, 1, 300), rng.uniform(-180, 180, 300), rng.uniform(-1, 1, 300), rng.uniform(-180, 180, 300))]
    pairs = [p for p in pairs if _geodesic(*p) < 1.97e7]
    pairs += [(10.0, 179.9, 10.1, -179.9), (89.9, 0.0, 89.9, 180.0), (0.0, 5.0, 0.0, 25.0)]
    assert np.abs(np.array(_distances(spark, pairs)) - [_geodesic(*p) for p in pairs]).max() < 1e-3
    opposite = _distances(spark, [(0.1, 0, -0.05, 179.9), (None, 0, 0, 0)])
    assert abs(opposite[0] - 2.0e7) < 1.3e5 and opposite[1] is None


@pytest.mark.parametrize("metres", [500.0, 150_000.0, 3_000_000.0])
def test_cells_against_all_pairs(spark, metres):
    from wearlake.functions import geo
    from wearlake.operators import geocells

    rng = np.random.default_rng(2)
    spread = metres / 111_000
    base = [(0.0, 0.0), (89.99, 10.0), (-90.0, 0.0), (45.0, 179.99), (60.0, -180.0), (12.9, 77.5), (-33.0, 151.0), (85.0, 100.0)]
    near = lambda lat, lon: (float(np.clip(lat + rng.normal() * spread, -90, 90)), float((lon + rng.normal() * spread / max(0.02, math.cos(math.radians(lat))) + 540) % 360 - 180))
    points = [(k, *near(*base[k % len(base)])) for k in range(400)] + [(500, None, 1.0), (501, 91.0, 0.0), (502, 0.0, float("nan"))]
    centres = [(k, *p) for k, p in enumerate(base)] + [(90, None, None)]
    p = spark.createDataFrame(points, "id long, lat double, lon double")
    c = spark.createDataFrame(centres, "centre_id long, lat double, lon double")
    got = {(r.centre_id, r.id): r.distance_m for r in geocells.within(c, p, metres).collect()}
    far = geo.geodesic(F.col("lat"), F.col("lon"), F.col("b"), F.col("c"))
    every = c.filter("lat is not null").crossJoin(p.filter("lat between -90 and 90 and not isnan(lon)").selectExpr("id", "lat AS b", "lon AS c")).withColumn("m", far)
    want = {(r.centre_id, r.id): r.m for r in every.filter(F.col("m") <= metres).collect()}
    assert got == want and len(want) > 50
    some = {(r.centre_id, r.id) for r in geocells.within(c.withColumn("r", F.lit(metres) / (F.col("centre_id") + 1)), p, F.col("r")).collect()}
    assert some == {k for k, m in want.items() if m <= metres / (k[0] + 1)}


def test_on_a_sphere_it_is_the_haversine(spark, monkeypatch):
    from wearlake.functions import geo

    monkeypatch.setattr(geo, "FLATTENING", 0.0)
    monkeypatch.setattr(geo, "AXIS_M", geo.EARTH_M)
    monkeypatch.setattr(geo, "POLE_M", geo.EARTH_M)
    df = spark.createDataFrame([(12.0, 77.0, 13.5, 79.0), (-60.0, 170.0, 61.0, -10.0), (0.0, 0.0, 0.0, 1e-4)], "a double, b double, c double, d double")
    for r in df.select(geo.geodesic(*map(F.col, "abcd")).alias("g"), geo.haversine(*map(F.col, "abcd")).alias("h")).collect():
        assert abs(r.g - r.h) < 1e-5


def test_within_measures_each_pair_of_places_once(spark, monkeypatch):
    measured = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(*_):
        measured.add(1)
        return 5.0

    monkeypatch.setattr(geocells.geo, "geodesic", counted)
    place = [(F.lit(12.0) + F.col("id") % 2 * 1e-4).alias("lat"), (F.lit(77.0) + F.col("id") % 2 * 1e-4).alias("lon")]
    c, p = spark.range(30).select(F.col("id").alias("centre_id"), *place), spark.range(40).select("id", *place)
    got = geocells.within(c, p, 100.0).collect()
    assert len({(r.centre_id, r.id) for r in got}) == len(got) == 30 * 40 and {r.distance_m for r in got} == {5.0}
    assert measured.value <= 8
