"""Whitening, sharding and hard negatives against brute force, and awkward inputs."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wearlake.llm import jaccard, mixing, negatives, queries, sharding, whitening
from wearlake.llm.runtime import scratch, shared_dir

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"
NAN = float("nan")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, repeats, ties, zero and unequal widths, and columns with names that results use."""
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.standard_normal(6)], int(rng.integers(3))) for k in range(220)]
    rows += [(50, rows[50][1], rows[50][2]), (221, rows[3][1], rows[3][2]), (222, rows[3][1], 2 - rows[3][2])]
    rows += [(None, rows[7][1], 1), (223, None, 1), (224, [], 1), (225, [None] * 6, 0), (226, [NAN] * 6, 0), (227, [float("inf")] * 6, 0)]
    rows += [(228, [0.0] * 6, 1), (229, [1.0, 2.0], 1), (230, rows[1][1], None), (250, [0.0] * 6, 0)]
    return spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS row", "2 AS x", "3 AS width", "'4' AS rank", "5 AS n", "6 AS id")


def _whole(rows, scale):
    out = []
    for r in rows:
        v = r["embedding"]
        if v and None not in v and np.isfinite(v).all():
            out.append((r["vec_id"], r["label"], np.floor(scale * np.array(v, float)).astype(np.int64)))
    return out


def _check_whitened(df, got, components=8):
    rows = [(i, x + 100_000) for i, _, x in _whole(df.collect(), 1024) if len(x) == 6 or len(x) == 64]
    n, x = len(rows), np.array([x for _, x in rows])
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    centre = (x * n - x.sum(axis=0)) / n
    cov = centre.T @ centre / n
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(components, x.shape[1])
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in got.itertuples()) == Counter(
        (i, c, n, int(d)) for (i, _), d in zip(rows, deviation) for c in range(1, k + 1)
    )
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    seen = {(r.vec_id, r.component): (r.whitened, r.explained) for r in got.itertuples()}
    for c in range(k):
        want = centre @ vector[:, c] / np.sqrt(value[c])
        have = np.array([seen[i, c + 1][0] for i, _ in rows])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
        assert abs(seen[rows[0][0], c + 1][1] / (value[c] / np.trace(cov)) - 1) < 1e-10


def test_whitening(spark, awkward):
    part = awkward.filter("vec_id is not null")
    _check_whitened(part, whitening.whiten(part).toPandas())
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    _check_whitened(table, queries.op11_whitening(spark, SMALL).toPandas())


def test_whitening_of_nothing_and_of_equals(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(k, [1.0, 2.0, 3.0], 1) for k in range(4)], VECTORS)).toPandas()
    assert len(same) == 12 and set(same.whitened) == {0.0} and set(same.explained) == {0.0} and set(same.deviation) == {0}
    line = whitening.whiten(spark.createDataFrame([(k, [float(k), 2.0 * k], 1) for k in range(5)], VECTORS)).toPandas()
    first, second = line[line.component == 1], line[line.component == 2]
    assert abs((first.whitened**2).mean() - 1) < 1e-9 and set(second.whitened) == {0.0} and line.identity_error[0] < 1e-9


def test_whitening_deviation_that_is_no_long(spark):
    df = spark.createDataFrame([(1, [1e9], 1), (2, [-1e9], 1), (3, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    got = whitening.whiten(df).toPandas()
    x = [1024 * 10**9 + 100_000, -1024 * 10**9 + 100_000, 101_024]
    squares = [(3 * v - sum(x)) ** 2 for v in x]
    assert [None if d != d else d for d in got.sort_values("vec_id").deviation] == [s if s < 1 << 63 else None for s in squares]
    want = np.array([float(v * 3 - sum(x)) / 3 for v in x])
    assert np.allclose(np.abs(got.sort_values("vec_id").whitened), np.abs(want) / np.sqrt((want**2).mean()))


def test_lobpcg_certifies():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((300, 90)) * np.linspace(1, 3, 90)
    cov = a.T @ a / 300
    value, vectors, residuals, _ = whitening.lobpcg(lambda b: cov @ b, 90, 8, guard=8)
    assert np.allclose(value, np.linalg.eigvalsh(cov)[::-1][:8], rtol=1e-13)
    assert (residuals <= 1e-12 * value[0]).all() and np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-13)
    with pytest.raises(ArithmeticError):
        whitening.lobpcg(lambda b: cov @ b, 90, 8, guard=0, most_steps=2)


DOCS = "doc_id long, text string"


def _tree_shard(key, node):
    """The draws in plain Python."""
    import hashlib
    import math

    while node.children:
        there = [c for c in node.children if c.total > 0]
        if len(there) > 1:
            u = lambda c: (int(hashlib.md5(f"{c.name}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            node = min(there, key=lambda c: -math.log(u(c)) / c.total)
        else:
            node = there[0]
    return node.shard


def test_sharding(spark):
    rows = [(k, f"text {k}" * (k % 5)) for k in range(2000)] + [(5, "text 5"), (5, "text 5"), (5, None), (None, "é"), (None, None), (7, "")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size", "4 AS _slot_tie")
    got = sharding.shard_documents(docs).toPandas()
    tree = sharding.even_tree()
    more = sharding.grown(tree)
    text = lambda k: "" if k is None else str(k)
    want = Counter(
        (k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), _tree_shard(text(k), tree), _tree_shard(text(k), more)) for k, t in rows
    )
    clean = lambda k: None if k != k else int(k)
    assert Counter((clean(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard) for r in got.itertuples()) == want
    assert set(got.law) == {"key"} and set(got.shard) == set(range(24)) and set(got.grown_shard) == set(range(25))
    moved = got[got.shard != got.grown_shard]
    assert set(moved.grown_shard) == {24} and 40 < len(moved) < 130
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
        order = part.sort_values("slot")[["doc_id", "text_crc32"]].fillna(-1)
        assert list(order.itertuples(index=False, name=None)) == sorted(order.itertuples(index=False, name=None))
    assert sharding.shard_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_slots_of_one_key_lie_in_many_parts(spark):
    rows = spark.range(20000).selectExpr("1 AS shard", "5 AS doc_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one part
    try:
        got = sharding.slots(rows, "shard", ["doc_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.slot for r in got.collect()) == list(range(20000))
    spread = spark.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0])
    per_part = spread.groupBy(spread["_slot_place"].bitwiseAND(~((1 << 33) - 1)).alias("p")).count().collect()
    assert len(per_part) > 4 and max(r["count"] for r in per_part) < 8000


def test_movement_is_confined(spark):
    keys = spark.range(20000).selectExpr("id AS doc_id", "'' AS text")
    old = sharding.Node("root", children=(sharding.region(0, [[(0, 1), (1, 2)], [(2, 1)]]), sharding.region(1, [[(3, 1)], [(4, 1), (5, 1)]])))
    new = sharding.Node("root", children=(old.children[0], sharding.region(1, [[(3, 1)], [(4, 1), (5, 1), (6, 2)]])))
    a, b = (sharding.with_shard(keys, t).toPandas().set_index("doc_id")["shard"] for t in (old, new))
    share = a.value_counts(normalize=True)
    assert abs(share[1] - 2 / 7) < 0.02 and abs(share[0] - 1 / 7) < 0.02
    moved = a.index[a != b]
    assert {b[k] for k in moved} <= {3, 4, 5, 6} and not any(b[k] in (0, 1, 2) for k in moved)
    # inside the region, rows that were there move only into the rack whose weight rose, in it only into the new shard
    assert all(b[k] in (4, 5, 6) for k in moved if a[k] == 3) and all(b[k] == 6 for k in moved if a[k] in (4, 5))
    assert abs(b.value_counts(normalize=True)[6] - 2 / 9) < 0.02


def test_shards_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(k, "x" * k) for k in range(300)], DOCS)
    sharding.write_shards(docs, f"{tmp_path}/out", sharding.even_tree(3), rows_per_file=10)
    back = spark.read.parquet(f"{tmp_path}/out").toPandas()
    assert sorted(zip(back.doc_id, back.text)) == [(k, "x" * k) for k in range(300)]
    assert all(_tree_shard(str(r.doc_id), sharding.even_tree(3)) == r.shard for r in back.itertuples())


def _brute_negatives(rows, positives=5, negatives_=3, every=50):
    by_width = defaultdict(list)
    for n, (i, label, x) in enumerate(_whole(rows, 256)):
        if label is not None:
            by_width[len(x)].append((n, i, label, x))
    out = Counter()
    top = 1 << 63
    for own in by_width.values():
        for n, i, label, x in own:
            if i is None or i % every:
                continue
            score = sorted((-int(x @ y), top if j is None else j, m, lj) for m, j, lj, y in own if m != n)
            for s, p, _, _ in [s for s in score if s[3] == label][:positives]:
                inside = [t for t in score if t[3] != label and 50 * -s <= 100 * -t[0] <= 95 * -s][:negatives_]
                for rank, t in enumerate(inside, 1):
                    out[i, None if p == top else p, rank, None if t[1] == top else t[1], -s, -t[0]] += 1
    return out


@pytest.mark.parametrize("block", [16, 2048])
def test_hard_negatives(spark, awkward, block):
    clean = lambda v: None if v != v else int(v)
    got = negatives.hard_negatives(awkward, block=block, every=10).toPandas()
    assert Counter(tuple(map(clean, r)) for r in got.itertuples(index=False, name=None)) == _brute_negatives(awkward.collect(), every=10)
    assert len(got) > 100
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0


def test_hard_negatives_of_the_table(spark):
    rows = [
        {"vec_id": r.vec_id, "embedding": r.embedding, "label": (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label}
        for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ]
    got = queries.op13_hard_negatives(spark, SMALL).toPandas()
    assert Counter(tuple(int(v) for v in r) for r in got.itertuples(index=False, name=None)) == _brute_negatives(rows)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (900, 24))
    books = negatives.fit_codebooks(x[:200].astype(float), codes=16)
    low, high = books.interval(x[:40].astype(float), *books.encode(x.astype(float)))
    score = x[:40] @ x.T
    assert (low <= score).all() and (score <= high).all() and (high - low).mean() < 2 * np.abs(score).max()


def test_labels_are_equal_by_value(spark):
    rows = [(0, [1.0, 0.0], 1.2), (1, [1.0, 0.0], 1.7), (2, [0.9, 0.0], 1.2), (3, [0.7, 0.0], 1.7)]
    got = negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")).toPandas()
    assert [tuple(r)[:4] for r in got.itertuples(index=False)] == [(0, 2, 1, 3)]


def test_tables_of_a_scratch_are_deleted(spark):
    docs = spark.createDataFrame([(k, f"one two three four five six {k % 3}", "s") for k in range(12)], "doc_id long, text string, source string")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch(spark):
        found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
        with scratch(spark):
            mixing.mix(docs).collect()
            inner = set(os.listdir(folder))
        assert before < set(os.listdir(folder)) < inner
    assert found == {k: k % 3 for k in range(12)} and set(os.listdir(folder)) == before
    with pytest.raises(ValueError), scratch(spark):
        jaccard.jaccard_components(docs)
        raise ValueError
    assert set(os.listdir(folder)) == before
