"""Training over Spark against one process, and what comes out of it."""

import numpy as np
import pytest

from wearlake.operators import episodes, training


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5)) * [1, 10, 0.1, 1, 1] + [0, 5, 0, 0, 7]
    y = np.tanh(x[:, :1]) @ np.ones((1, 7)) + 0.1 * x[:, 3:4]
    rows = [(k, v.tolist(), a.tolist(), "train" if k % 4 else "val") for k, (v, a) in enumerate(zip(x, y))]
    rows += [(900, None, y[0].tolist(), "train"), (901, [float("nan")] * 5, y[0].tolist(), "train"), (902, [None] * 5, y[0].tolist(), "val")]
    return spark.createDataFrame(rows, "id long, features array<double>, actions array<double>, split string")


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    model = training.Policy.fresh(4, 3, 7)
    x, y = rng.normal(size=(9, 4)), rng.normal(size=(9, 7))
    got, flat = model.sums(x, y), model.flat()
    assert got[0] == 9 and np.isclose(got[1], ((model.predict(x) - y) ** 2).sum())
    for k in range(len(flat)):
        ends = []
        for h in (1e-6, -1e-6):
            moved = flat.copy()
            moved[k] += h
            model.unflat(moved)
            ends.append(((model.predict(x) - y) ** 2).sum())
        assert np.isclose(got[2 + k], (ends[0] - ends[1]) / 2e-6, atol=1e-5)


def test_training_equals_one_process(spark, frames, tmp_path):
    training.deal(frames, f"{tmp_path}/d", 4, ["id"], "split")
    got = training.train(spark, f"{tmp_path}/d", f"{tmp_path}/c", epochs=6, hidden=8, rate=0.02, warmup=3, save_every=4)
    rows = spark.read.parquet(f"{tmp_path}/d").toPandas()
    assert len(rows) == 600 and (rows._batch == -1).sum() == 150
    x, y = np.array(rows.features.tolist()), np.array(rows.actions.tolist())
    train = rows._batch.to_numpy() >= 0
    model = training.Policy.fresh(5, 8, 7)
    model.centre, model.scale = x[train].mean(axis=0), x[train].std(axis=0)
    rng, first, second, v, step = np.random.default_rng(42), 0.0, 0.0, model.flat(), 0
    for epoch in range(6):
        losses = []
        for b in rng.permutation(range(4)):
            own = rows._batch.to_numpy() == b
            s = model.sums(x[own], y[own])
            g = s[2:] / (own.sum() * 7)
            losses.append(s[1] / (own.sum() * 7))
            g = g * min(1.0, 1.0 / (np.linalg.norm(g) + 1e-6)) if np.linalg.norm(g) > 1 else g
            lr = 0.02 * (step + 1) / 3 if step < 3 else 1e-6 + (0.02 - 1e-6) * (1 + np.cos(np.pi * (step - 3) / 21)) / 2
            step += 1
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            v = v - lr * 0.01 * v - lr * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            model.unflat(v)
        h = got.history[epoch]
        val = ((model.predict(x[~train]) - y[~train]) ** 2).mean()
        assert np.isclose(h["train_loss"], np.mean(losses), rtol=1e-9) and np.isclose(h["val_loss"], val, rtol=1e-9)
    assert np.allclose(got.model.flat(), model.flat(), rtol=1e-8)
    assert got.history[-1]["train_loss"] < 0.5 * got.history[0]["train_loss"]
    best = episodes.best_checkpoint(got.table(spark)).first()
    assert best.val_loss == min(h["val_loss"] for h in got.history)
    back = training.load_checkpoint(spark, best.checkpoint)
    assert np.isclose(((back.predict(x[~train]) - y[~train]) ** 2).mean(), best.val_loss)
    assert got.history[3]["checkpoint"] and got.history[5]["checkpoint"]
    assert got.model.count_parameters() == {"hidden": 48, "head": 63}


def test_clipping_and_rates(spark, frames, tmp_path):
    a, b = training.AdamW(clip=1.0), training.AdamW(clip=0.0)
    g, v = np.full(4, 100.0), np.ones(4)
    assert np.allclose(a.step(v, g, 0.1), v * (1 - 0.001) - 0.1, atol=1e-6) and np.isclose(np.linalg.norm(a.first) / 0.1, 1.0, atol=1e-5)
    b.step(v, g, 0.1)
    assert np.isclose(np.linalg.norm(b.first), 20.0)
    assert [round(training.learning_rate(k, 10, 1.0, 2, 0.0), 6) for k in (0, 1, 2, 6, 10, 50)] == [0.5, 1.0, 1.0, 0.5, 0.0, 0.0]
    training.deal(frames.filter("false"), f"{tmp_path}/e", 2, ["id"])
    with pytest.raises(Exception):  # noqa: B017  (no files, or no rows)
        training.train(spark, f"{tmp_path}/e", f"{tmp_path}/c", epochs=1)
    training.deal(frames, f"{tmp_path}/d", 2, ["id"])
    assert 60 < spark.read.parquet(f"{tmp_path}/d").filter("_batch = -1").count() < 180
