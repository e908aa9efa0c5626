"""Training a small policy with Spark: gradients summed over partitions, decoupled weight decay, clipping, checkpoints.

Rows (a feature array and an action array) are dealt to mini-batches by the hash of their key and written once, a
partition a mini-batch, so that a step reads its mini-batch only.  A step is one aggregation: each task sums the
gradient of its rows, Spark adds the sums entry by entry; parameters live on the driver, where they are as many as the
model has, whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Policy:
    """tanh layer and linear head over standardised features: names to arrays."""

    weights: dict[str, np.ndarray]
    centre: np.ndarray
    scale: np.ndarray

    @classmethod
    def fresh(cls, inputs: int, hidden: int, actions: int, seed: int = 42) -> Policy:
        rng = np.random.default_rng(seed)
        layer = lambda n, m: rng.uniform(-1, 1, (n, m)) / math.sqrt(n)
        weights = {"hidden": layer(inputs, hidden), "hidden_bias": np.zeros(hidden), "head": layer(hidden, actions), "head_bias": np.zeros(actions)}
        return cls(weights, np.zeros(inputs), np.ones(inputs))

    def count_parameters(self) -> dict[str, int]:
        """Numbers per part of the model."""
        return {"hidden": self.weights["hidden"].size + self.weights["hidden_bias"].size, "head": self.weights["head"].size + self.weights["head_bias"].size}

    def predict(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh((x - self.centre) / self.scale @ w["hidden"] + w["hidden_bias"]) @ w["head"] + w["head_bias"]

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """(rows, sum of squared errors, their gradient by all parameters) as one vector."""
        w, x = self.weights, (x - self.centre) / self.scale
        h = np.tanh(x @ w["hidden"] + w["hidden_bias"])
        off = h @ w["head"] + w["head_bias"] - y
        back = 2 * off @ w["head"].T * (1 - h * h)
        parts = [x.T @ back, back.sum(axis=0), h.T @ (2 * off), 2 * off.sum(axis=0)]
        return np.concatenate([[len(x), (off**2).sum()], *(p.ravel() for p in parts)])

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.weights.values()])

    def unflat(self, v: np.ndarray) -> None:
        at = 0
        for k, old in self.weights.items():
            self.weights[k] = v[at : at + old.size].reshape(old.shape)
            at += old.size


@dataclass
class AdamW:
    """Moments of the gradient with decoupled weight decay; the gradient's length is cut at ``clip``."""

    rate: float = 3e-4
    decay: float = 0.01
    clip: float = 1.0
    betas: tuple[float, float] = (0.9, 0.999)
    first: np.ndarray | None = None
    second: np.ndarray | None = None
    steps: int = 0

    def step(self, v: np.ndarray, gradient: np.ndarray, rate: float) -> np.ndarray:
        size = float(np.linalg.norm(gradient))
        if self.clip > 0 and size > self.clip:
            gradient = gradient * (self.clip / (size + 1e-6))
        if self.first is None:
            self.first, self.second = np.zeros_like(v), np.zeros_like(v)
        self.steps += 1
        a, b = self.betas
        self.first = a * self.first + (1 - a) * gradient
        self.second = b * self.second + (1 - b) * gradient**2
        moved = self.first / (1 - a**self.steps) / (np.sqrt(self.second / (1 - b**self.steps)) + 1e-8)
        return v * (1 - rate * self.decay) - rate * moved


def learning_rate(step: int, total: int, rate: float, warmup: int, least: float = 1e-6) -> float:
    """Linear over ``warmup`` steps, then half a cosine down to ``least``; steps count from 0."""
    if step < warmup:
        return rate * (step + 1) / max(1, warmup)
    return least + (rate - least) * (1 + math.cos(math.pi * min(1.0, (step - warmup) / max(1, total - warmup)))) / 2


def deal(frames: DataFrame, path: str, batches: int, key: list[str], split: str | None = None, seed: int = 42) -> None:
    """Write rows (features, actions) with the mini-batch of each, train rows by the hash of their key, others as -1.

    ``split`` is a column that is ``train`` or anything else; without it a fifth of the keys isn't train.  Rows with a
    null or non-finite number don't train or validate.
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    hashed = F.xxhash64(F.lit(seed), *key)
    train = (F.col(split) == "train") if split else (F.pmod(F.xxhash64(F.lit(seed + 1), *key), F.lit(5)) > 0)
    number = F.when(train, F.pmod(hashed, F.lit(batches))).otherwise(F.lit(-1)).cast("int")
    own = frames.select(F.col("features").cast("array<double>").alias("features"), F.col("actions").cast("array<double>").alias("actions"), number.alias("_batch"), F.pmod(F.shiftright(hashed, 20), F.lit(32)).alias("_salt"))
    own.filter(finite("features") & finite("actions")).repartition("_batch", "_salt").drop("_salt").write.partitionBy("_batch").parquet(path)


def _added(rows: DataFrame, model: Policy, size: int) -> np.ndarray:
    """``model.sums`` over all rows: ``size`` numbers a task, added by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x, y = (np.array(batch.column(c).to_pylist(), np.float64) for c in ("features", "actions"))
                total += model.sums(x, y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["k", "value"])

    out = np.zeros(size)
    for r in rows.select("features", "actions").mapInArrow(run, "k int, value double").groupBy("k").agg(F.sum("value").alias("value")).collect():
        out[r.k] = r.value
    return out


@dataclass
class Run:
    """history: a dict an epoch (run, epoch, train_loss, val_loss, lr, checkpoint)."""

    model: Policy
    history: list[dict] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        names = ("run", "epoch", "train_loss", "val_loss", "lr", "checkpoint")
        return spark.createDataFrame(
            [tuple(h[n] for n in names) for h in self.history],
            "run string, epoch int, train_loss double, val_loss double, lr double, checkpoint string",
        )


def save_checkpoint(spark: SparkSession, model: Policy, path: str) -> None:
    """The parameters as rows (name, shape, values)."""
    parts = model.weights | {"centre": model.centre, "scale": model.scale}
    rows = [(k, list(v.shape), [float(x) for x in v.ravel()]) for k, v in parts.items()]
    spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def load_checkpoint(spark: SparkSession, path: str) -> Policy:
    parts = {r.name: np.array(r["values"]).reshape(r.shape) for r in spark.read.parquet(path).collect()}  # the model's own size
    return Policy({k: parts[k] for k in ("hidden", "hidden_bias", "head", "head_bias")}, parts["centre"], parts["scale"])


def train(
    spark: SparkSession, path: str, folder: str, epochs: int = 50, hidden: int = 32, rate: float = 3e-4, decay: float = 0.01, clip: float = 1.0,
    warmup: int = 500, save_every: int = 5, run: str = "run", seed: int = 42,
) -> Run:
    """Train on what ``deal`` wrote: mini-batches in an order drawn anew each epoch, mean squared error over the actions.

    Each epoch's losses are the history; the model goes to ``folder/epoch=N`` every ``save_every`` epochs, at the last
    one, and whenever the validation loss is the least so far, so ``episodes.best_checkpoint`` of the history names a
    checkpoint.  Without validation rows its loss is null.  No train rows is an error.
    """
    rows = spark.read.parquet(path)
    first = rows.filter("_batch >= 0").select(F.size("features").alias("n"), F.size("actions").alias("m")).first()
    if first is None:
        raise ValueError("no rows to train on")
    model = Policy.fresh(first.n, hidden, first.m, seed)
    # means and deviations of the features: two small rows an entry
    at = rows.filter("_batch >= 0").select(F.posexplode("features").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("a"), F.stddev_pop("x").alias("s")).collect()
    for r in at:
        model.centre[r.k], model.scale[r.k] = r.a, r.s if r.s > 1e-12 else 1.0
    numbers = sorted(r[0] for r in rows.filter("_batch >= 0").select("_batch").distinct().collect())
    size, optimiser, rng = model.flat().size + 2, AdamW(rate, decay, clip), np.random.default_rng(seed)
    out, step, least = Run(model), 0, math.inf
    for epoch in range(1, epochs + 1):
        losses, lr = [], rate
        for number in rng.permutation(numbers):
            got = _added(rows.filter(F.col("_batch") == int(number)), model, size)
            n = got[0] * first.m
            lr = learning_rate(step, epochs * len(numbers), rate, warmup)
            model.unflat(optimiser.step(model.flat(), got[2:] / n, lr))
            losses.append(got[1] / n)
            step += 1
        held = _added(rows.filter("_batch = -1"), model, size)
        val = float(held[1] / (held[0] * first.m)) if held[0] else None
        better = val is not None and val < least
        where = f"{folder}/epoch={epoch}" if better or epoch % save_every == 0 or epoch == epochs else None
        if where:
            save_checkpoint(spark, model, where)
        least = val if better else least
        out.history.append({"run": run, "epoch": epoch, "train_loss": float(np.mean(losses)), "val_loss": val, "lr": lr, "checkpoint": where})
    return out
