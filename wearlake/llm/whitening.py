"""Embedding whitening by LOBPCG over distributed covariance-block products.

The leading eigenvectors of the covariance of all vectors are found without ever
forming the covariance: each step multiplies it with a narrow block of
directions, which is one pass over the centred rows (a partial product a task,
summed by Spark entry by entry).  The driver holds blocks of ``width`` x
``block`` numbers only.  A step does Rayleigh-Ritz on the span of iterate,
residual and previous direction; it ends when the residuals of freshly
multiplied directions are certified, and only then are rows whitened.

Entries are whole numbers, x = floor(scale * c) + shift, so that sums, means and
deviations are exact; (n * x - S) / n is the centred entry, rounded once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.llm.runtime import materialise

_EXACT = 1 << 62
#: Entries of this size or more have no whole number of 64 bits.
_MOST = float(1 << 62)


@dataclass
class Whitening:
    """n vectors with per-dimension sums S; columns of ``vectors`` are unit eigenvectors of their covariance by falling value."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    steps: int

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """(x - S/n as doubles, sum of (n*x - S)^2 a row; None where that is no long)."""
        n = self.n
        reach = n * max(1, int(np.abs(x).max(initial=0))) + int(np.abs(self.sums.astype(float)).max(initial=0))
        if reach >= _EXACT:
            far = x.astype(object) * n - self.sums.astype(object)
            squares = (far * far).sum(axis=1)
            return (far / n).astype(np.float64), [int(s) if s < 1 << 63 else None for s in squares]
        far = x * np.int64(n) - self.sums
        centre = far / n
        top = float(np.abs(far).max(initial=0))
        if top * top * max(1, x.shape[1]) < _EXACT:
            return centre, (far * far).sum(axis=1).tolist()
        squares = (far.astype(object) ** 2).sum(axis=1)
        return centre, [int(s) if s < 1 << 63 else None for s in squares]

    def project(self, centre: np.ndarray) -> np.ndarray:
        """Whitened coordinates; 0 on a component without variance."""
        there = self.values > 0
        scale = np.where(there, 1 / np.sqrt(np.where(there, self.values, 1)), 0.0)
        return (centre @ self.vectors) * scale


def whole_vectors(
    vectors: DataFrame, scale: float = 1024, shift: int = 100_000, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(id, width, x): x has floor(scale * c) + shift of each entry as little-endian longs.

    Null and empty vectors and those with null or non-finite entries, or with one so large that x is no long, have no row.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, widths, out = [], [], []
            for k, v in enumerate(batch.column(1).to_pylist()):
                if not v or None in v:
                    continue
                c = np.floor(scale * np.array(v, np.float64))
                if np.isfinite(c).all() and (np.abs(c) < _MOST).all():
                    keep.append(k)
                    widths.append(len(c))
                    out.append((c.astype(np.int64) + shift).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(widths, pa.int32()), pa.array(out, pa.binary())],
                ["id", "width", "x"],
            )

    return vectors.select(F.col(id_col).alias("id"), vec_col).mapInArrow(run, f"id {id_type}, width int, x binary")


def _rows(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their entries as one matrix."""
    for k in range(0, batch.num_rows, 4096):
        part = batch.slice(k, 4096)
        raw = b"".join(part.column("x").to_pylist())
        yield part, np.frombuffer(raw, "<i8").reshape(part.num_rows, width)


def _summed(rows: DataFrame, width: int, kind: str, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of ``part`` (``size`` numbers for a matrix of rows): a partial sum a task, added by Spark entry by entry."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype)
        for batch in batches:
            for _, x in _rows(batch, width):
                total += part(x).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["k", "value"])

    sums = rows.mapInArrow(run, f"k int, value {kind}").groupBy("k").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size, dtype)
    for row in sums:  # ``size`` rows, whatever the input
        out[row.k] = row.value
    return out


def _orthonormal(x: np.ndarray, blocks: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of what blocks span outside the orthonormal columns of x; dependent directions are left out."""
    basis = x
    for b in blocks:
        size = np.linalg.norm(b, axis=0)
        b = b[:, size > 0] / size[size > 0]
        for _ in range(2):
            b = b - basis @ (basis.T @ b)
            u, s, _ = np.linalg.svd(b, full_matrices=False)
            b = u[:, s > 1e-8]
        basis = np.hstack((basis, b))[:, : len(x)]
    return basis[:, x.shape[1] :]


def _ritz(basis: np.ndarray, a_basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, falling, and their coordinates in an orthonormal basis."""
    value, turn = np.linalg.eigh((basis.T @ a_basis + a_basis.T @ basis) / 2)
    return value[::-1], turn[:, ::-1]


def lobpcg(
    product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, guard: int = 16, tolerance: float = 1e-14,
    most_steps: int = 500, seed: int = 11,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(values, unit vectors as columns, residual norms, steps) of the ``wanted`` largest eigenpairs of a symmetric operator.

    ``product`` multiplies the operator with a block of columns.  The residual
    norms returned are those of freshly multiplied vectors and at most 100 times
    ``tolerance`` (one rounding at least) of the largest value; steps go on while
    they fall.  Without that after ``most_steps`` it is an error.
    """
    wanted = min(wanted, dim)
    m = min(dim, wanted + guard)
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, m)))[0]
    ax, direction = product(x), np.zeros((dim, 0))
    best, stalled = np.inf, 0
    for step in range(1, most_steps + 1):
        value, turn = _ritz(x, ax)
        x, ax = x @ turn, ax @ turn
        residual = ax - x * value
        worst = float(np.linalg.norm(residual, axis=0)[:wanted].max())
        aim = max(tolerance, np.finfo(float).eps) * max(float(value[0]), np.finfo(float).tiny)
        best, stalled = (worst, 0) if worst < 0.5 * best else (best, stalled + 1)
        if worst <= aim or stalled >= 3 and worst <= 100 * aim or m == dim:
            x = np.linalg.qr(x)[0]
            ax = product(x)  # certified on fresh products, not on combined ones
            value, turn = _ritz(x, ax)
            x, ax = x @ turn, ax @ turn
            residual = ax - x * value
            certified = np.linalg.norm(residual, axis=0)[:wanted]
            if certified.max() <= 100 * aim:
                return np.maximum(value[:wanted], 0), x[:, :wanted], certified, step
            direction, best, stalled = np.zeros((dim, 0)), np.inf, 0
        new = _orthonormal(x, [residual, direction])
        basis, a_basis = np.hstack((x, new)), np.hstack((ax, product(new)))
        _, turn = _ritz(basis, a_basis)
        turn = turn[:, :m]
        x, ax, direction = basis @ turn, a_basis @ turn, new @ turn[m:]
    raise ArithmeticError(f"residuals of {worst} after {most_steps} steps")


def fit_whitening(rows: DataFrame, width: int, components: int = 8, guard: int = 16, tolerance: float = 1e-14) -> Whitening:
    """The leading components of all rows of ``whole_vectors`` of one width."""
    n, head = rows.count(), np.zeros(width, np.int64)
    if not n:
        return Whitening(0, head, np.zeros(0), np.zeros((width, 0)), 0.0, np.zeros(0), 0)
    sums = _summed(rows, width, "long", lambda x: x.sum(axis=0), width)
    plain = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0, np.zeros(0), 0)
    trace = float(_summed(rows, width, "double", lambda x: np.array([(plain.centred(x)[0] ** 2).sum()]), 1)[0]) / n

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = plain.centred(x)[0]
            return c.T @ (c @ block)

        return _summed(rows, width, "double", part, block.size).reshape(block.shape) / n

    if trace == 0:
        k = min(components, width)
        return Whitening(n, sums, np.zeros(k), np.eye(width)[:, :k], 0.0, np.zeros(k), 0)
    values, vectors, residuals, steps = lobpcg(product, width, components, guard, tolerance)
    values = np.where(values > 1e-12 * values[0], values, 0.0)  # below it is rounding, not variance
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return Whitening(n, sums, values, vectors, trace, residuals, steps)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over components that have variance."""
    there = model.values > 0
    k = int(there.sum())
    if not k:
        return 0.0

    def part(x: np.ndarray) -> np.ndarray:
        w = model.project(model.centred(x)[0])[:, there]
        return np.concatenate((w.sum(axis=0), (w.T @ w).reshape(-1)))

    total = _summed(rows, len(model.sums), "double", part, k + k * k) / model.n
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    vectors: DataFrame, components: int = 8, scale: float = 1024, shift: int = 100_000, guard: int = 16,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """One row per remaining vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Null and empty vectors and those with null or non-finite entries (or with
    one so large that x is no long) have no rows; so have vectors of another
    width than the most frequent one (the wider of equals).  Rows with a null or
    repeated id and equal vectors are rows like others.  A component without
    variance has whitened 0 and isn't in ``identity_error``; ``deviation`` is
    null where it is no long.  Other columns are left out.  An empty table gives
    an empty result.  Directions of equal eigenvalues are any basis of their span.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    written = materialise(whole_vectors(vectors, scale, shift, id_col, vec_col), "whole-vectors")
    usual = written.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    width = usual.width if usual else 1
    rows = written.filter(F.col("width") == width)
    model = fit_whitening(rows, width, components, guard)
    error = identity_error(rows, model)
    explained = model.values / model.trace if model.trace else np.zeros(len(model.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            for part, x in _rows(batch, width):
                centre, deviation = model.centred(x)
                size = len(x)
                which = np.repeat(np.arange(size), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(which)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, model.n)), pa.array(deviation, pa.int64()).take(pa.array(which)),
                        pa.array(model.project(centre).reshape(-1)), pa.array(np.tile(explained, size)),
                        pa.array(np.full(size * k, error)),
                    ],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(
        run,
        f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
