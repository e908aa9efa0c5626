"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics.  Each class is a Gaussian
whose covariance is shrunk towards its mean variance and the pooled covariance.
The score is the posterior of class 1 from the difference of log densities,
with Mahalanobis distances through Cholesky factors computed once at the fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.llm import textvec as tv
from wearlake.llm.labelled import class_counts, labelled_sample
from wearlake.llm.runtime import discard

STATISTICS = (
    "words", "bytes_per_word", "word_length_spread", "upper", "digits", "high", "sentence_marks", "symbols", "word_symbols",
    "lines", "distinct_words", "distinct_pairs", "distinct_lines", "capital_words", "short_words",
)
_KIND = np.zeros(256, np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 symbol, 6 line end, 7 byte of a longer character
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 7
_KIND[[ord(c) for c in ".,;:?!'\"()-"]] = 4
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_KIND[10] = 6


def _share(part: np.ndarray, whole: np.ndarray, usual: float, weight: float) -> np.ndarray:
    """The logit of a share, drawn towards a usual one as by ``weight`` more observations, so short texts stay near it."""
    return np.log((part + weight * usual) / (np.maximum(whole - part, 0) + weight * (1 - usual)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of transformed statistics for each text; an empty text has those of no words and no bytes."""
    n = len(offsets) - 1
    kind = _KIND[data]

    def per_text(mask: np.ndarray) -> np.ndarray:
        out, full = np.zeros(n, np.int64), np.diff(offsets) > 0
        if full.any():
            out[full] = np.add.reduceat(mask, offsets[:-1][full], dtype=np.int64)
        return out

    def per_word(mask: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(mask)
        return np.searchsorted(at, ends) - np.searchsorted(at, starts)

    size = np.diff(offsets).astype(float)
    starts, ends, first = tv.word_bounds(data, offsets)
    words = np.diff(first).astype(float)
    length = (ends - starts).astype(float)
    owner = np.repeat(np.arange(n), np.diff(first))
    by = lambda x: np.bincount(owner, x, minlength=n)
    mean = by(length) / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(by(length**2) / np.maximum(words, 1) - mean**2, 0))
    capital = (per_word(kind == 2) >= 2).astype(float)
    marked = (per_word(kind == 5) > 0).astype(float)
    hashes = tv.span_hashes(tv.fold_ascii(data), starts, ends)
    distinct = lambda values, begin: np.diff(tv.distinct_by_text(values, begin)[1]).astype(float)
    pairs, pair_first = tv.shingle_hashes(hashes, first, 2)
    # lines: split at line ends and text ends
    cut = np.union1d(np.flatnonzero(kind == 6) + 1, offsets)
    line_starts, line_ends = cut[:-1], cut[1:]
    full = line_ends > line_starts
    line_starts, line_ends = line_starts[full], line_ends[full]
    bare = line_ends - (data[line_ends - 1] == 10) if len(line_ends) else line_ends
    line_first = np.searchsorted(line_starts, offsets, side="left")
    lines = np.diff(line_first).astype(float)
    columns = [
        np.log1p(words), np.log1p(mean), np.log1p(spread),
        _share(per_text(kind == 2), size, 0.03, 60), _share(
            per_text(kind == 3), size, 0.004, 60
        ), _share(per_text(kind == 7), size, 0.02, 60),
        _share(per_text(kind == 4), size, 0.03, 60), _share(
            per_text(kind == 5), size, 0.002, 60
        ), _share(by(marked), words, 0.005, 10), np.log1p(lines) - np.log1p(words),
        _share(distinct(hashes, first), words, 0.9, 10), _share(
            distinct(pairs, pair_first), np.diff(pair_first).astype(float), 0.97, 10
        ),
        _share(
            distinct(tv.span_hashes(data, line_starts, bare), line_first), lines, 0.97, 5
        ), _share(by(capital), words, 0.01, 10), _share(by((length <= 3).astype(float)), words, 0.4, 10),
    ]
    return np.stack(columns, axis=1)


@dataclass
class QuadraticModel:
    """Centre and scale of the statistics; for each class its mean, lower Cholesky factor, log determinant and log prior;
    the temperature by which log-density differences are divided."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    temperature: float = 1.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            y = np.linalg.solve(factor, (z - mean).T)
            density.append(-0.5 * log_det - 0.5 * np.sum(y * y, axis=0))
        return density[1] - density[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        odds = self.differences(x) / self.temperature + self.log_priors[1] - self.log_priors[0]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_quadratic(x: np.ndarray, y: np.ndarray, pooled: float = 0.1, ridge: float = 0.05) -> QuadraticModel:
    """Class covariances: (1 - pooled) own + pooled common, then (1 - ridge) of that + ridge * its mean variance * I.

    A class without rows takes the common mean and covariance and a prior of one row.
    """
    d = x.shape[1]
    if not len(x):
        x, y = np.zeros((2, d)), np.array([0, 1])
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - centre) / scale
    cov = lambda a: np.cov(a, rowvar=False, bias=True).reshape(d, d) if len(a) > 1 else np.eye(d)
    groups = [z[y == k] for k in (0, 1)]
    common = sum(len(g) * cov(g) for g in groups) / max(len(z), 1)
    means, factors, dets, priors = [], [], [], []
    for g in groups:
        s = (1 - pooled) * (cov(g) if len(g) > 1 else common) + pooled * common
        s = (1 - ridge) * s + ridge * max(np.trace(s) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(s)
        means.append(g.mean(axis=0) if len(g) else np.zeros(d))
        factors.append(factor)
        dets.append(2 * np.log(np.diag(factor)).sum())
        priors.append(np.log(max(len(g), 1) / max(len(z), 1)))
    return QuadraticModel(centre, scale, np.array(means), np.array(factors), np.array(dets), np.array(priors))


def best_temperature(difference: np.ndarray, y: np.ndarray, log_priors: np.ndarray) -> float:
    """The temperature, 1 at least, of least log loss on rows that the densities weren't fitted on.

    Classes weigh as their priors.  Labels are smoothed to (n + 1) / (n + 2) and
    1 / (n + 2) of their class, so that separable rows don't ask for certainty.
    """
    n = [int((y == k).sum()) for k in (0, 1)]
    if not all(n):
        return 1.0
    goal = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight = np.where(y == 1, np.exp(log_priors[1]) / n[1], np.exp(log_priors[0]) / n[0])
    tried = np.exp(np.linspace(0, np.log(1e4), 400))

    def loss(t: float) -> float:
        odds = difference / t + log_priors[1] - log_priors[0]
        return float((weight * (np.logaddexp(0, -odds) * goal + np.logaddexp(0, odds) * (1 - goal))).sum())

    return float(tried[int(np.argmin([loss(t) for t in tried]))])


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned: crc32 of the id as text, modulo 3, is 1.  A null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 10_000, calibrate: int = 5) -> QuadraticModel:
    """Fit on at most ``per_class`` labelled documents of each class that aren't held out.

    Every ``calibrate``-th of them by a hash of its text sets the temperature,
    the others the densities; priors are the classes' shares of all labels that
    aren't held out.
    """
    sample = labelled_sample(docs, labels, "quality", per_class, ~held_out(F.col("doc_id")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate(
                [
                    np.zeros((0, len(STATISTICS))),
                    *(statistics(data, offsets) for _, _, data, offsets in tv.blocks(batch.column(0))),
                ]
            )
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([flat, batch.column(1), batch.column(2)], ["x", "y", "k"])

    place = F.pmod(F.xxhash64("text"), F.lit(calibrate)).cast("int")
    found = sample.select("text", "y", place.alias("k")).mapInArrow(rows, "x array<double>, y int, k int").toPandas()  # at most 2 * per_class rows of 15 numbers
    discard(sample)
    x, y, late = np.array(
        found["x"].to_list(), float
    ).reshape(-1, len(STATISTICS)), found["y"].to_numpy(), found["k"].to_numpy() == 0
    model = fit_quadratic(x[~late], y[~late])
    n = class_counts(labels, "quality", ~held_out(F.col("doc_id")))
    model.log_priors = np.log(np.maximum(np.array(n, float), 1) / max(sum(n), 1))
    model.temperature = best_temperature(model.differences(x[late]), y[late], model.log_priors)
    return model


def score_quality(
    docs: DataFrame, model: QuadraticModel, id_col: str = "doc_id", text_col: str = "text", keep: bool = False,
    prefix: str = "",
) -> DataFrame:
    """``id_col``, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.5) of every whole text.

    With ``keep`` all input columns and these two.  Only the text is an input of
    the score.  A null text counts as empty and gets the score of an empty
    text; rows are scored one by one, so repeats, ties and null ids need no
    rule.  Results are named with ``prefix``; input columns named like a result
    are replaced.
    """
    added = [f"{prefix}score", f"{prefix}predicted"]
    base = docs.drop(*added) if keep else docs.select(id_col, text_col)
    names = base.columns
    at_text, out_names = names.index(text_col), names if keep else [id_col]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.concatenate([np.zeros(0), *(model.scores(statistics(data, offsets)) for _, _, data, offsets in tv.blocks(batch.column(at_text)))])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(names.index(c)) for c in out_names), pa.array(s),
                    pa.array((s >= 0.5).astype(np.int32)),
                ], [*out_names, *added]
            )
        tv.trim()

    kinds = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in out_names)
    return base.mapInArrow(score, f"{kinds}, `{added[0]}` double, `{added[1]}` int")
