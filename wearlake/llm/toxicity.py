"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are lower-cased words (runs of letters) and their first 4, 5 and 6
bytes, so inflected forms share evidence.  A feature's value in a document is
log(1 + 50 * occurrences / sqrt(words)): between presence and density, so that
a few hits count in a long text too.  The vocabulary holds the features that
occur clearly more often in toxic than in clean labelled documents.

Severity grades are 0 (clean) and 1 to ``grades`` (toxic documents by quantiles
of the share of their words with toxic features).  One weight vector is shared
by all thresholds: P(grade > k) = sigmoid(w.x - theta_k), theta ascending.  The
score is the expected grade, the sum of these probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.llm import textvec as tv
from wearlake.llm.labelled import labelled_sample
from wearlake.llm.runtime import discard

PREFIXES = (4, 5, 6)


@dataclass
class OrdinalModel:
    """keys: feature hashes, ascending; weights: one per key; theta: a threshold per grade boundary, ascending."""

    keys: np.ndarray
    weights: np.ndarray
    theta: np.ndarray


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes (A-Z, and the capitals U+00C0 to U+00DE) and the mask of letter bytes."""
    data = tv.fold_ascii(data)
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][capital] += 32
    return data, ((data >= 97) & (data <= 122)) | (data >= 128)


def feature_hits(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Feature hashes of every word (one array per kind of feature), each word's text, and words per text."""
    data, letter = _letters(data)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = letter
    start, end = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    joined = cuts[inside[cuts] & inside[cuts + 1]]
    start[joined] = end[joined] = True
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    kinds = [tv.span_hashes(data, starts, ends)]
    for k in PREFIXES:
        cut = np.minimum(ends, starts + k)
        kinds.append(tv.mix64(tv.span_hashes(data, starts, cut) ^ np.uint64(k)))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return kinds, owner, np.bincount(owner, minlength=len(offsets) - 1)


def sparse_rows(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature index, value) of the features in ``keys`` that occur.  A long text is worked through in slices."""
    if len(offsets) == 2 and len(data) > tv.SLICE:
        cuts = tv.blank_cuts(data)  # no word has a blank
        slices = [(data[a:b], np.array([0, b - a])) for a, b in zip(cuts[:-1], cuts[1:])]
    else:
        slices = [(data, offsets)]
    pairs, words = [np.zeros(0, np.int64)], np.zeros(len(offsets) - 1, np.int64)
    for part, own in slices:
        kinds, owner, n = feature_hits(part, own)
        words += n
        for hashes in kinds if len(keys) else []:
            slot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = keys[slot] == hashes
            pairs.append(owner[hit] * len(keys) + slot[hit])
    pair, count = np.unique(np.concatenate(pairs), return_counts=True)
    text, feature = pair // max(len(keys), 1), pair % max(len(keys), 1)
    return text, feature, np.log1p(50.0 * count / np.sqrt(np.maximum(words[text], 1)))


def _vocabulary(sample: DataFrame, most: int, least_share: float, least_odds: float) -> np.ndarray:
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            for row, _, data, offsets in tv.blocks(batch.column(0)):
                kinds, owner, _ = feature_hits(data, offsets)
                owner, hashes = np.tile(owner, len(kinds)), np.concatenate(kinds)
                order = np.lexsort((owner, hashes))
                owner, hashes = owner[order], hashes[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                hashes, toxic = hashes[new], label[row + owner[new]]
                found, at = np.unique(hashes, return_index=True)
                n = np.diff(np.append(at, len(hashes)))
                ones = np.add.reduceat(toxic, at).astype(np.int64) if len(at) else n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(ones), pa.array(n - ones)], ["feature", "toxic", "clean"]
                )

    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    rate = lambda c, y: (F.col(c) + 0.5) / (size.get(y, 0) + 1.0)
    scored = (
        sample.select("text", "y").mapInArrow(seen, "feature long, toxic long, clean long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("odds", F.log(rate("toxic", 1) / rate("clean", 0)))
        .filter((F.col("toxic") >= max(3.0, least_share * size.get(1, 0))) & (F.col("odds") >= least_odds))
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "feature").limit(most)
    )
    return np.sort(np.array([r["feature"] for r in scored.select("feature").collect()], np.int64).view(np.uint64))  # at most ``most`` rows


def fit_ordinal(
    text: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, features: int, penalty: float = 1.0,
    steps: int = 400,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the mean negative log-likelihood of grades plus penalty * |w|^2 / 2n, by Adam."""
    n, cuts = max(len(grade), 1), max(int(grade.max(initial=0)), 1)
    w, theta = np.zeros(features), np.linspace(1.0, 2.0, cuts)
    m, v = np.zeros(features + cuts), np.zeros(features + cuts)
    for step in range(1, steps + 1):
        score = np.bincount(text, value * w[feature], minlength=n) if len(grade) else np.zeros(0)
        upper = 1 / (1 + np.exp(-np.clip(score[:, None] - theta[None, :], -40, 40)))  # P(grade > k)
        edge = np.concatenate((np.ones((len(grade), 1)), upper, np.zeros((len(grade), 1))), axis=1)
        slope = edge * (1 - edge)
        at = np.arange(len(grade))
        p = np.maximum(edge[at, grade] - edge[at, grade + 1], 1e-12)
        d_score = -(slope[at, grade] - slope[at, grade + 1]) / p
        d_theta = np.zeros(cuts)
        for k in range(cuts):
            d_theta[k] = np.sum(
                np.where(grade == k + 1, slope[:, k + 1] / p, 0.0) - np.where(grade == k, slope[:, k + 1] / p, 0.0)
            )
        g = np.concatenate(
            (np.bincount(feature, d_score[text] * value, minlength=features) / n + penalty * w / n, d_theta / n)
        )
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, theta = w - move[:features], np.sort(theta - move[features:])
    return w, theta


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, per_class: int = 3000, features: int = 4096, grades: int = 3,
    least_share: float = 0.01, least_odds: float = 2.0,
) -> OrdinalModel:
    """Fit on at most ``per_class`` toxic and as many clean labelled documents.

    A feature must occur in ``least_share`` of the toxic ones (3 at least) and
    have a log odds ratio of ``least_odds``; the ``features`` clearest are kept.

    Without toxic labels the model has no features and grades everything 0.
    """
    sample = labelled_sample(docs, labels, "toxic", per_class)
    keys = _vocabulary(sample, features, least_share, least_odds)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            for row, end, data, offsets in tv.blocks(batch.column(0)):
                text, feature, value = sparse_rows(data, offsets, keys)
                at = np.searchsorted(text, np.arange(end - row + 1))
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label[row:end]), lists(feature, pa.int32()), lists(value, pa.float64())], ["y", "f", "v"]
                )

    found = sample.select("text", "y").mapInArrow(rows, "y int, f array<int>, v array<double>").toPandas()  # at most 2 * per_class short rows
    discard(sample)
    if not len(keys) or not len(found):
        return OrdinalModel(keys[:0], np.zeros(0), np.full(grades, 40.0))
    size = found["f"].map(len).to_numpy()
    text = np.repeat(np.arange(len(found)), size)
    feature, value = np.concatenate(found["f"].to_list()).astype(np.int64), np.concatenate(found["v"].to_list())
    toxic = found["y"].to_numpy() == 1
    share = np.bincount(text, np.expm1(value), minlength=len(found))
    cut = np.quantile(share[toxic], np.arange(1, grades) / grades) if toxic.any() else np.zeros(grades - 1)
    grade = np.where(toxic, 1 + np.searchsorted(cut, share, side="left"), 0)
    w, theta = fit_ordinal(text, feature, value, grade, len(keys))
    return OrdinalModel(keys, w, theta)


def score_toxicity(
    docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", keep: bool = False,
    prefix: str = "",
) -> DataFrame:
    """Expected severity of every whole text.

    Returns ``id_col``, p_toxic (P(grade > 0)), severity (expected grade), grade
    (most probable) and toxic (p_toxic >= 0.5); with ``keep`` all input columns
    and these.  A null, empty or wordless text has no features and gets the
    scores of an empty feature vector; every row is scored by itself, so ties,
    repeats and null ids need no rule.  Results are named with ``prefix``;
    input columns named like a result are replaced.
    """
    added = [f"{prefix}{c}" for c in ("p_toxic", "severity", "grade", "toxic")]
    base = docs.drop(*added) if keep else docs.select(id_col, text_col)
    names = base.columns
    at_text, out_names = names.index(text_col), names if keep else [id_col]
    keys, w, theta = model.keys, model.weights, model.theta

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for row, end, data, offsets in tv.blocks(batch.column(at_text)):
                text, feature, value = sparse_rows(data, offsets, keys)
                scores.append(
                    np.bincount(text, value * w[feature], minlength=end - row) if len(text) else np.zeros(end - row)
                )
            s = np.concatenate(scores)
            above = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None, :], -40, 40)))
            edge = np.concatenate((np.ones((len(s), 1)), above, np.zeros((len(s), 1))), axis=1)
            grade = np.argmax(edge[:, :-1] - edge[:, 1:], axis=1).astype(np.int32)
            result = [pa.array(above[:, 0]), pa.array(above.sum(axis=1)), pa.array(grade), pa.array(above[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(names.index(c)) for c in out_names), *result], [*out_names, *added]
            )
        tv.trim()

    kinds = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in out_names)
    results = ", ".join(f"`{c}` {kind}" for c, kind in zip(added, ("double", "double", "int", "boolean")))
    return base.mapInArrow(score, f"{kinds}, {results}")
