"""Hard negatives by product quantisation with stored residual norms.

Vectors are whole numbers.  Each is coded by a codebook per subspace and keeps
the norm of what its code leaves out, per subspace.  An anchor's score with a
row is the sum of table entries (anchor part times code) plus or minus the sum
of anchor-part norms times residual norms: a rigorous interval.  In a block of
anchors and rows, rows are dropped only if their interval can't reach the k-th
best one that is sure to count; the rest are scored exactly in whole numbers.

Two searches over blocks: positives (rows of the anchor's label, the best k),
then, in windows set by their exact scores, negatives (rows of other labels,
the best k in the window).  A block returns at most k rows an anchor or window,
and only those meet in the final ranking, so no pairs are spread out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.pqdedup import k_means
from wearlake.llm.runtime import discard, materialise, value_text

#: Vectors of this norm or more might have scores that are no long.
_MOST_NORM = float(1 << 31)
_NO_ID = np.iinfo(np.int64).max


@dataclass
class Codebooks:
    """books: (subspaces, codes, width); vectors are padded with zeros to subspaces * width."""

    books: np.ndarray

    @property
    def dim(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and per subspace the norm of what the code leaves out, rounded up."""
        parts = x.reshape(len(x), len(self.books), -1)
        codes, norms = np.empty((len(x), len(self.books)), np.uint8), np.empty((len(x), len(self.books)), np.float32)
        for j, book in enumerate(self.books):
            r = parts[:, j]
            codes[:, j] = ((book * book).sum(1)[None, :] - 2 * r @ book.T).argmin(axis=1)
            norms[:, j] = np.nextafter(
                np.linalg.norm(r - book[codes[:, j]], axis=1).astype(np.float32) * np.float32(1 + 1e-6), np.float32(np.inf)
            )
        return codes, norms

    def interval(self, anchors: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of anchors with coded rows, from look-up tables."""
        parts = anchors.reshape(len(anchors), len(self.books), -1)
        score = np.zeros((len(anchors), len(codes)))
        for j, book in enumerate(self.books):
            score += np.take(parts[:, j] @ book.T, codes[:, j], axis=1)
        reach = np.linalg.norm(parts, axis=2) @ norms.T.astype(float)
        # room for rounding: products of doubles of at most these sizes
        size = np.linalg.norm(anchors, axis=1)[:, None] * (np.abs(self.books).max(initial=0) * np.sqrt(self.dim) + 1)
        reach += 1e-12 * (size + np.abs(score)) + 1e-6
        return score - reach, score + reach


def fit_codebooks(sample: np.ndarray, subspaces: int = 8, codes: int = 256, rounds: int = 8, seed: int = 13) -> Codebooks:
    """Fit on rows of one width, a multiple of ``subspaces``; fewer rows than codes make fewer codes."""
    rng = np.random.default_rng(seed)
    if not len(sample):
        return Codebooks(np.zeros((subspaces, 1, sample.shape[1] // subspaces)))
    parts = sample.reshape(len(sample), subspaces, -1)
    k = min(codes, len(sample))
    return Codebooks(np.stack([k_means(np.ascontiguousarray(parts[:, j]), k, rounds, rng) for j in range(subspaces)]))


def whole_rows(vectors: DataFrame, scale: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(row, id, label, width, x) of rows that take part: x has floor(scale * c) as little-endian longs, label is text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, widths, out = [], [], []
            for k, v in enumerate(batch.column(3).to_pylist()):
                if not v or None in v:
                    continue
                c = np.floor(scale * np.array(v, np.float64))
                if np.isfinite(c).all() and np.linalg.norm(c) < _MOST_NORM:
                    keep.append(k)
                    widths.append(len(c))
                    out.append(c.astype("<i8").tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in range(3)), pa.array(widths, pa.int32()), pa.array(out, pa.binary())],
                ["row", "id", "label", "width", "x"],
            )

    own = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), value_text(vectors, label_col).alias("label"),
        F.col(vec_col).alias("x"),
    ).filter("label is not null and x is not null")
    return own.mapInArrow(run, "row long, id long, label string, width int, x binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    for i, x in enumerate(column):
        own = np.frombuffer(x.as_buffer(), "<i8")
        out[i, : len(own)] = own
    return out


def _ids(column: pa.Array) -> np.ndarray:
    """Ids, a null one after all others."""
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                codes, norms = books.encode(_matrix(part.column("x"), books.dim).astype(float))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([n.tobytes() for n in norms], pa.binary())],
                    [*part.schema.names, "codes", "norms"],
                )

    return rows.mapInArrow(run, "row long, id long, label string, width int, x binary, codes binary, norms binary")


def _search(
    anchors: DataFrame, rows: DataFrame, by: list[str], books: Codebooks, block: int, asked: str, windows: str,
    find: Callable[..., Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]], most_parts: int = 100_000,
) -> DataFrame:
    """Anchors against the rows that agree with them in ``by``, in blocks of about ``block`` rows.

    ``find`` gets a slice of anchors (their table, vectors) and the rows' ids,
    labels, numbers, vectors and bounds, and yields (anchor, window, row, score)
    index arrays.  ``asked`` names the anchors' column of windows (an array of
    ``windows``), null if there is none.
    """
    count = lambda df, name: df.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    grid = count(anchors, "a_blocks").join(count(rows, "r_blocks"), by)
    number = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = anchors.join(grid, by).withColumn("a", number("a_blocks")).withColumn("r", every("r_blocks"))
    right = rows.join(grid, by).withColumn("r", number("r_blocks")).withColumn("a", every("a_blocks"))
    nothing = F.lit(None).cast("binary")
    left = left.select(*by, "a", "r", "row", "id", "x", F.col("label").alias("own"), nothing.alias("codes"), nothing.alias("norms"), F.expr(asked).cast(windows).alias("asked"), F.lit(True).alias("anchor"))
    right = right.select(*by, "a", "r", "row", "id", "x", F.col("label").alias("own"), "codes", "norms", F.lit(None).cast(windows).alias("asked"), F.lit(False).alias("anchor"))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["anchor_row", "anchor_id", "window", "row", "id", "score"]

    def run(table: pa.Table) -> pa.Table:
        is_anchor = table.column("anchor").combine_chunks()
        ours, theirs = table.filter(is_anchor), table.filter(pc.invert(is_anchor))
        out = [[] for _ in names]
        if len(ours) and len(theirs):
            get = lambda t, name: t.column(name).combine_chunks()
            x = _matrix(get(theirs, "x"), books.dim)
            codes = np.frombuffer(b"".join(get(theirs, "codes").to_pylist()), np.uint8).reshape(len(x), -1)
            norms = np.frombuffer(b"".join(get(theirs, "norms").to_pylist()), np.float32).reshape(len(x), -1)
            row, ids = get(theirs, "row").to_numpy(), _ids(get(theirs, "id"))
            both = pa.concat_arrays([get(ours, "own"), get(theirs, "own")]).dictionary_encode().indices.to_numpy()
            label = both[len(ours) :]
            for k in range(0, len(ours), 128):
                mine = ours.slice(k, 128)
                a = _matrix(get(mine, "x"), books.dim)
                low, high = books.interval(a.astype(float), codes, norms)
                same = both[k : k + len(mine)][:, None] == label[None, :]
                self_row = get(mine, "row").to_numpy()
                for i, w, j, score in find(get(mine, "asked"), a, self_row, x, row, ids, same, low, high):
                    for o, v in zip(out, (self_row[i], _ids(get(mine, "id"))[i], w, row[j], ids[j], score)):
                        o.append(v)
        return pa.table(
            [pa.array(np.concatenate(o) if o else np.zeros(0, np.int64)).cast(kind) for o, kind in zip(out, kinds)], names=names
        )

    # a cell is a second of work in few bytes: as many parts as cells, which Spark would put together by their size
    cells = grid.agg(F.sum(F.col("a_blocks").cast("long") * F.col("r_blocks"))).first()[0] or 1
    both = left.unionByName(right).repartition(int(min(cells, most_parts)), *by, "a", "r")
    return both.groupBy(*by, "a", "r").applyInArrow(
        run, "anchor_row long, anchor_id long, window int, row long, id long, score long"
    )


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _exact(a: np.ndarray, i: np.ndarray, x: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whole scores of the pairs (i, j); where they are many, by one product of doubles, which is exact below 2^53."""
    if len(i) * 8 > len(a) * len(x):
        one, other = a.astype(float), x.astype(float)
        if np.linalg.norm(one, axis=1).max() * np.linalg.norm(other, axis=1).max() < 1 << 52:
            return (one @ other.T)[i, j].astype(np.int64)
    parts = [np.einsum("ij,ij->i", a[i[k : k + 65536]], x[j[k : k + 65536]]) for k in range(0, len(i), 65536)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _first(i: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first of each i: higher scores first, then smaller ids, then the row's number."""
    order = np.lexsort((row, ids, -score, i))
    start = np.searchsorted(i[order], i[order])
    return order[np.arange(len(order)) - start < k]


def _best_positives(k: int) -> Callable:
    def find(asked, a, self_row, x, row, ids, same, low, high):
        may = same & (self_row[:, None] != row[None, :])
        least = _kth(np.where(may, low, -np.inf), k)
        i, j = np.nonzero(may & (high >= least[:, None]))
        score = _exact(a, i, x, j)
        top = _first(i, score, ids[j], row[j], k)
        yield i[top], np.zeros(len(top), np.int32), j[top], score[top]

    return find


def _best_negatives(k: int, floor: int, ceiling: int) -> Callable:
    def find(asked, a, self_row, x, row, ids, same, low, high):
        held = asked.offsets.to_numpy() - asked.offsets[0].as_py()
        positive, count = asked.flatten().to_numpy(), np.diff(held)
        windows, may = [], np.zeros(same.shape, bool)
        for w in range(int(count.max(initial=0))):
            at = np.flatnonzero(count > w)
            p = positive[held[at] + w]
            # 100 * score is between floor * p and ceiling * p; whole scores, so the ends are rounded inwards
            first, last = -((-floor * p) // 100), ceiling * p // 100
            windows.append((at, first, last))
            lo, hi = low[at], high[at]
            least = first.astype(float)
            sure = ~same[at] & (lo >= first[:, None]) & (hi <= last[:, None])
            if sure.any():
                least = np.maximum(least, _kth(np.where(sure, lo, -np.inf), k))
            may[at] |= (hi >= least[:, None]) & (lo <= last[:, None])
        i, j = np.nonzero(may & ~same)
        score = np.full(same.shape, np.iinfo(np.int64).min)  # of those that may count, all that a window can take
        score[i, j] = _exact(a, i, x, j)
        for w, (at, first, last) in enumerate(windows):
            own = score[at]
            own[own > last[:, None]] = np.iinfo(np.int64).min
            least = np.partition(own, -k, axis=1)[:, -k] if own.shape[1] >= k else first
            i, j = np.nonzero(own >= np.maximum(first, least)[:, None])
            value = own[i, j]
            top = _first(i, value, ids[j], row[j], k)
            yield at[i[top]], np.full(len(top), w, np.int32), j[top], value[top]

    return find


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k first rows of each anchor's window, from at most k a block."""
    w = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 3, floor: int = 50, ceiling: int = 95, scale: float = 256,
    every: int = 50, subspaces: int = 8, sample_rows: int = 16_384, block: int = 2048, id_col: str = "vec_id",
    vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``every``.  Scores are whole inner
    products of floor(``scale`` * x); higher first, ties by smaller id, a null
    id last, then by the order of reading.  A positive is one of the anchor's
    first ``positives`` other rows of equal label; its negatives are the first
    ``negatives`` rows of other labels with floor * positive_score <= 100 *
    negative_score <= ceiling * positive_score.  Labels are equal by value.

    Rows with a null label, a null or empty vector, or a null or non-finite
    component take no part; nor does a vector whose whole form has a norm of
    2^31 or more, whose scores might be no longs.  Vectors of unequal widths
    have no score.  Repeated rows are rows of their own.  Other columns are left
    out; an empty table gives an empty result.  The codebooks are fitted on at
    most ``sample_rows`` vectors; every row is coded and every bound is rigorous,
    so the sample changes the speed, not the result.
    """
    whole = materialise(whole_rows(vectors, scale, id_col, vec_col, label_col), "whole-rows")
    wide = whole.agg(F.max("width")).first()[0] or 1
    dim = -(-wide // subspaces) * subspaces
    sample = whole.select("x").orderBy(F.xxhash64("row")).limit(sample_rows).toArrow().column("x").combine_chunks()  # at most ``sample_rows``
    books = fit_codebooks(_matrix(sample, dim).astype(float), subspaces)
    rows = materialise(_coded(whole, books), "coded-rows")
    anchors = rows.filter(F.col("id") % every == 0)
    best = _ranked(
        _search(anchors, rows, ["width", "label"], books, block, "null", "array<bigint>", _best_positives(positives)), positives
    )
    # at most ``positives`` a group
    kept = materialise(
        best.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score", "row"))).alias("p")), "positives"
    )
    asking = materialise(
        anchors.join(kept, F.col("row") == F.col("anchor_row")).withColumn("scores", F.transform("p", lambda s: s["score"])), "asking"
    )
    found = _ranked(
        _search(asking, rows, ["width"], books, block, "scores", "array<bigint>", _best_negatives(negatives, floor, ceiling)), negatives
    )
    named = kept.select(F.col("anchor_row").alias("p_row"), "p")
    out = found.join(named, F.col("anchor_row") == F.col("p_row")).withColumn("positive", F.element_at("p", F.col("window") + 1))
    real = lambda c: F.nullif(c, F.lit(_NO_ID))
    discard(whole)
    return out.select(
        real(F.col("anchor_id")).alias("anchor_id"), real(F.col("positive.id")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        real(F.col("id")).alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
