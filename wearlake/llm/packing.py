"""Best-fit packing by patterns: non-negative least squares over few-piece patterns, residuals by best fit.

Documents become token pieces of at most ``capacity`` tokens.  Only the
histogram of piece lengths (at most ``capacity`` numbers) reaches the driver.
There, patterns of one to four lengths that fill a sequence (almost) exactly
are enumerated, their repeat counts are fitted to the histogram by
non-negative least squares and rounded down, and what is left is packed
best-fit decreasing on runs of equal pieces.  The plan is a list of runs
"pieces i to j of length L go to sequences s, s+1, ... at offset o"; its size
depends on the capacity alone.  Each piece finds its place from its length and
its number among the pieces of that length, a distributed prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm import textvec as tv
from wearlake.llm.runtime import materialise


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of every whole document: id, piece, start, length, ids_crc32, and (part, number): the piece's number among
    those of its length in its partition.  A document is its ids and ``end_id``; the first piece takes the remainder."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        from pyspark import TaskContext

        from wearlake.llm.bytebpe import library_ids

        encoder, part = library_ids(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for row, _, data, offsets in tv.blocks(batch.column(1)):
                ids, begin = encoder.encode(data, offsets)
                total = np.diff(begin) + 1
                pieces = -(-total // capacity)
                doc = np.repeat(np.arange(len(total)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = (total - 1) % capacity + 1
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                # ids with the end id after each document, as one little-endian array
                flat = np.insert(ids.astype("<u4"), begin[1:], end_id)
                at = begin[:-1][doc] + doc + start
                raw = memoryview(flat.view(np.uint8))
                crc = [crc32(raw[a : a + n]) for a, n in zip((at * 4).tolist(), (length * 4).tolist())]
                order = np.argsort(length, kind="stable")
                sorted_length = length[order]
                number = np.empty(len(length), np.int64)
                number[order] = np.arange(len(length)) - np.searchsorted(
                    sorted_length, sorted_length
                ) + seen[sorted_length]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(doc), part, np.int32)), pa.array(number)],
                    [id_col, "piece", "start", "length", "ids_crc32", "part", "number"],
                )
        tv.trim()

    return docs.select(id_col, text_col).mapInArrow(
        cut, f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long, part int, number long"
    )


def patterns(histogram: np.ndarray, per_length: int = 10) -> list[tuple[int, ...]]:
    """Length tuples (descending) with a sum of capacity, or just under it, made of lengths that occur."""
    capacity = len(histogram) - 1
    there = np.flatnonzero(histogram[1:]) + 1
    found: set[tuple[int, ...]] = set()
    if not len(there):
        return []

    def nearest(x: int) -> int:
        """The largest length that occurs and is at most x; 0 if none."""
        k = int(np.searchsorted(there, x, side="right")) - 1
        return int(there[k]) if k >= 0 else 0

    for a in there.tolist():
        found.add((a,))
        rest = capacity - a
        b = nearest(rest)
        if b:
            found.add(tuple(sorted((a, b), reverse=True)))
        upto = int(np.searchsorted(there, rest, side="right"))
        for share in range(1, per_length + 1):  # partners spread over all that leave room for a third
            k = upto * share // (per_length + 1)
            if k < upto:
                b = int(there[k])
                c = nearest(rest - b)
                if c:
                    found.add(tuple(sorted((a, b, c), reverse=True)))
                    third = nearest((rest - b) // 2)
                    if third:
                        d = nearest(rest - b - third)
                        if d:
                            found.add(tuple(sorted((a, b, third, d), reverse=True)))
    return sorted(found)


def non_negative_fit(made: list[tuple[int, ...]], histogram: np.ndarray, steps: int = 600) -> np.ndarray:
    """x >= 0 that minimises |A x - h|^2 and, weakly, the number of sequences; accelerated projected gradient."""
    rows = np.array([length for p in made for length in p])
    cols = np.array([k for k, p in enumerate(made) for _ in p])
    h = histogram.astype(float)
    scale = np.maximum(np.sqrt(h), 1.0)  # rows weighed by 1 / sqrt(count)
    capacity = len(h) - 1
    waste = np.array([capacity - sum(p) for p in made]) / capacity
    value = 1 / scale[rows]
    forward = lambda x: np.bincount(rows, x[cols] * value, minlength=len(h))
    backward = lambda r: np.bincount(cols, r[rows] * value, minlength=len(made))
    v = np.ones(len(made))
    for _ in range(30):  # the largest singular value
        v = backward(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (norm * 1.05)
    x = y = np.zeros(len(made))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * (backward(forward(y) - h / scale) + waste), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def pack_plan(histogram: np.ndarray, per_length: int = 10) -> tuple[np.ndarray, int]:
    """Runs (length, first number, end number, first sequence, offset) that place every piece, and the number of sequences."""
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(capacity + 1, np.int64)
    plan, sequences = [], 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        plan.append((length, taken[length], taken[length] + n, first, offset))
        taken[length] += n
        left[length] -= n

    open_runs: dict[int, list[list[int]]] = {}  # by room: runs of sequences (first, number)
    n = int(left[capacity])
    if n:
        place(capacity, n, 0, 0)
        sequences = n
    made = patterns(left, per_length)
    if made:
        x = non_negative_fit(made, left)
        # the fullest patterns first, so rounding leaves small pieces over
        for k in sorted(range(len(made)), key=lambda k: (capacity - sum(made[k]), -x[k])):
            need = np.bincount(made[k], minlength=capacity + 1)
            repeat = min(int(x[k] + 1e-6), int(min(left[length] // need[length] for length in set(made[k]))))
            if repeat > 0:
                at = 0
                for length in made[k]:
                    place(length, repeat, sequences, at)
                    at += length
                if at < capacity:
                    open_runs.setdefault(capacity - at, []).append([sequences, repeat])
                sequences += repeat
    for length in range(capacity, 0, -1):  # best fit, decreasing
        while left[length]:
            room = min((r for r in open_runs if r >= length), default=0)
            if not room:
                fit = capacity // length
                bins = -(-int(left[length]) // fit)
                open_runs.setdefault(capacity, []).append([sequences, bins])
                sequences += bins
                continue
            run = open_runs[room][-1]
            n = min(run[1], int(left[length]))
            place(length, n, run[0], capacity - room)
            if room > length:
                open_runs.setdefault(room - length, []).append([run[0], n])
            run[0], run[1] = run[0] + n, run[1] - n
            if not run[1]:
                open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room]
    return np.array(plan, np.int64).reshape(-1, 5), sequences


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
    text_col: str = "text", per_length: int = 10,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns per piece: ``id_col``, piece, start, length, ids_crc32, sequence_id,
    offset.  Sequences are gapless from offset 0.  A null or empty text is the
    end id alone; repeated rows are packed row by row; an empty table gives an
    empty result.  Other columns are left out.
    """
    pieces = materialise(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    counts = pieces.groupBy("length", "part").agg((F.max("number") + 1).alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    bases = counts.withColumn("base", before).drop("n")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[r["length"]] = r["n"]
    plan, _ = pack_plan(histogram, per_length)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    starts = plan[:, 0] << 48 | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            run = plan[
                np.searchsorted(starts, length << 48 | number, side="right") - 1
            ] if len(plan) else np.zeros((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5], pa.array(run[:, 3] + number - run[:, 1]), pa.array(run[:, 4])
                ], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    own = pieces.join(bases, ["length", "part"]).select(
        id_col, "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("base")).alias("number")
    )
    kinds = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return own.mapInArrow(place, kinds)
