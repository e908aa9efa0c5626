"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest distinct hashes (48 bits each) of a text's
shingles, ascending; with fewer it holds them all and estimates are exact.
Sketches of parts merge into the sketch of the whole.  As a string a sketch is
base64 of its hashes, 6 big-endian bytes each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.llm import textvec as tv

K = 128
SHINGLE = 5
_SPAN = float(1 << 48)


def sketches(data: np.ndarray, offsets: np.ndarray, k: int = K, n: int = SHINGLE) -> list[np.ndarray]:
    """The sketch of each text: lower-cased words, n-word shingles.  A long text is worked through in slices."""
    if len(offsets) == 2 and len(data) > tv.SLICE:
        return [_long_sketch(data, k, n)]
    data = tv.fold_ascii(data)
    starts, ends, first = tv.word_bounds(data, offsets)
    hashes, begin = tv.shingle_hashes(tv.span_hashes(data, starts, ends), first, n)
    hashes >>= np.uint64(16)
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        own = hashes[a:b]
        if len(own) > 8 * k:  # the smallest few are enough unless they repeat
            few = np.unique(np.partition(own, 4 * k)[: 4 * k])
            own = few if len(few) >= k else own
        out.append(np.unique(own)[:k])
    return out


def _long_sketch(data: np.ndarray, k: int, n: int) -> np.ndarray:
    """The sketch of one text from slices, each with the last n - 1 words before it."""
    own, held = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    cuts = tv.blank_cuts(data)
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = tv.fold_ascii(data[a:b])
        starts, ends, _ = tv.word_bounds(part, np.array([0, b - a]))
        words = np.concatenate((held, tv.span_hashes(part, starts, ends)))
        if len(words) >= n:
            hashes = tv.shingle_hashes(words, np.array([0, len(words)]), n)[0] >> np.uint64(16)
            few = hashes if len(hashes) <= 8 * k else np.partition(hashes, 4 * k)[: 4 * k]
            few = np.unique(few)
            own = np.union1d(own, few if len(few) >= k else np.unique(hashes))[:k]
        held = words[len(words) - min(len(words), n - 1) :]
    if not len(own) and len(held):  # fewer words than a shingle: none was longer, so all are held
        own = tv.shingle_hashes(held, np.array([0, len(held)]), n)[0] >> np.uint64(16)
    return own


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Distinct shingles: exact below k, else (k - 1) / (k-th smallest hash as a fraction)."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / _SPAN)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Jaccard similarity: the share of the union's sketch that both hold.  Two empty sketches are alike (1)."""
    both = np.concatenate((a, b))
    both.sort()
    twice = both[1:][both[1:] == both[:-1]]
    size = len(both) - len(twice)
    if not size:
        return 1.0
    if size <= k:
        return len(twice) / size
    distinct = np.unique(both)[:k]
    return float(np.count_nonzero(twice <= distinct[-1])) / k


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    union = distinct_count(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_count(a, k))


def to_string(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_string(s: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, 6)
    return np.concatenate((np.zeros((len(raw), 2), np.uint8), raw), axis=1).copy().view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``id_col`` and fingerprint of every row, without a shuffle.  A null or empty text has the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                to_string(x) for _, _, data, offsets in tv.blocks(batch.column(1)) for x in sketches(data, offsets, k)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fingerprint string"
    )


def compared(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with resemblance, containment (of a in b), distinct_a and distinct_b, estimated from two columns of
    fingerprints; null where a fingerprint is null."""
    names, added = pairs.columns, ["resemblance", "containment", "distinct_a", "distinct_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column(names.index(a)).to_pylist(), batch.column(names.index(b)).to_pylist()):
                u, v = (None if t is None else from_string(t) for t in (x, y))
                known = u is not None and v is not None
                found.append(
                    (resemblance(u, v), containment(u, v), distinct_count(u), distinct_count(v))
                    if known
                    else (None,) * 4
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([f[k] for f in found], pa.float64()) for k in range(4))], [*names, *added]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.mapInArrow(run, f"{kinds}, " + ", ".join(f"{c} double" for c in added))


def merged_fingerprints(rows: DataFrame, key: str, column: str = "fingerprint") -> DataFrame:
    """(key, fingerprint) of the union of each key's texts.  Fingerprints are merged in their partitions first, so that a
    key shuffles one row per batch, whatever its size; null fingerprints don't count."""
    kind = rows.schema[key].dataType.simpleString()

    def join(keys: list, prints: list) -> tuple[list, list]:
        out: dict = {}
        for k, x in zip(keys, prints):
            own = from_string(x)
            out[k] = merge(out[k], own) if k in out else own
        return list(out), [to_string(x) for x in out.values()]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prints = join(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(0).type), pa.array(prints, pa.string())], [key, "fingerprint"]
            )

    def whole(table: pa.Table) -> pa.Table:
        keys, prints = join(table.column(0).to_pylist(), table.column(1).to_pylist())
        return pa.table(
            [pa.array(keys, table.schema.field(0).type), pa.array(prints, pa.string())], names=[key, "fingerprint"]
        )

    schema = f"`{key}` {kind}, fingerprint string"
    return rows.filter(
        F.col(column).isNotNull()
    ).select(key, column).mapInArrow(part, schema).groupBy(key).applyInArrow(whole, schema)


def _bounds(ids: DataFrame, rows_per_part: int, most_parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, id, hash) at which parts begin, ascending, for about ``rows_per_part`` rows a part.

    Ids are cut at percentiles; an id that takes several percentiles is cut by even shares of the hashes, and so are
    the null ids, which come first (known is 0).
    """
    rows, nulls = ids.agg(F.count("*"), F.count_if(F.col("id").isNull())).first()
    each = max(rows_per_part, -(-rows // most_parts))
    known, where, hashes = [], [], []

    def add(is_known: int, value: int, pieces: int) -> None:
        for j in range(pieces):
            known.append(is_known)
            where.append(value)
            hashes.append(-(1 << 63) + (1 << 64) * j // pieces)

    if nulls:
        add(0, 0, -(-nulls // each))
    parts = -(-(rows - nulls) // each)
    if parts > 1:
        shares = [k / parts for k in range(1, parts)]
        found = ids.agg(F.percentile_approx("id", shares, max(10_000, 10 * parts))).first()[0]  # at most ``most_parts`` ids
        for value, count in zip(*np.unique(found, return_counts=True)):
            add(1, int(value), int(count))
    return np.array(known, np.int64), np.array(where, np.int64), np.array(hashes, np.int64)


def _part_of(bounds: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, null: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How many bounds are at or before each row."""
    known, where, cut = bounds
    nulls = int((known == 0).sum())
    own = where[nulls:]
    low, high = np.searchsorted(own, ids, side="left") + nulls, np.searchsorted(own, ids, side="right") + nulls
    low[null], high[null] = 0, nulls
    out = low.copy()
    for at in np.unique(low[low < high]).tolist():  # the rows of an id at which parts begin
        rows = (low == at) & (low < high)
        end = int(high[rows][0])
        out[rows] = at + np.searchsorted(cut[at:end], hashes[rows], side="right")
    return out


def in_order(
    docs: DataFrame, rows_per_part: int = 1000, most_parts: int = 65_536, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(part, sentinel, id, text) sorted inside partitions so that a row's successor by (id, hash of the text, text) is the next row of its part.

    Parts are ranges of (id, hash), so that rows of one id, or with none, are
    many parts as well; only repeated rows, alike in id and text, are in one.
    The first row of a part is sent to the part before too, as its sentinel
    (with its repetitions), and the first of all to the last.  Texts are shuffled
    once.  Null ids come first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds = _bounds(rows.select("id"), rows_per_part, most_parts)
    hashed = rows.withColumn("hash", F.xxhash64("text"))

    def numbers(ids: pd.Series, hashes: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        null, value = ids.isna().to_numpy(), ids.fillna(0).to_numpy(np.int64)
        h = hashes.to_numpy(np.int64)
        return null, value, h, _part_of(bounds, value, null, h)

    @F.pandas_udf("long")
    def part(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(numbers(ids, hashes)[3])

    heads: list = []
    if len(bounds[0]):
        first = hashed.select("id", "hash").withColumn("part", part("id", "hash")).groupBy("part").agg(
            F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "hash")).alias("f")
        )
        heads = sorted((r.part, r.f.id, r.f.hash) for r in first.collect())  # at most ``most_parts`` rows, and those of heavy ids
    # the part before each one that has rows; with a single one it follows itself
    before = {(p[1], p[2]): heads[k - 1][0] for k, p in enumerate(heads)}

    if heads:

        @F.pandas_udf("array<long>")
        def places(ids: pd.Series, hashes: pd.Series) -> pd.Series:
            null, value, h, own = numbers(ids, hashes)
            out = [[2 * p] for p in own.tolist()]
            keys = {x[2] for x in heads}
            for i in np.flatnonzero(np.isin(h, np.fromiter(keys, np.int64, len(keys)))).tolist():
                key = (None if null[i] else int(value[i]), int(h[i]))
                if key in before:
                    out[i].append(2 * before[key] + 1)
            return pd.Series(out, index=ids.index)

        placed = hashed.withColumn("place", F.explode(places("id", "hash")))
    else:  # one part: its first rows follow the last
        least = hashed.agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "hash")).alias("f")).first().f
        is_first = (F.col("id").eqNullSafe(F.lit(least.id if least else None)) & (F.col("hash") == F.lit(least.hash if least else 0)))
        zero, one = F.array(F.lit(0).cast("long")), F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))
        placed = hashed.withColumn("place", F.explode(F.when(is_first, one).otherwise(zero)))
    out = placed.select(F.shiftright("place", 1).alias("part"), (F.col("place") % 2).alias("sentinel"), "id", "hash", "text")
    return out.repartition("part").sortWithinPartitions("part", "sentinel", "id", "hash", "text").drop("hash")


def edited_fingerprints(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text keeps all but the last floor(n_chars / 2) code points and
    goes on with the first as many (or all) of the next document by ascending
    id; after the last comes the first, and a lone document follows itself.
    Equal ids are ordered by the hash of their text, null ids come first, a null text is empty.
    Other columns are left out; an empty table gives an empty result.  Ids are
    long integers.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the last row so far: part, sentinel, id, text, sketch
        for batch in batches:
            part, sentinel, ids = (batch.column(c).to_pylist() for c in range(3))
            for row, end, data, offsets in tv.blocks(batch.column(3)):
                texts = batch.column(3).slice(row, end - row).to_pylist()
                rows = held + list(
                    zip(part[row:end], sentinel[row:end], ids[row:end], texts, sketches(data, offsets, k))
                )
                held = rows[-1:]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
                changed = [a[3][: len(a[3]) - len(a[3]) // 2] + b[3][: len(a[3]) // 2] for a, b in pairs]
                edited = [
                    x for _, _, d, o in tv.blocks(pa.array(changed, pa.large_string())) for x in sketches(d, o, k)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array(
                            [len(a[3]) for a, _ in pairs], pa.int64()
                        ),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
                        pa.array(
                            [to_string(a[4]) for a, _ in pairs], pa.string()
                        ), pa.array([to_string(x) for x in edited], pa.string()),
                        pa.array([resemblance(a[4], x, k) for (a, _), x in zip(pairs, edited)], pa.float64()),
                        pa.array([resemblance(a[4], b[4], k) for a, b in pairs], pa.float64()),
                    ],
                    [
                        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                        "near_next",
                    ],
                )
        tv.trim()

    kinds = f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs, id_col=id_col, text_col=text_col).mapInArrow(run, kinds)
