"""N-gram Jaccard join with adaptive multi-match prefixes.

Texts become sets of word shingles.  Rows with the same word sequence are one
node from the start (its 64-bit signature), so copies cost nothing later.

1. Shingle postings go to hash buckets as packed arrays, and with them each
   row's id, node and set size, so that texts are cut into shingles once.  A
   bucket counts how many nodes have each shingle; shingles of a single node
   can't be shared and stop there.  A shingle that is frequent within one map
   task's batch is spread over salted buckets and ranked last, everywhere.
2. A node's shingles are ordered rarest first.  By the prefix principle two
   sets with |x & y| >= a share at least l of the first |x| - a + l of each.
   Every node picks the l that makes its prefix's scan cost plus estimated
   verification cost least: a longer prefix, but l shared shingles before a
   pair is verified.  For a pair the smaller of both l holds.
3. Star rounds: in every posting list the smallest node leads; each node is
   verified against its most frequent leaders.  Links found merge components,
   which settles large groups of near copies with a number of pairs in
   proportion to the postings.  Then all pairs of different components that
   share enough prefix shingles and whose bitmaps of shingle parities are close
   enough are verified, so no link between components is lost; links inside a
   component can't change it.  ``jaccard_join`` leaves the star rounds out and
   gives all links.

A long posting list is dealt to a grid of node blocks and a leader's many lists
to parts, so that no list is one task.

Sets are compared by whole 64-bit shingle hashes; equal hashes count as equal
shingles, equal signatures (63 bits) as equal word sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlake.llm import textvec as tv
from wearlake.llm.runtime import connected_components, discard, materialise, own_prefix, release

#: Kinds of rows of the postings.
_PLAIN, _OFTEN, _TOLD, _ROWS = 0, 1, 2, 3
#: A bucket is the top bits of a shingle, at least 8 of them; postings hold the other 56.
_LEAST_BUCKETS = 256
#: Rank of a shingle that some map task found frequent.
HOT = (1 << 31) - 1
_SALTS = 16


def _signatures(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 63-bit signature of each text's word sequence, from the hashes of all words."""
    size = np.diff(first)
    place = (np.arange(len(words)) - np.repeat(first[:-1], size)).astype(np.uint64)
    sums = np.concatenate(
        (np.zeros(1, np.uint64), np.cumsum(tv.mix64(words ^ (place * np.uint64(0x9E3779B97F4A7C15)))))
    )
    value = tv.mix64((sums[first[1:]] - sums[first[:-1]]) ^ (size.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))
    return (value >> np.uint64(1)).astype(np.int64)


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, distinct shingles in a row, and the index of each text's first."""
    words, first = tv.word_hashes(data, offsets)
    signature = _signatures(words, first)
    shingles, begin = tv.distinct_by_text(*tv.shingle_hashes(words, first, n))
    return signature, shingles, begin


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in arrays], pa.binary())


def _postings(
    docs: DataFrame, n: int, buckets: int, hot: int, id_col: str, text_col: str, flush_at: int = 1_500_000
) -> DataFrame:
    """(bucket, kind, nodes, sizes, counts, low, mid, high) rows: runs of a node's shingles in a bucket.

    low, mid and high are a shingle's last 56 bits.  Rows of kind _OFTEN are a
    salted bucket of frequent shingles, _TOLD tells a bucket which of its
    shingles are frequent elsewhere, and _ROWS has nodes, set sizes, which ids
    are null (counts) and ids (low) of a block of documents.
    """
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    names = ["bucket", "kind", "nodes", "sizes", "counts", "low", "mid", "high"]

    def pack(
        shingles: np.ndarray, owner: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, key: np.ndarray, kind: int
    ) -> pa.RecordBatch:
        order = np.argsort(key, kind="stable")
        shingles, owner, key = shingles[order], owner[order], key[order]
        cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        stop = np.append(cut[1:], len(key))
        columns: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for a, b in zip(cut.tolist(), stop.tolist()):
            own, value = owner[a:b], shingles[a:b]
            run = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            parts = (nodes[own[run]], sizes[own[run]].astype(np.int32), np.diff(np.append(run, b - a)).astype(np.int32))
            parts += (
                value.astype(np.uint32), (value >> np.uint64(32)).astype(np.uint16),
                (value >> np.uint64(48)).astype(np.uint8),
            )
            for column, x in zip(columns, parts):
                column.append(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(key[cut].astype(np.int64)), pa.array(np.full(len(cut), kind, np.int32)), *map(_binary, columns)],
            names,
        )

    def flush(held: list, salt: int) -> Iterator[pa.RecordBatch]:
        nodes, sizes = np.concatenate([x[0] for x in held]), np.concatenate([x[2] for x in held])
        shingles = np.concatenate([x[1] for x in held])
        owner = np.repeat(np.arange(len(nodes)), sizes)
        key = (shingles >> shift).astype(np.int64)
        ordered = np.sort(shingles)
        often = ordered[hot - 1 :][
            ordered[hot - 1 :] == ordered[: len(ordered) - hot + 1]
        ] if len(ordered) >= hot else ordered[:0]
        often = np.unique(often)
        if len(often):
            slot = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
            frequent = often[slot] == shingles
            yield pack(
                shingles[frequent], owner[frequent], nodes, sizes, key[frequent] * _SALTS + salt % _SALTS, _OFTEN
            )
            none = np.zeros(len(often), np.int64)
            yield pack(often, none, np.zeros(1, np.int64), none[:1], (often >> shift).astype(np.int64), _TOLD)
            shingles, owner, key = shingles[~frequent], owner[~frequent], key[~frequent]
        if len(shingles):
            yield pack(shingles, owner, nodes, sizes, key, _PLAIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, waiting, seen, salt = [], 0, set(), TaskContext.get().partitionId()
        for batch in batches:
            ids, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(
                zero_copy_only=False
            )
            for row, end, data, offsets in tv.blocks(batch.column(1)):
                node, shingles, begin = _sets(data, offsets, n)
                size = np.diff(begin)
                whole = [
                    [x] for x in (
                        node, size.astype(np.int32), null[row:end].astype(np.uint8), ids[row:end], node[:0], node[:0]
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([salt % buckets]), pa.array([_ROWS], pa.int32()), *map(_binary, whole)], names
                )
                new = np.zeros(len(node), bool)
                for k, x in enumerate(node.tolist()):
                    if size[k] and x not in seen:
                        seen.add(x)
                        new[k] = True
                held.append((node[new], shingles[np.repeat(new, size)], size[new]))
                waiting += len(held[-1][1])
                if waiting >= flush_at:
                    yield from flush(held, salt)
                    held, waiting = [], 0
                salt += 1
        if waiting:
            yield from flush(held, salt)
        tv.trim()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, "bucket long, kind int, nodes binary, sizes binary, counts binary, low binary, mid binary, high binary"
    )


def _shared(postings: DataFrame, buckets: int) -> DataFrame:
    """(place, nodes, sizes, counts, shingles, ranks): the shingles that several nodes have, packed for the buckets of nodes;
    rows of documents go on with a negative place, their ids as shingles."""
    bits = buckets.bit_length() - 1

    def run(table: pa.Table) -> pa.Table:
        key, kind = table.column("bucket")[0].as_py(), table.column("kind").to_numpy()
        if kind[0] == _ROWS:
            empty = pa.array([b""] * len(table), pa.binary())
            return pa.table(
                [
                    pa.array(np.full(len(table), -1 - key)),
                    *(table.column(c).combine_chunks() for c in ("nodes", "sizes", "counts", "low")), empty,
                ],
                names=["place", "nodes", "sizes", "counts", "shingles", "ranks"],
            )
        salted = bool(kind[0] == _OFTEN)
        top = np.uint64((key // _SALTS if salted else key) >> (bits - 8)) << np.uint64(56)
        read = lambda name, dtype, rows: [
            np.frombuffer(x.as_py(), dtype) for x, r in zip(table.column(name), rows) if r
        ]
        join = lambda parts, dtype: np.concatenate(parts) if parts else np.zeros(0, dtype)

        def shingles(rows: np.ndarray) -> np.ndarray:
            value = join(read("low", np.uint32, rows), np.uint32).astype(np.uint64) | top
            value |= join(read("mid", np.uint16, rows), np.uint16).astype(np.uint64) << np.uint64(32)
            return value | join(read("high", np.uint8, rows), np.uint8).astype(np.uint64) << np.uint64(48)

        own = kind != _TOLD
        value, told = shingles(own), np.unique(shingles(~own))
        node, size, count = (
            join(read(name, t, own), t) for name, t in (("nodes", np.int64), ("sizes", np.int32), ("counts", np.int32))
        )
        node, size = np.repeat(node, count), np.repeat(size, count)
        order = np.lexsort((node, value))
        value, node, size = value[order], node[order], size[order]
        keep = np.ones(len(value), bool)
        keep[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])  # another task had the same text
        value, node, size = value[keep], node[keep], size[keep]
        _, df = np.unique(value, return_counts=True)
        rank = np.repeat(df, df)
        if salted:
            rank[:] = HOT
        elif len(told):
            slot = np.minimum(np.searchsorted(told, value), len(told) - 1)
            rank[told[slot] == value] = HOT
        keep = rank > 1
        value, node, size, rank = value[keep], node[keep], size[keep], rank[keep]
        place = (tv.mix64(node.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((node, place))
        value, node, size, rank, place = value[order], node[order], size[order], rank[order], place[order]
        cut = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(place) else np.zeros(0, np.int64)
        stop = np.append(cut[1:], len(place))
        columns: list[list[np.ndarray]] = [[], [], [], [], []]
        for a, b in zip(cut.tolist(), stop.tolist()):
            run_at = np.flatnonzero(np.concatenate(([True], node[a + 1 : b] != node[a : b - 1])))
            for column, x in zip(
                columns,
                (
                    node[a:b][run_at], size[a:b][run_at], np.diff(np.append(run_at, b - a)).astype(np.int32),
                    value[a:b], rank[a:b].astype(np.int32),
                ),
            ):
                column.append(x)
        return pa.table(
            [pa.array(place[cut]), *map(_binary, columns)],
            names=["place", "nodes", "sizes", "counts", "shingles", "ranks"],
        )

    group = F.expr(f"case when kind in ({_OFTEN}, {_ROWS}) then kind else {_PLAIN} end")
    return postings.groupBy("bucket", group.alias("group")).applyInArrow(
        run, "place long, nodes binary, sizes binary, counts binary, shingles binary, ranks binary"
    )


def prefix_choice(size: int, alone: int, rank: np.ndarray, percent: int, most: int = 4) -> tuple[int, int]:
    """(l, prefix shingles among the shared ones) of least estimated cost.

    ``alone`` shingles of the set are nobody else's and come first; ``rank``
    ascending holds the document frequencies of the others.  With s_l the sum
    of (frequency - 1) over the l-prefix, scanning costs s_l, and at most
    s_l / l candidates remain, each costing its verification, size / 16.
    """
    need = -(-percent * size // 100)
    best = (0.0, 1, 0)
    for l in range(1, min(most, need) + 1):
        length = min(max(size - need + l - alone, 0), len(rank))
        scan = float((rank[:length] - 1).sum())
        cost = scan + scan / l * (size / 16)
        if l == 1 or cost < best[0]:
            best = (cost, l, length)
    return best[1], best[2]


def _prefixes(shared: DataFrame, percent: int) -> DataFrame:
    """(id, node, size, l, prefix, shingles): every node with a prefix that others may share (shingles: all shared ones,
    ascending), and, with l = 0, every document (node null for a text without words)."""
    names = ["id", "node", "size", "l", "prefix", "shingles"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary()]

    def run(table: pa.Table) -> pa.Table:
        read = lambda name, dtype: np.concatenate([np.frombuffer(x.as_py(), dtype) for x in table.column(name)])
        node, size = read("nodes", np.int64), read("sizes", np.int32)
        if table.column("place")[0].as_py() < 0:
            none = pa.nulls(len(node), kinds[4])
            columns = [
                pa.array(read("shingles", np.int64), mask=read("counts", np.uint8) > 0), pa.array(node, mask=size == 0),
                pa.array(size), pa.array(np.zeros(len(node), np.int32)), none, pa.nulls(len(node), kinds[5]),
            ]
            return pa.table(columns, names=names)
        count, value, rank = read("counts", np.int32), read("shingles", np.uint64), read("ranks", np.int32)
        node, size = np.repeat(node, count), np.repeat(size, count)
        order = np.lexsort((value, rank, node))
        node, size, value, rank = node[order], size[order], value[order], rank[order]
        keep = np.ones(len(node), bool)  # salted buckets may each have had the same text
        keep[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])
        node, size, value, rank = node[keep], size[keep], value[keep], rank[keep]
        cut = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        rows: list[tuple] = []
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(node)).tolist()):
            l, length = prefix_choice(int(size[a]), int(size[a]) - (b - a), rank[a:b].astype(np.int64), percent)
            if length:
                rows.append(
                    (
                        None, int(node[a]), int(size[a]), l, value[a : a + length].view(np.int64),
                        np.sort(value[a:b]).tobytes(),
                    )
                )
        return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return shared.groupBy("place").applyInArrow(
        run, "id long, node long, size int, l int, prefix array<long>, shingles binary"
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows (a, b, a_comp, b_comp) of ``pairs`` whose sets have 100 * |a & b| >= percent * |a | b|."""
    side = lambda c: sets.select(
        F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("shingles").alias(f"{c}_set")
    )
    both = pairs.select("a", "b", "a_comp", "b_comp").join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "a_comp", "b_comp", "a_size", "b_size", "a_set", "b_set"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_size, b_size = (batch.column(k).to_numpy() for k in (4, 5))
            keep = np.zeros(len(a_size), bool)
            for i, (x, y) in enumerate(zip(batch.column(6), batch.column(7))):
                joint = np.concatenate(
                    (np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                )
                joint.sort()
                same = int(np.count_nonzero(joint[1:] == joint[:-1]))
                keep[i] = 100 * same >= percent * (int(a_size[i]) + int(b_size[i]) - same)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(mask) for k in range(4)], ["a", "b", "a_comp", "b_comp"]
            )

    return both.mapInArrow(run, "a long, b long, a_comp long, b_comp long")


def _bitmaps(sets: DataFrame) -> DataFrame:
    """(node, bits): the parity of a node's shared shingles in each of 8 or more hashed places a shingle, a power of 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for x in batch.column(1):
                value = np.frombuffer(x.as_buffer(), np.uint64)
                width = max(512, 1 << (8 * len(value) - 1).bit_length())
                place = (tv.mix64(value) & np.uint64(width - 1)).astype(np.int64)
                maps.append(np.packbits(np.bincount(place, minlength=width) & 1, bitorder="little"))
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(maps)], ["node", "bits"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, bits binary")


def differing(maps: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Places in which the bitmaps (64-bit words) of vertices i and j differ, the wider one folded to the narrower; at most |i ^ j|."""
    width = np.array([len(x) for x in maps], np.int64)
    narrow, out = np.minimum(width[i], width[j]), np.zeros(len(i), np.int64)
    for words in np.unique(narrow).tolist():
        at = np.flatnonzero(narrow == words)
        own, row = np.unique(np.concatenate((i[at], j[at])), return_inverse=True)
        bits = np.stack([np.bitwise_xor.reduce(maps[v].reshape(-1, words), axis=0) for v in own.tolist()])
        left, right = row[: len(at)], row[len(at) :]
        step = max(1, (1 << 20) // words)
        for k in range(0, len(at), step):
            out[at[k : k + step]] = np.bitwise_count(
                bits[left[k : k + step]] ^ bits[right[k : k + step]]
            ).sum(axis=1, dtype=np.int64)
    return out


def _candidates(
    tokens: DataFrame, lists: DataFrame, sets: DataFrame, percent: int, group: int = 600, block: int = 512
) -> DataFrame:
    """All pairs of different components that share enough prefix shingles and whose sizes and bitmaps allow a link.

    |a & b| is at most the number of shingles that either node shares with any
    other node, and at most half of what is left of both numbers' sum without
    the places in which the bitmaps differ; pairs are left out for which even
    that would not do.

    Lists with the same leader mostly hold the same nodes, so they are counted
    together, in parts of about ``group`` postings: a pair is emitted once per
    part, not once per shared shingle.  A list of over ``group`` nodes is a part
    of its own; one of over 2 * ``block`` nodes is dealt to the cells of a grid of blocks of about ``block`` nodes instead; a
    cell has the pairs of one block with another or with itself.
    """
    long = lists.filter(F.col("n") > 2 * block).select("token", F.ceil(F.col("n") / block).cast("long").alias("b"))
    leader = F.when(F.col("n") > group, F.col("token")).otherwise(F.col("x.node"))
    short = lists.filter(F.col("n") <= 2 * block).select(
        "token", leader.alias("leader"), F.when(F.col("n") <= group, F.col("n")).otherwise(0).alias("n")
    )
    totals = short.groupBy("leader").agg(F.greatest(F.ceil(F.sum("n") / group), F.lit(1)).alias("parts"))
    dealt = short.join(totals, "leader").select(
        "token", "leader", F.pmod(F.xxhash64("token"), F.col("parts")).alias("part")
    )
    fields = ("token", "node", "size", "l", "shared", "comp")
    plain = tokens.join(dealt, "token").select("leader", "part", *fields, F.lit(0).alias("side"))
    own = F.pmod(F.xxhash64("node"), F.col("b"))
    cell = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("b") - 1),
        lambda k: F.struct(
            (-1 - (F.least(own, k) * F.col("b") + F.greatest(own, k))).alias("part"),
            F.when(own < k, 1).when(own > k, 2).otherwise(0).alias("side"),
        ),
    )
    grid = tokens.join(long, "token").select(*fields, F.explode(cell).alias("cell")).select(
        F.col("token").alias("leader"), "cell.part", *fields, "cell.side"
    )

    def run(table: pa.Table, parity: pa.Table) -> pa.Table:
        get = lambda name: table.column(name).to_numpy()
        order = np.argsort(get("token"), kind="stable")
        token, size, l, comp, shared, side = (get(c)[order] for c in ("token", "size", "l", "comp", "shared", "side"))
        name, vertex = np.unique(get("node")[order], return_inverse=True)
        _, at = np.unique(vertex, return_index=True)
        v_size, v_l, v_comp, v_shared, v_side = size[at].astype(np.int64), l[at], comp[at], shared[at].astype(np.int64), side[at]
        maps = [
            np.frombuffer(x.as_buffer(), np.uint64)
            for x in parity.column("bits").take(np.argsort(parity.column("member").to_numpy()))
        ]
        cut = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True])))
        key, count, held, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def settle() -> None:
            nonlocal key, count, held, waiting
            new, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
            i, j = new >> 32, new & 0xFFFFFFFF
            close = (100 + percent) * (
                v_shared[i] + v_shared[j] - differing(maps, i, j)
            ) >= 2 * percent * (v_size[i] + v_size[j])
            new, n = new[close], n[close]
            both = np.concatenate((key, new))
            key, inverse = np.unique(both, return_inverse=True)
            count = np.bincount(inverse, np.concatenate((count, n)), minlength=len(key)).astype(np.int64)
            held, waiting = [], 0

        for first, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
            own = np.sort(vertex[first:end])
            for k in range(0, len(own), 512):  # a long list in strips
                left, right = own[k : k + 512, None], own[None, k:]
                fits = (left < right) & (v_comp[left] != v_comp[right]) & (
                    (100 + percent) * np.minimum(
                        v_shared[left], v_shared[right]
                    ) >= percent * (v_size[left] + v_size[right])
                )
                fits &= (v_side[left] == 0) | (v_side[left] != v_side[right])  # of two blocks only pairs of one with the other
                i, j = np.nonzero(fits)
                held.append(own[k : k + 512][i].astype(np.int64) << 32 | own[k:][j])
                waiting += len(i)
                if waiting > 1_000_000:
                    settle()
        settle()
        i, j = key >> 32, key & 0xFFFFFFFF
        columns = [
            pa.array(name[i]), pa.array(name[j]), pa.array(v_comp[i]), pa.array(v_comp[j]), pa.array(count),
            pa.array(np.minimum(v_l[i], v_l[j]).astype(np.int32)),
        ]
        return pa.table(columns, names=["a", "b", "a_comp", "b_comp", "n", "l"])

    members = plain.unionByName(grid)
    parity = members.select("leader", "part", "node").distinct().join(_bitmaps(sets), "node")
    parity = parity.select(
        F.col("leader").alias("of"), F.col("part").alias("of_part"), F.col("node").alias("member"), "bits"
    )
    groups = members.groupBy("leader", "part").cogroup(parity.groupBy("of", "of_part")).applyInArrow(
        run, "a long, b long, a_comp long, b_comp long, n long, l int"
    )
    return groups.groupBy("a", "b", "a_comp", "b_comp").agg(
        F.sum("n").alias("n"), F.min("l").alias("l")
    ).filter("n >= l")


def jaccard_links(
    spark: SparkSession, sets: DataFrame, percent: int, rounds: int = 3, pairs_per_posting: float = 4
) -> list[DataFrame]:
    """Written tables of links (a, b) that together give the components of the full join over the nodes of ``sets``;
    without ``rounds`` all its links.

    Star rounds go on, ``rounds`` at most, while the pairs left in posting lists
    would be more than ``pairs_per_posting`` times the postings.  In a round
    every node is verified against the leader that most of its lists have.  In
    the first round a list's leader is the node with the least part of shingles
    that nobody else has, next to which the copies of a text lie closest; later,
    its leaders are a node of its first and one of its last component, drawn
    anew in each round.  Components that links join become one, named by the
    smallest; lists inside one component are settled and go.
    """
    shared = F.expr("cast(octet_length(shingles) div 8 as int)")
    tokens = sets.select(
        "node", "size", "l", shared.alias("shared"), F.col("node").alias("comp"), F.explode("prefix").alias("token")
    )
    found, kept, merged = [], None, None
    for turn in range(rounds + 1):
        # another member of a component leads in each round, the same one in most lists of a group
        draw = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
        end = F.struct("comp", draw.alias("draw"), "node", "size", "shared")
        lists = tokens.groupBy("token").agg(
            F.count("*").alias("n"), F.min(end).alias("low"), F.max(end).alias("high"),
            F.min_by(end, F.struct(1 - F.col("shared") / F.col("size"), "node")).alias("close"),
        )
        x, y = (F.col("low"), F.col("high")) if turn else (
            F.col("close"), F.when(F.col("close.comp") < F.col("high.comp"), F.col("high")).otherwise(F.col("low"))
        )
        lists = materialise(
            lists.filter("low.comp < high.comp").select("token", "n", x.alias("x"), y.alias("y")), "lists"
        )
        todo = lists.agg(F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()
        if todo[0] and (turn == rounds or todo[1] <= pairs_per_posting * todo[0]):
            found.append(materialise(_verified(_candidates(tokens, lists, sets, percent), sets, percent), "links"))
        if not todo[0] or turn == rounds or todo[1] <= pairs_per_posting * todo[0]:
            discard(lists, kept, merged)
            break
        now = materialise(tokens.join(lists.select("token", "x", "y"), "token"), "tokens")
        discard(lists, kept, merged)
        kept = now
        votes = kept.select(
            "node", "size", "shared", "comp",
            F.when(F.col("comp") != F.col("x.comp"), F.col("x")).otherwise(F.col("y")).alias("to"),
        )
        votes = votes.filter(
            F.least("shared", "to.shared") * (100 + percent) >= (F.col("size") + F.col("to.size")) * percent
        )
        votes = votes.groupBy("node", "comp", "to").agg(F.count("*").alias("n")).groupBy("node", "comp").agg(
            F.max(F.struct("n", "to")).alias("best")
        )
        node, to = F.col("node"), F.col("best.to.node")
        pairs = votes.select(
            F.least(node, to).alias("a"), F.greatest(node, to).alias("b"),
            F.when(node < to, F.col("comp")).otherwise(F.col("best.to.comp")).alias("a_comp"), F.when(
                node < to, F.col("best.to.comp")
            ).otherwise(F.col("comp")).alias("b_comp"),
        ).distinct()
        found.append(materialise(_verified(pairs, sets, percent), "links"))
        merged = connected_components(found[-1], "a_comp", "b_comp")
        later = merged.filter("node <> component").select(
            F.col("node").alias("comp"), F.col("component").alias("to_comp")
        )
        tokens = kept.join(later, "comp", "left").select(
            "node", "size", "l", "shared", F.coalesce("to_comp", "comp").alias("comp"), "token"
        )
        release(spark)
    return found


def _written_sets(
    docs: DataFrame, n: int, percent: int, hot: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: sets (node, size, l, prefix, shingles) and documents (id, node, n_shingles); the first holds both, to be discarded."""
    spark = docs.sparkSession
    buckets = _LEAST_BUCKETS
    while buckets < min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 15):
        buckets *= 2
    both = materialise(_prefixes(_shared(_postings(docs, n, buckets, hot, id_col, text_col), buckets), percent), "sets")
    nodes = materialise(
        both.filter("l = 0").select("id", "node", F.col("size").cast("long").alias("n_shingles")), "nodes"
    )
    release(spark)
    return both, both.filter("l > 0").drop("id"), nodes


def _classified(
    docs: DataFrame, n: int, percent: int, hot: int, pairs_per_posting: float, rounds: int, id_col: str, text_col: str
) -> DataFrame:
    """(id, node, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    both, sets, nodes = _written_sets(docs, n, percent, hot, id_col, text_col)
    found = jaccard_links(spark, sets, percent, rounds, pairs_per_posting)
    parts = connected_components(_all_links(spark, found))
    discard(both, *found)
    classes = nodes.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("least")
    ).join(parts, "node", "left")
    smallest = classes.filter("component is not null").groupBy("component").agg(F.min("least").alias("component_id"))
    # a component may hold any share of the nodes, so its name is looked up in several places; a lone node has none to look up
    salted = smallest.select(
        F.col("component").alias("key"), "component_id",
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"),
    )
    lookup = classes.withColumns(
        {"key": F.coalesce("component", "node"), "salt": F.pmod(F.xxhash64("node"), F.lit(_SALTS)).cast("int")}
    )
    named = lookup.join(salted, ["key", "salt"], "left").select(
        F.col("node").alias("c_node"), F.coalesce("component_id", "least").alias("component_id")
    )
    rows = nodes.join(named, nodes.node == named.c_node, "left")
    return rows.select("id", "node", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def jaccard_components(
    docs: DataFrame, n: int = 5, percent: int = 75, hot: int = 1024, pairs_per_posting: float = 4, rounds: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_shingles, component_id.

    Words are lower-cased (A-Z); a set holds the distinct n-word shingles, with
    fewer words the whole sequence as one; a null text or one without words has
    an empty set, links with nothing and is its own component.  Two documents
    link when 100 * |x & y| >= percent * |x | y|; component_id is the smallest
    id reachable by links, itself included (null ids are left out of the
    smallest).  Ids are long integers.  Repeated rows are kept; other columns
    are left out; an empty table gives an empty result.
    """
    rows = _classified(docs, n, percent, hot, pairs_per_posting, rounds, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), "n_shingles", "component_id")


def _with_nodes(docs: DataFrame, n: int, text_col: str, name: str) -> DataFrame:
    """docs with ``name``, the signature of the text's words (null without words)."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, empty = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for _, _, data, offsets in tv.blocks(batch.column(names.index(text_col))):
                words, first = tv.word_hashes(data, offsets)
                nodes.append(_signatures(words, first))
                empty.append(np.diff(first) == 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(nodes), mask=np.concatenate(empty))], [*names, name]
            )

    return docs.mapInArrow(
        run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` long"
    )


def drop_near_copies(
    docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component of ``jaccard_components`` that has words and ids: the row of the smallest id.

    Rows with a null id and rows without words stay as they are.  Of rows with
    one id and the same words (their case and blanks may differ) one stays: the
    first by the hash of its text, then its text, then the hash of all its
    columns.  All columns are kept, whatever their names.
    """
    rows = materialise(_classified(docs, n, percent, 1024, 4, 3, id_col, text_col), "rows")
    names = [f"`{c}`" for c in docs.columns]
    own = own_prefix(docs.columns, "_near_")
    named, node, first, place = (f"{own}{c}" for c in ("id", "node", "first", "place"))
    known = rows.filter("id is not null")
    gone = known.filter("id <> component_id").select(F.col("id").alias(named)).distinct()
    if known.groupBy("id").count().filter("count > 1").isEmpty():
        return docs.join(gone, F.col(id_col) == F.col(named), "left_anti")
    # ids occur several times: a row is told by its id and its words
    firsts = known.filter("node is not null and id = component_id").groupBy("component_id").agg(F.min(F.struct("id", "node")).alias("first")).select(
        F.col("first.id").alias(named), F.col("first.node").alias(first)
    )
    tagged = _with_nodes(docs, n, text_col, node)
    apart = F.col(id_col).isNull() | F.col(node).isNull()
    kept = tagged.filter(~apart).join(firsts, (F.col(id_col) == F.col(named)) & (F.col(node) == F.col(first)))
    order = (F.xxhash64(text_col), F.col(text_col), F.xxhash64(F.to_json(F.struct(*names))))
    kept = kept.withColumn(place, F.row_number().over(Window.partitionBy(named, first).orderBy(*order)))
    return kept.filter(F.col(place) == 1).select(*names).unionByName(tagged.filter(apart).select(*names))


def _all_links(spark: SparkSession, found: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], "a long, b long")
    for links in found:
        out = out.union(links.select("a", "b"))
    return out


def jaccard_join(
    docs: DataFrame, n: int = 5, percent: int = 75, hot: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """All links of the join of ``jaccard_components``, none left out: (members, links).

    members has one row per document: id, n_shingles, class_id (the smallest id
    with the same words; null without words), n_links (documents linked with it,
    those with the same words included).  links has the pairs (a, b) of class
    ids whose sets link, a < b.  Classes whose ids are all null have no name
    and no links here.
    """
    spark = docs.sparkSession
    both, sets, nodes = _written_sets(docs, n, percent, hot, id_col, text_col)
    found = jaccard_links(spark, sets, percent, 0)
    pairs = _all_links(spark, found).distinct()
    named = nodes.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("class_id"), F.count("*").alias("copies")
    )
    side = lambda c: named.select(
        F.col("node").alias(c), F.col("class_id").alias(f"{c}_class"), F.col("copies").alias(f"{c}_copies")
    )
    links = materialise(
        pairs.join(side("a"), "a").join(side("b"), "b").filter("a_class is not null and b_class is not null"),
        "class-links",
    )
    discard(both, *found)
    ends = links.select(F.col("a").alias("node"), F.col("b_copies").alias("n")).union(links.select("b", "a_copies"))
    others = ends.groupBy("node").agg(F.sum("n").alias("others"))
    counted = named.join(others, "node", "left").select(
        F.col("node").alias("c_node"), "class_id",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    members = nodes.join(counted, nodes.node == counted.c_node, "left").select(
        F.col("id").alias(id_col), "n_shingles", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return members, links.select(F.least("a_class", "b_class").alias("a"), F.greatest("a_class", "b_class").alias("b"))
