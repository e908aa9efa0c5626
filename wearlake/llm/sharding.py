"""Sharding by a hierarchical weighted hash tree: regions hold racks, racks hold shards.

At each level a row draws one number per child, -ln(u) / weight with u a hash of
its id and the child's name, and goes to the child with the smallest.  A child
gets its share by weight, and a draw depends on no other child, so a row leaves
a child only for one whose weight rose (or because its own fell), and subtrees
whose weights and place stay keep the rows that reach them.  A shard that opens
a region of its own changes no other weight: rows move only into it.  A shard
put into an old rack raises that rack's and region's weight as well, so rows
that come into these may also move among their other shards.

All draws are column expressions; no row is shuffled to be assigned.  Slots
number the rows of a shard from a sorted, written table of narrow rows: range
partitions cut at any row, so one id or one text may have a third of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.runtime import materialise, own_prefix

#: Hexadecimal digits of a draw's hash: 52 bits, exact in a double.
_DIGITS = 13


@dataclass(frozen=True)
class Node:
    """A region, rack or shard.  ``shard`` is the number of a leaf; a weight of 0 takes no rows."""

    name: str
    weight: float = 1.0
    children: tuple[Node, ...] = ()
    shard: int | None = None

    @property
    def total(self) -> float:
        """A leaf's own weight; otherwise that of its leaves."""
        return sum(c.total for c in self.children) if self.children else self.weight

    @property
    def leaves(self) -> tuple[Node, ...]:
        return tuple(leaf for c in self.children for leaf in c.leaves) if self.children else (self,)


def region(number: int, racks: Sequence[Sequence[tuple[int, float]]]) -> Node:
    """A region of racks of (shard, weight)."""
    return Node(
        f"region{number}",
        children=tuple(
            Node(f"region{number}/rack{k}", children=tuple(Node(f"shard{s}", w, shard=s) for s, w in rack))
            for k, rack in enumerate(racks)
        ),
    )


def even_tree(shards: int = 24, racks: int = 3, per_rack: int = 4) -> Node:
    """Shards of weight 1 in racks of ``per_rack`` and regions of ``racks``; the last ones may hold fewer."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    each = [
        [(s, 1.0) for s in range(k, min(k + per_rack, shards))] for k in range(0, shards, per_rack)
    ]
    return Node("root", children=tuple(region(k // racks, each[k : k + racks]) for k in range(0, len(each), racks)))


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, numbered next, in a region of its own; rows move only into it."""
    shard = max(leaf.shard for leaf in tree.leaves) + 1
    return Node(tree.name, children=(*tree.children, region(len(tree.children), [[(shard, weight)]])))


def draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight, u in (0, 1) from the MD5 of the node's name and the key."""
    digest = F.md5(F.concat(F.lit(node.name + ":"), key).cast("binary"))
    u = (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**_DIGITS))
    return -F.ln(u) / F.lit(float(node.total))


def tree_shard(key: Column, tree: Node) -> Column:
    """The shard (int) that a text key draws; equal draws go to the child named first."""

    def descend(node: Node) -> Column:
        if not node.children:
            return F.lit(node.shard)
        there = [c for c in node.children if c.total > 0]
        if not there:
            raise ValueError(f"{node.name} has no weight")
        if len(there) == 1:
            return descend(there[0])
        least = F.array_min(F.array(*(F.struct(draw(key, c).alias("d"), F.lit(k).alias("k")) for k, c in enumerate(there))))
        chosen = least["k"]
        if not any(c.children for c in there):
            return F.element_at(F.array(*(F.lit(c.shard) for c in there)), chosen + 1)
        # one lambda variable, so that a level is drawn once however many children it has
        return F.element_at(F.transform(F.array(chosen), lambda at: _case(at, [descend(c) for c in there])), 1)

    def _case(at: Column, to: list[Column]) -> Column:
        out = F.when(at == 0, to[0])
        for k, column in enumerate(to[1:], 1):
            out = out.when(at == k, column)
        return out

    return descend(tree).cast("int")


def with_shard(docs: DataFrame, tree: Node, id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """All rows and columns, with the shard of each row's id; a column of that name is replaced.

    The id decides by its text; all rows with a null id go to one shard, as rows of one id do.
    """
    return docs.withColumn(name, tree_shard(F.coalesce(F.col(id_col).cast("string"), F.lit("")), tree))


def slots(rows: DataFrame, group: str, order: Sequence[str], name: str = "slot") -> DataFrame:
    """Rows with their number in their group, gapless from 0, in the order of columns (nulls first).

    Rows that are equal in all of ``order`` are numbered in the order in which
    the table was read, so however many they are they lie in many tasks.
    """
    own = own_prefix(rows.columns, "_slot_")
    tie, place, part, least, count = (f"{own}{c}" for c in ("tie", "place", "part", "first", "rows"))
    b_part, b_group, b_base = (f"{own}{c}" for c in ("b_part", "b_group", "b_base"))
    read = materialise(rows.withColumn(tie, F.monotonically_increasing_id()), "unsorted")
    keys = [group, *order, tie]
    dealt = read.repartitionByRange(*keys).sortWithinPartitions(*keys)
    written = materialise(dealt.withColumn(place, F.monotonically_increasing_id()), "sorted")
    written = written.withColumn(part, F.shiftright(place, 33))
    # a row per part and group; only their sums pass the window
    held = written.groupBy(part, group).agg(F.min(place).alias(least), F.count("*").alias(count))
    before = F.sum(count).over(Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    base = held.select(
        F.col(part).alias(b_part), F.col(group).alias(b_group),
        (F.coalesce(before, F.lit(0)) - F.col(least)).alias(b_base),
    )
    joined = written.join(base, (F.col(part) == F.col(b_part)) & F.col(group).eqNullSafe(F.col(b_group)))
    return joined.withColumn(name, (F.col(place) + F.col(b_base)).cast("long")).drop(
        tie, place, part, b_part, b_group, b_base
    )


def shard_documents(
    docs: DataFrame, tree: Node | None = None, more: Node | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    ``tree`` is 24 even shards and ``more`` that tree with one more, unless
    given.  size is the text's UTF-8 bytes and 8; a null text has no bytes and
    the checksum of none.  law is ``key``: the id and the tree decide.  Slots
    follow the id, then the text's checksum and size.  Rows with a null id are
    one shard's, repeated rows have slots of their own, an empty table gives an
    empty result.  Other columns are left out.
    """
    tree = tree or even_tree()
    more = more or grown(tree)
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"), tree_shard(key, tree).alias("shard"), tree_shard(key, more).alias("grown_shard"),
    )
    numbered = slots(narrow, "shard", ["_id", "text_crc32", "size"])
    return numbered.select(F.col("_id").alias(id_col), "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, tree: Node, rows_per_file: int = 100_000, id_col: str = "doc_id") -> None:
    """Write all rows as Parquet under ``path``, a folder ``shard=N`` per shard.

    A shard's rows are dealt over tasks at random, so a shard with most of the
    rows is written by many; a file has ``rows_per_file`` rows at most.  An
    input column named shard is replaced.
    """
    salt = own_prefix(docs.columns, "_salt")
    dealt = with_shard(docs, tree, id_col).withColumn(salt, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(64)))
    dealt.repartition("shard", salt).drop(salt).write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
