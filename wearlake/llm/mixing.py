"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Each document gets a random-looking key, the MD5 of a seed and its id.  A
source's documents are ordered by the key; the first hexadecimal digits are a
range bucket, so a prefix sum is the sum of the buckets before (one small row
per source and bucket) plus a window inside the bucket.  A source with a third
of all rows is spread over all buckets.  A source's budget is cut exactly:
whole epochs first, then the documents in key order, the last one in part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.runtime import materialise, own_prefix

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources by code point, null last, take the weights in turn and share
    ``share`` of all sizes.  A target stops at ``most`` times its source's size;
    the excess is reshared by weight: with the sources sorted by the level at
    which they stop, a source stops if the level that the others would get, all
    before it stopped, reaches its own.  The windows run over one pre-aggregated
    row per source.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = own.withColumn("turn", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("turn") % len(weights) + 1).cast("int"))
    by_level = Window.orderBy("level", "turn")
    total = Window.partitionBy(F.lit(1))
    levels = (
        ranked.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("all_size", F.sum("source_size").over(total))
        .withColumn(
            "before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        )
        .withColumn("rest", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("reach", (F.col("all_size") * F.lit(float(share)) - F.col("before")) / F.col("rest"))
        .withColumn("stops", F.col("reach") >= F.col("level"))
        .withColumn("final", F.max(F.when(~F.col("stops"), F.col("reach"))).over(total))
    )
    return levels.select(
        "source", "source_size",
        F.when(F.col("stops"), F.col("cap")).otherwise(F.col("weight") * F.col("final")).alias("target"),
    )


def bucket_digits(rows: int, each: int = 2000) -> int:
    """Hexadecimal digits of the hash that cut ``rows`` into ranges of about ``each``, at least one."""
    return max(1, min(12, math.ceil(math.log(max(rows, 1) / each, 16)) if rows > each else 1))


def mix(
    docs: DataFrame, keep: bool = False, seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", prefix: str = "",
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words the mix takes of it, repeats counted).

    With ``keep`` all input columns come too.  The last four are named with
    ``prefix``; input columns of those names are replaced.  A source's taken
    words are its target, rounded down.  A null text has size 0 and nothing
    taken; a null source is a source; rows with equal ids are ordered by size,
    and equal rows are interchangeable; an empty table gives an empty result.
    Reruns agree.
    """
    added = [f"{prefix}{c}" for c in ("size", "source_size", "target", "taken")]
    columns = [c for c in docs.columns if c not in added] if keep else [id_col]
    inner = {c: f"_c{k}" for k, c in enumerate(columns)}
    sized = docs.select(
        *(
            F.col(f"`{c}`").alias(n) for c, n in inner.items()
        ), F.col(source_col).alias("source"), F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("key"),
    )
    if not keep:  # narrow rows: words are counted once
        sized = materialise(sized, "sized")
    sized = sized.withColumn("bucket", F.substring("key", 1, bucket_digits((docs if keep else sized).count())))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    earlier = F.coalesce(
        F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    targets = source_targets(
        buckets.groupBy("source").agg(F.sum("size").alias("size"))
    ).withColumnRenamed("source", "t_source")
    bases = buckets.withColumn("base", earlier).select(
        F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "base"
    )
    bases = bases.join(targets, F.col("b_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    inside = F.sum("size").over(
        Window.partitionBy("source", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = sized.withColumn("inside", F.coalesce(inside, F.lit(0))).join(
        bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))
    )
    budget = F.floor("target").cast("long")
    whole = F.when(
        F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")
    ).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size")
    taken = whole * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("base") - F.col("inside")))
    results = (F.col("size"), F.col("source_size"), F.col("target"), taken.cast("long"))
    return placed.select(*(F.col(n).alias(c) for c, n in inner.items()), *(x.alias(c) for x, c in zip(results, added)))


def mixed_documents(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once per epoch it is taken in, the last one cut at the budget.

    A document that isn't taken goes.  A cut text keeps its first words and the
    white space between them; n_chars, where there is one, follows it.
    """
    names = docs.columns
    own = own_prefix(names, "_mix_")
    rows = mix(docs, keep=True, seed=seed, prefix=own)
    taken, size, first = F.col(f"{own}taken"), F.col(f"{own}size"), F.col(f"{own}first")
    part = taken % size
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("long"), F.floor(taken / size).cast("int")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")),
    )
    rows = rows.filter(taken > 0).withColumn(f"{own}first", F.explode(copies))
    pieces = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.when(first > 0, F.array_join(F.slice(pieces, F.lit(1), first.cast("int")), "")).otherwise(F.col("text"))
    rows = rows.withColumn("text", cut)
    if "n_chars" in names:
        rows = rows.withColumn(
            "n_chars",
            F.when(first > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")),
        )
    return rows.select(*(f"`{c}`" for c in names))
