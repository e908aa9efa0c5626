"""The bounded sample of labelled documents on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.llm.runtime import materialise


def _settled(labels: DataFrame, target: str, keep: Column | None) -> DataFrame:
    """(doc_id, y) of ids labelled one way; an id labelled both ways or null is left out."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
    if keep is not None:
        rows = rows.filter(keep)
    return rows.groupBy("doc_id").agg(
        F.min(target).cast("int").alias("y"), F.max(target).cast("int").alias("z")
    ).filter("y = z").drop("z")


def class_counts(labels: DataFrame, target: str, keep: Column | None = None) -> tuple[int, int]:
    """How many ids have each label, over all of them."""
    n = {r["y"]: r["n"] for r in _settled(labels, target, keep).groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    return n.get(0, 0), n.get(1, 0)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, per_class: int, keep: Column | None = None
) -> DataFrame:
    """(text, y) of at most ``per_class`` labelled documents of each class 0 and 1, written to the shared folder.

    Rows are taken in the order of a hash of their id, so the same labels give
    the same sample.  ``keep`` restricts the labels (a condition on doc_id and
    the label columns).  Of documents with one id the one with the smallest hash
    of its text counts.
    """
    rows = _settled(labels, target, keep)
    order = (F.xxhash64(F.col("doc_id")), F.col("doc_id"))
    ids = rows.filter("y = 1").orderBy(*order).limit(per_class).union(
        rows.filter("y = 0").orderBy(*order).limit(per_class)
    )
    # at most 2 * per_class rows of two numbers: a proven bound for the broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    one = found.groupBy("doc_id").agg(
        F.first("y").alias("y"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    )
    return materialise(one.select("text", "y"), "labelled")
