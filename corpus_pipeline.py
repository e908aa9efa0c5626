"""Corpus pipeline: toxicity, quality, near duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns the columns of documents (the last one its packed pieces).  ``run``
writes each stage as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wearlake.llm import jaccard, mixing, packing, quality, toxicity
from wearlake.llm.queries import TOKENIZER
from wearlake.llm.runtime import discard, materialise, own_prefix

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxic grade is below one half."""
    model = toxicity.fit_toxicity(_documents(spark, sf_dir), _labels(spark, sf_dir))
    own = own_prefix(docs.columns, "_corpus_")  # so that no column of documents is lost
    scored = toxicity.score_toxicity(docs, model, keep=True, prefix=own).filter(f"not {own}toxic")
    return scored.select(*(f"`{c}`" for c in docs.columns))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is one half or more."""
    model = quality.fit_quality(_documents(spark, sf_dir), _labels(spark, sf_dir))
    own = own_prefix(docs.columns, "_corpus_")
    scored = quality.score_quality(docs, model, keep=True, prefix=own).filter(f"{own}predicted = 1")
    return scored.select(*(f"`{c}`" for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, one row of it; documents with a null id stay."""
    return jaccard.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources to their target weights, with repeats and exact cuts."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores can't be put in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _documents(spark, sf_dir)
    for name, stage in STAGES:
        done = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)  # a stage's own table; documents have no such mark
        docs = done
    return docs
