"""Queries of this subpackage for the driver: one per operator, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.llm import (
    fingerprint, jaccard, mixing, negatives, packing, pqdedup, quality, quotes, sharding, tokencount, tokenfile, toxicity,
    whitening,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, _read(spark, sf_dir, "labels")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_read(spark, sf_dir, "documents"), TOKENIZER)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), TOKENIZER)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality.fit_quality(docs, _read(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pqdedup.near_duplicate_vectors(_read(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(_read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_read(spark, sf_dir, "documents"))


def op9_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotations(_read(spark, sf_dir, "conversations"))


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfile.scratch_path(spark)
    tokenfile.write_token_file(_read(spark, sf_dir, "documents"), path, TOKENIZER)
    return tokenfile.read_token_file(spark, path, with_ids=False)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.hard_negatives(_read(spark, sf_dir, "embeddings").withColumn("label", moved))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_toxicity, op2_token_counts, op3_packing, op4_quality, op5_embedding_dedup, op6_mixing, op7_fingerprints,
        op8_jaccard_join, op9_chat_quotes, op10_token_file, op11_whitening, op12_sharding, op13_hard_negatives, pipeline,
    )
    return {f.__name__: f for f in own}


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents
), own AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM own
), levels AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(turn % 3 + 1)::INT] AS weight, source_size * 2.0::DOUBLE AS cap FROM ranked
), ordered AS (
  SELECT *, cap / weight AS level, (sum(source_size) OVER ())::DOUBLE AS all_size FROM levels
), reached AS (
  SELECT *, (all_size * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY level, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (ORDER BY level, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reach FROM ordered
), targets AS (
  SELECT source, source_size, CASE WHEN reach >= level THEN cap ELSE weight * max(CASE WHEN reach < level THEN reach END) OVER () END AS target FROM reached
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM placed
)
SELECT doc_id, size, source_size, target, (whole * size + least(size, greatest(0, budget - whole * source_size - before)))::BIGINT AS taken FROM epochs
"""


def oracle_sql() -> dict[str, str]:
    """For the operators that SQL can express; the others are tested against brute force."""
    return {"op6_mixing": MIXING_SQL, "op9_chat_quotes": quotes.SQL}
