"""Corpus pipeline: toxicity filter, exact and near de-duplication, mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. ``run`` writes each
stage's rows as Parquet in the shared scratch folder and reads them back as the next one's ``docs``. All
stages but the last return the columns of ``documents``; null texts, null ids, repeated rows and empty
tables have the results that the operators' docstrings state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneforge.llm import bpe, exact_dedup, mixture, near_dup, queries, toxicity
from tuneforge.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below 0.5 by a model fitted on labelled rows of ``docs`` that are not held out."""
    model = queries.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="_tf_toxicity").filter("_tf_toxicity < 0.5").drop("_tf_toxicity")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id."""
    return exact_dedup.exact_dedup(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the row with the smallest doc_id."""
    return near_dup.near_dedup(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once for each play (at most twice)."""
    return mixture.mixed_documents(docs).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the digest of the decoded bytes, a row per
    row of ``docs``."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # Written between, and in smaller blocks than by default: one Python worker a task, with less in memory.
    encoded = written(bpe.encode(docs, ranks, public_tokenizers.PATTERN, block_chars=4_000_000), "pipeline-encoded")
    return bpe.decode(encoded, ranks).select(
        "doc_id", F.col("n_ids").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixture", mix_sources),
    ("bpe", tokenise),
]

# Consistent weighted sampling and byte-pair merges have no SQL form; tests/llm/test_pipeline.py holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
