"""Reading the given parquet tables and shaping them into the reference's inputs.

The reference reads workbooks, JSONL files, dialogue JSON and hub tables; the test data is a
set of parquet tables. These helpers say which table plays which input (FIXTURES.md §2)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import as_records, merge_sources

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A given table; ``spread_by`` names its key when CPU-heavy per-row work follows
    (see ``plans.layout.spread_for_cpu``)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if spread_by is not None:
        from ..plans.layout import spread_for_cpu

        df = spread_for_cpu(df, spread_by)
    return df


def qa_records(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """QA source: part name -> part type (plays a QA sheet export). ``spread`` deals the rows evenly, for
    work whose output is much larger than they are (see ``plans.layout.spread_rows``)."""
    rows = as_records(read_table(spark, sf_dir, "part"), "part", "p_partkey", input="p_name", output="p_type")
    if spread:
        from ..plans.layout import spread_rows

        rows = spread_rows(rows, "row_key", "input")
    return rows


def text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text source: documents (plays a raw-text sheet export)."""
    return as_records(read_table(spark, sf_dir, "documents"), "documents", "doc_id", text="text")


def corpus(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The merged corpus: QA and text records as one DataFrame; ``spread`` as for ``qa_records``."""
    return merge_sources(qa_records(spark, sf_dir, spread), text_records(spark, sf_dir))


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogue utterances (dlg, pos, turn_num, utterance): the leading system turn dropped and
    the rest numbered from 1 (conversations' ``turn`` is 0-based)."""
    from ..operators.dialogue import renumber_after_leading

    conv = read_table(spark, sf_dir, "conversations")
    u = renumber_after_leading(conv, "conv_id", "turn", "role", "system", "turn_num")
    return u.select(F.col("conv_id").alias("dlg"), F.col("turn").cast("int").alias("pos"), "turn_num",
                    F.col("text").alias("utterance"))
