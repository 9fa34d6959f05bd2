"""Counts and reports (A1, A2, A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_report(df: DataFrame, by: str = "source", split: str = "split") -> DataFrame:
    """A1: train/valid totals per source plus a grand-total row (source null): a rollup."""
    return (df.rollup(by)
            .agg(F.sum(F.when(F.col(split) == "train", 1).otherwise(0)).cast("long").alias("n_train"),
                 F.sum(F.when(F.col(split) == "valid", 1).otherwise(0)).cast("long").alias("n_valid"),
                 F.count(F.lit(1)).alias("n_total")))


def count_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A2: row counts per group (a partial aggregate on the map side, then one small shuffle)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def size_of(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A5: dataset size per group feeding ratio arithmetic (one row per group)."""
    return count_report(df, by).withColumnRenamed("n_rows", "n")


def observed_count(df: DataFrame, name: str = "rows"):
    """A2 without a second pass: attach an observation; read ``obs.get`` after the action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n_rows")), obs
