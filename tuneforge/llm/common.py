"""Shared helpers: reading tables, written intermediates, and row numbering without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# ASCII white space, as the contracts spell it (Java and RE2 pattern).
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder of the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of re-running its plan) and lets
    several later passes read only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_bucket(cols: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def id_key(c: Column) -> Column:
    """An id as a text that is never null, so that null ids join and group like any other."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def with_running_start(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str,
                       buckets: int = 1024) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the row's group, where a group is
    ordered by (hash bucket of ``order``, ``order``).

    No window spans a group: one narrow aggregation gives each (group, bucket) its total, a running sum
    over at most ``buckets`` rows a group gives bucket offsets, and rows are summed only inside
    (group, bucket). A group that holds most rows is therefore spread over ``buckets`` windows.
    ``group`` columns must not be null."""
    group, order = list(group), list(order)
    rows = rows.withColumn("_b", hash_bucket([F.col(c) for c in order], buckets))
    sums = rows.groupBy(*group, "_b").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).cast("long").alias("_o"))
    inside = Window.partitionBy(*group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_p", F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("long"))
    return (rows.join(starts, [*group, "_b"])
            .withColumn(out, F.col("_o") + F.col("_p")).drop("_b", "_o", "_p"))
