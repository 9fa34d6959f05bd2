"""One ordered output per split (K-1, K-2): parts in seeded order plus a manifest of where each part starts.

A single shuffled file cannot be written by many tasks, so the order is kept as (part, line): parts are ranges of
(split, order), sorted inside, and the manifest holds each part file's first row number in its split. Reading
back adds that number to a line's number in its file, so no row is shuffled and no window spans a split.

Defined cases: rows of equal order meet in one part, in any order unless ``order`` has more columns; a null order
comes first; a null split is a split of its own; an empty table is an empty manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.lines import number_lines, scan_lines

MANIFEST = "_manifest"  # hidden from readers of the data, as its name starts with an underscore
MANIFEST_SCHEMA = "split string, file string, first_row long, n_rows long"


def write_ordered(df: DataFrame, root: str, cols: Sequence[str], split: str, order: str | Sequence[str],
                  n_files: int | None = None) -> DataFrame:
    """Write JSON lines under ``root``/split=..., then the manifest: (split, file, first_row, n_rows), rows
    counted from 1 in each split. The manifest is written last, so a folder without one is unfinished."""
    spark = df.sparkSession
    keys = [order] if isinstance(order, str) else list(order)
    ranged = df.repartitionByRange(int(n_files), split, *keys) if n_files else df.repartitionByRange(split, *keys)
    (ranged.sortWithinPartitions(split, *keys)
     .select(F.col(split).alias("split"), F.to_json(F.struct(*cols)).alias("value"))
     .write.partitionBy("split").text(f"{root}/data"))
    if not spark.read.format("binaryFile").load(f"{root}/data").select("path").head(1):
        counts = spark.createDataFrame([], MANIFEST_SCHEMA)
    else:
        # Part numbers follow the ranges; a part cut into several files numbers them by name.
        name = F.element_at(F.split("path", "/"), -1)
        place = [F.regexp_extract(name, r"^part-(\d+)", 1).cast("int"), name]
        lines = (spark.read.schema("value string, split string").text(f"{root}/data")
                 .select("split", F.col("_metadata.file_path").alias("path")).groupBy("split", "path").agg(F.count(F.lit(1)).alias("n_rows")))
        before = Window.partitionBy("split").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)  # a row per file
        counts = lines.select("split", name.alias("file"),
                              (F.coalesce(F.sum("n_rows").over(before), F.lit(0)) + 1).alias("first_row"), "n_rows")
    counts.coalesce(1).write.parquet(f"{root}/{MANIFEST}")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/{MANIFEST}")


def read_ordered(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """(split, row_no, the JSON fields of ``schema``): ``row_no`` is the row's place in its split, from 1."""
    manifest = read_manifest(spark, root).select(F.col("file").alias("_tf_file"), "split", "first_row")
    if not manifest.head(1):
        return spark.createDataFrame([], f"split string, row_no long, {schema}")
    held = materialize(scan_lines(spark, f"{root}/data"))
    lines = number_lines(held).withColumn("_tf_file", F.element_at(F.split("file", "/"), -1))
    folder = F.element_at(F.split("file", "/"), -2)  # one part writes a file of the same name in several splits
    found = lines.join(manifest.withColumn("_tf_dir", F.concat(F.lit("split="), F.coalesce("split", F.lit("__HIVE_DEFAULT_PARTITION__")))),
                       (lines["_tf_file"] == manifest["_tf_file"]) & (folder == F.col("_tf_dir")))
    return found.select("split", (F.col("first_row") + F.col("line_no") - 1).alias("row_no"),
                        F.from_json("line", schema).alias("r")).select("split", "row_no", "r.*")
