"""Text files as numbered lines (P7/S3): each line with its true number in its file.

A scan reads a file in blocks, each by one task and in order. So a line's number is the number of lines in the
blocks before its own, plus its place in the block. Blocks are counted by a narrow aggregation; only
their counts, one row per block, are summed along a file. No line is shuffled for its number: the blocks'
offsets (16 bytes a block, broadcast up to ``BROADCAST_BLOCKS``) are looked up where the line is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

BROADCAST_BLOCKS = 2_000_000  # 32 MB of keys and offsets: some 250 TB in blocks of 128 MB


def scan_lines(spark: SparkSession | DataFrameReader, paths: str | Sequence[str]) -> DataFrame:
    """(file, block, at, line) of every line, blank ones too, by a session or by a reader with options. ``at`` grows along a block; write the rows (or
    what is derived from them) before numbering, so every pass sees the same blocks."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read if isinstance(spark, SparkSession) else spark
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def number_lines(lines: DataFrame, out: str = "line_no") -> DataFrame:
    """Written rows of ``scan_lines`` with ``out`` (from 1 in each file) instead of block and at. All lines of
    a file must still be there: filter afterwards."""
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1
    key = lambda d: F.xxhash64(d["file"], d["block"])
    blocks = materialize(blocks.select("file", "block", shift.alias("_tf_shift")))
    blocks = blocks.withColumn("_tf_key", key(blocks))
    n, keys = blocks.agg(F.count(F.lit(1)), F.countDistinct("_tf_key")).first()
    if n <= BROADCAST_BLOCKS and keys == n:
        found = lines.join(F.broadcast(blocks.select("_tf_key", "_tf_shift")), key(lines) == F.col("_tf_key")).drop("_tf_key")
    else:
        found = lines.join(blocks.drop("_tf_key"), ["file", "block"])
    return found.withColumn(out, F.col("at") + F.col("_tf_shift")).drop("block", "at", "_tf_shift")
