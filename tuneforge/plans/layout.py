"""Partition layout helpers."""

from __future__ import annotations

import math

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame


def spread_for_cpu(scan: DataFrame, key: str) -> DataFrame:
    """Before CPU-heavy per-row work (tokenising, validating, prompting whole texts): when a
    source scan yields fewer partitions than the cluster has task slots, hash-spread its rows by
    ``key`` (which also spreads very long texts); otherwise keep the scan's own partitioning, so
    a large input is never shuffled for this. Call it on a plain scan: counting a scan's
    partitions only plans file splits and runs no job."""
    try:
        slots = scan.sparkSession.sparkContext.defaultParallelism
        parts = scan.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):  # a remote session has no RDDs: keep the plan as is
        return scan
    return scan if parts >= slots else scan.repartition(slots, key)


def spread_rows(scan: DataFrame, *keys: str, rows_per_task: int = 50_000) -> DataFrame:
    """Before per-row work that makes far more than it reads: a scan is cut by bytes, so a few of its tasks
    may hold all rows of a compact table. Hash-spreads narrow rows by ``keys``, so that tasks follow
    the rows; Parquet footers tell their number."""
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(max(slots, math.ceil(scan.count() / rows_per_task)), *keys)
