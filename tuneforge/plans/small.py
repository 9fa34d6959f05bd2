"""Joining per-group statistics back onto rows. The statistics are written tables, so the planner
knows their bytes and broadcasts them only below ``spark.sql.autoBroadcastJoinThreshold``; beyond it
the join is shuffled and AQE splits skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(rows: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner",
                   broadcast: bool = False) -> DataFrame:
    """Equi-join on ``on`` where null keys match null keys (a group may be null)."""
    on = list(on)
    renamed = other.select(*[F.col(c).alias(f"_tf_j_{c}") if c in on else F.col(c) for c in other.columns])
    if broadcast:
        renamed = F.broadcast(renamed)
    cond = None
    for c in on:
        e = rows[c].eqNullSafe(renamed[f"_tf_j_{c}"])
        cond = e if cond is None else cond & e
    return rows.join(renamed, cond, how).drop(*[f"_tf_j_{c}" for c in on])


def attach_stats(rows: DataFrame, stats: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``stats`` (a written table) to ``rows`` on ``on`` (null-safe), without a hint."""
    return null_safe_join(rows, stats, on, how)
