"""Mixing extra dialogue into a train/valid split without leakage."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .split import require_enough, sample_exact


def exclude_sampled(pool: DataFrame, sampled: DataFrame, cols: Sequence[str] = ("input", "output")) -> DataFrame:
    """Pool rows whose *values* equal no sampled row (null-safe over ``cols``).

    Duplicates of a sampled pair are removed too. A hash anti-join on the value columns; the
    sampled side is de-duplicated first (AQE splits a skewed value partition)."""
    cols = list(cols)
    right = sampled.select(*[F.col(c).alias(f"_tf_s_{c}") for c in cols]).distinct()
    cond = None
    for c in cols:
        e = pool[c].eqNullSafe(right[f"_tf_s_{c}"])
        cond = e if cond is None else cond & e
    return pool.join(right, cond, "left_anti")


def mix_sizes(n_train: int, n_valid: int, ratio: float) -> tuple[int, int]:
    """int(len(split) * ratio) for each split (the ratio is relative to the base)."""
    return int(math.floor(n_train * ratio)), int(math.floor(n_valid * ratio))


def split_counts(base: DataFrame, split: str = "split") -> tuple[int, int]:
    """Train and valid sizes of a split DataFrame (one aggregate, two numbers to the driver)."""
    row = base.agg(F.sum(F.when(F.col(split) == "train", 1).otherwise(0)).alias("t"),
                   F.sum(F.when(F.col(split) == "valid", 1).otherwise(0)).alias("v")).first()
    return int(row["t"] or 0), int(row["v"] or 0)


def mix_in(base: DataFrame, pool: DataFrame, key: str, ratio: float = 0.3, seed=42,
           cols: Sequence[str] = ("input", "output"), split: str = "split", origin: str = "origin",
           base_sizes: tuple[int, int] | None = None) -> DataFrame:
    """Add floor(|train|*ratio) pool rows to train and floor(|valid|*ratio) to valid.

    The valid sample is drawn only from pool rows whose values differ from every train sample,
    so no pair leaks across splits. Both sufficiency checks (before and after the anti-join)
    raise ``ValueError``. Output: the base rows and the sampled rows, with ``origin`` telling
    them apart, and ``order_key`` (seeded hash) to order each split when writing. ``base_sizes``
    (train, valid) skips counting the base when the split already knows them
    (``split.split_sizes``)."""
    n_train, n_valid = base_sizes if base_sizes is not None else split_counts(base, split)
    add_train, add_valid = mix_sizes(n_train, n_valid, ratio)
    pool = materialize(pool)  # read by several jobs below: written once to the shared folder
    # each sample's cut counts its input, so the pool sizes come from the cuts, not extra passes
    t_train: dict = {}
    s_train = sample_exact(pool, key, add_train, seed, "mix_train", totals=t_train)
    require_enough(add_train + add_valid, t_train["n"], "dialogue pool")
    # the anti-join shuffles the pool: run it once, then sample from the written rows
    remaining = materialize(exclude_sampled(pool, s_train, cols))
    t_valid: dict = {}
    s_valid = sample_exact(remaining, key, add_valid, seed, "mix_valid", totals=t_valid)
    require_enough(add_valid, t_valid["n"], "dialogue pool after removing train samples")
    out = (base.withColumn(origin, F.lit("base"))
           .unionByName(s_train.withColumn(split, F.lit("train")).withColumn(origin, F.lit("pool")),
                        allowMissingColumns=True)
           .unionByName(s_valid.withColumn(split, F.lit("valid")).withColumn(origin, F.lit("pool")),
                        allowMissingColumns=True))
    seed_c = F.lit(int(seed)).cast("string")
    return out.withColumn("order_key", F.md5(F.concat_ws(":", seed_c, F.lit("mix_order"), F.col(split),
                                                         F.col(key).cast("string"))))
