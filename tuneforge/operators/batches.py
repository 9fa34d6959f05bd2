"""Padded batches (B1): the collator's dynamic padding as a Spark job.

Rows of a split are numbered in seeded hash order and consecutive ``size`` rows form a batch, so every
batch of a split is full but the last, at any size and for any number of splits. No window holds a split:
counts per (split, hash bucket) give each bucket's offset (a running sum over at most 16^BUCKET_HEX
rows a split), and rows are numbered only inside (split, bucket). Ids are right-padded with the pad id,
labels with -100 and the attention mask with 0, up to the longest row *of the batch*.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hash_bucket, shuffle_hash
from ..functions.tokens import IGNORE_INDEX
from ..plans.small import null_safe_join

BUCKET_HEX = 4


def pad_batches(df: DataFrame, key: str, size: int = 2, pad: int = 0, seed=42, split: str = "split",
                ids: str = "input_ids", labels: str = "labels", salt: str = "batch") -> DataFrame:
    """Adds ``batch`` (0, 1, ... in each split) and ``batch_len``, pads ``ids``/``labels`` and adds
    ``attention_mask``."""
    d = df.withColumn("_tf_h", shuffle_hash(key, seed, salt)).withColumn("_tf_b", hash_bucket("_tf_h", BUCKET_HEX))
    counts = d.groupBy(split, "_tf_b").agg(F.count(F.lit(1)).alias("_tf_c"))
    before = Window.partitionBy(split).orderBy("_tf_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(split, "_tf_b", F.coalesce(F.sum("_tf_c").over(before), F.lit(0)).alias("_tf_off"))
    inside = Window.partitionBy(split, "_tf_b").orderBy("_tf_h", F.col(key).cast("string"))
    d = d.withColumn("_tf_rn", F.row_number().over(inside) - 1)
    d = null_safe_join(d, offsets, [split, "_tf_b"])
    d = d.withColumn("batch", F.floor((F.col("_tf_off") + F.col("_tf_rn")) / int(size)).cast("long"))
    wb = Window.partitionBy(split, "batch")
    d = d.select("*", F.max(F.size(ids)).over(wb).alias("batch_len"), F.max(F.size(labels)).over(wb).alias("_tf_llen"))
    gap = F.col("batch_len") - F.size(ids)
    lgap = F.col("_tf_llen") - F.size(labels)
    return (d.withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), gap)))
            .withColumn(labels, F.concat(F.col(labels), F.array_repeat(F.lit(IGNORE_INDEX), lgap)))
            .withColumn(ids, F.concat(F.col(ids), F.array_repeat(F.lit(int(pad)), gap)))
            .drop("_tf_h", "_tf_b", "_tf_rn", "_tf_off", "_tf_llen"))
