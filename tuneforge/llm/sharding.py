"""Sharding by longest-processing-time scheduling: groups that must stay together, sorted by size, go
to the least-loaded shard through a heap.

The heap sees a bounded list, whatever the corpus: each group that holds at least 1 / (``shards`` x
``LARGE_SHARE``) of all bytes is an item of its own (there can be no more than shards x LARGE_SHARE of
them), and all smaller groups are dealt by hash into shards x ``BUNDLES`` bundles, each an item. A
group is never split: all its rows have one digest and so one item.

Defined cases: a null text has no bytes and equals the empty text; repeated rows are rows of one group;
an empty table gives an empty result; a group larger than a shard's share has a shard (nearly) alone."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_running_start, written

LARGE_SHARE = 64
BUNDLES = 256
ROW_BYTES = 16


def least_loaded(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Longest processing time first; ties by item name and by shard number, so reruns agree."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard_groups(rows: DataFrame, shards: int, group: str = "group_key", size: str = "size") -> DataFrame:
    """Add ``shard`` to ``rows``; rows with equal ``group`` (a string, not null) get the same shard."""
    spark = rows.sparkSession
    groups = written(rows.groupBy(group).agg(F.sum(size).alias("_bytes")), "shard-groups")
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    bundle = F.concat(F.lit("bundle-"), F.pmod(F.xxhash64(group), F.lit(shards * BUNDLES)).cast("string"))
    is_large = F.col("_bytes") * (shards * LARGE_SHARE) >= F.lit(total)
    # Bounded by the parameters: at most shards * (LARGE_SHARE + BUNDLES) items.
    items = (groups.withColumn("_item", F.when(is_large, F.concat(F.lit("group-"), F.col(group))).otherwise(bundle))
             .groupBy("_item").agg(F.sum("_bytes").alias("_bytes")))
    placed = least_loaded([(r["_item"], r["_bytes"]) for r in items.collect()], shards)
    schema = "_item string, shard int"
    places = spark.createDataFrame(list(placed.items()), schema)
    large = places.filter(F.col("_item").startswith("group-")).select(
        F.substring("_item", 7, 1 << 20).alias(group), F.col("shard").alias("_own"))
    bundles = places.filter(F.col("_item").startswith("bundle-")).withColumnRenamed("shard", "_shared")
    return (rows.join(F.broadcast(large), group, "left").withColumn("_item", bundle)
            .join(F.broadcast(bundles), "_item", "left")
            .withColumn("shard", F.coalesce("_own", "_shared")).drop("_item", "_own", "_shared"))


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``size`` (UTF-8 bytes of the text plus 16), ``text_crc32``, ``group_key``
    (digest of the text), ``shard`` and ``slot`` (0, 1, ... without gaps inside each shard)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.sha2(text.cast("binary"), 256).alias("group_key"))
    rows = written(rows, "shard-rows")
    placed = shard_groups(rows, shards).withColumn("_one", F.lit(1))
    numbered = with_running_start(placed, ["shard"], ["_id", "group_key"], "_one", "slot")
    return numbered.select(F.col("_id").alias(id_col), "size", "text_crc32", "group_key", "shard", "slot")
