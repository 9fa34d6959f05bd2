"""Centroid clustering of integer vectors with built-in expressions only.

A vector's components become integers ``floor(scale * x)``, so every distance, sum and mean is exact and the
result is the same under any partitioning. In each round ``zip_with`` and ``aggregate`` give a vector's squared
distances to the centroids, which are a literal array in the plan, ``array_min`` of (distance, number) structs
takes the nearest (ties: the smaller number), and one grouped sum per component, combined before its shuffle,
gives each centroid's new place. The driver holds centroids and their sums alone: ``k`` x ``width`` numbers.

Defined cases: vectors that are null, of another width, or hold null or non-finite components are left out;
fewer kept vectors than ``k`` give as many centroids; a table without kept vectors gives an empty result. Repeated rows
are vectors of their own, each returned; of start candidates with one hash the lesser vector comes first, and a
null id starts no centroid. A component beyond +-2^27 after scaling counts as that bound, where squared
distances still fit a long; a cluster's or the table's inertia that does not fit is null. A column named like
one of the result is replaced by it."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

BOUND = 1 << 27


def finite(v: Column, width: int) -> Column:
    """Whether ``v`` has ``width`` components, none of them null, NaN or infinite."""
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) == width) & sound, F.lit(False))


def integers(v: Column, scale: int) -> Column:
    whole = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    return F.transform(v, lambda x: F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), whole(x))).cast("long"))


def literal(centroids: list[list[int]]) -> Column:
    return F.expr("array(" + ", ".join("array(" + ", ".join(f"{x}L" for x in c) + ")" for c in centroids) + ")")


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid."""
    square = lambda a, b: (a - b) * (a - b)
    far = lambda c: F.aggregate(F.zip_with(v, c, square), F.lit(0).cast("long"), lambda s, x: s + x)
    return F.array_min(F.transform(literal(centroids), lambda c, i: F.struct(far(c).alias("distance"), i.alias("cluster"))))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id`` (lower-case hex), in that order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_tf_id").cast("string")), 256)
    return [r[0] for r in vectors.filter("_tf_id is not null").select("_tf_v", h.alias("h")).orderBy("h", "_tf_v").limit(k)
            .select("_tf_v").collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    width = range(len(centroids[0]))
    placed = vectors.select(nearest(F.col("_tf_v"), centroids)["cluster"].alias("c"), "_tf_v")
    sums = placed.groupBy("c").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("_tf_v")[i]).alias(f"s{i}") for i in width])
    out = list(centroids)
    for r in sums.collect():  # a row per centroid at most
        out[r["c"]] = [r[f"s{i}"] // r["n"] for i in width]
    return out


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10,
            width: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    if k < 1 or width < 1:
        raise ValueError(f"k and width must be positive, got {k} and {width}")
    v = F.col(vector_col)
    vectors = written(rows.filter(finite(v, width)).select(F.col(id_col).alias("_tf_id"), integers(v, scale).alias("_tf_v")), "centroid-vectors")
    centroids = first_centroids(vectors, k, seed) or [[0] * width]
    for _ in range(rounds):
        new = moved(vectors, centroids)
        if new == centroids:  # a fixed point: further rounds change nothing
            break
        centroids = new
    placed = vectors.select("_tf_id", nearest(F.col("_tf_v"), centroids).alias("_tf_n"))
    total = placed.groupBy(F.col("_tf_n.cluster").alias("c")).agg(F.sum(F.col("_tf_n.distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r["c"]: int(r["s"]) for r in total.collect()}
    longs = lambda xs: F.array(*[F.lit(x if x < 1 << 63 else None).cast("long") for x in xs])
    digests = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids])
    at = F.col("_tf_n.cluster") + 1
    return placed.select(
        F.col("_tf_id").alias(id_col), F.col("_tf_n.cluster").cast("int").alias("cluster"), F.col("_tf_n.distance").alias("distance"),
        F.element_at(longs([inertia.get(c, 0) for c in range(len(centroids))]), at).alias("cluster_inertia"),
        longs([sum(inertia.values())])[0].alias("inertia"), F.element_at(digests, at).alias("centroid_sha256"))
