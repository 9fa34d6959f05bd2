"""Recipe sweeps (J4): the Cartesian product of parameter lists, applied to rows.

The grid comes from the caller's parameter lists (a handful of values), so its size is known
before any data is read. Rows meet recipes through ``explode`` of a literal array of recipe
structs: a Generate node in the row's own task, no join and no shuffle. All recipes of a sweep
are then split in one job, grouped by ``recipe_id``.

``recipe_cut`` splits by all recipes of a sweep without multiplying the rows: one hash per row and seed, a written
table of one threshold per (group, recipe), and one array of labels per row. Recipes are rows of that table, so
the plan is the same for four recipes and for thousands.
"""

from __future__ import annotations

import itertools

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import hash_bucket
from ..plans.small import attach_stats
from ..session import materialize

CUT_HEX = 4  # a boundary bucket holds about n / 65,536 rows of a group


def recipe_list(**lists) -> list[dict]:
    """Cartesian product; scalars become one-element lists; the last parameter varies fastest;
    ``recipe_id`` counts from 1."""
    keys = list(lists)
    vals = [v if isinstance(v, (list, tuple)) else [v] for v in lists.values()]
    grid = [dict(zip(keys, combo)) for combo in itertools.product(*vals)]
    return [{"recipe_id": i, **r} for i, r in enumerate(grid, start=1)]


def recipe_grid(spark: SparkSession, **lists) -> DataFrame:
    """The grid as a small DataFrame (for reports and joins by recipe_id)."""
    return spark.createDataFrame(recipe_list(**lists))


def apply_recipes(df: DataFrame, recipes: list[dict]) -> DataFrame:
    """Every row once per recipe, with the recipe's parameters as columns."""
    if not recipes:
        raise ValueError("empty recipe list")
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in recipes]
    return df.withColumn("_tf_recipe", F.explode(F.array(*structs))).select("*", "_tf_recipe.*").drop("_tf_recipe")


def _hashes(recipes: list[dict], key: str, salt: str) -> Column:
    """One seeded hash per distinct seed, as an array. The seeds are one literal string, however many."""
    seeds = F.split(F.lit(",".join(str(x) for x in _seeds(recipes))), ",")
    return F.transform(seeds, lambda s: F.md5(F.concat_ws(":", s, F.lit(salt), F.col(key).cast("string"))))


def _seeds(recipes: list[dict]) -> list[int]:
    return sorted({int(r["seed"]) for r in recipes})


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def recipe_thresholds(df: DataFrame, key: str, recipes: list[dict], by: Sequence[str] = ("source",), salt: str = "split",
                      ratio: str = "train_ratio", bucket_hex: int = CUT_HEX) -> DataFrame:
    """One row per group ``by``: ``cuts``, an array in recipe order of (pos, seed: place among the distinct seeds, n, k,
    h, key). A row of the group belongs to the first part of a recipe (``k = floor(n * ratio)`` of its ``n`` rows)
    iff its (hash of the seed, key) is at most (h, key); null where k is 0. Written."""
    if not recipes:
        raise ValueError("empty recipe list")
    if any(not 0.0 <= float(r[ratio]) <= 1.0 for r in recipes):
        raise ValueError(f"{ratio} must lie in [0, 1]")
    spark, by, seeds = df.sparkSession, list(by), _seeds(recipes)
    grid = materialize(spark.createDataFrame([(i, seeds.index(int(r["seed"])), float(r[ratio])) for i, r in enumerate(recipes)],
                                             "_tf_pos int, _tf_seed int, _tf_ratio double"))
    gb = by or ["_tf_grp"]
    rows = (df if by else df.withColumn("_tf_grp", F.lit(0))).select(*gb, F.col(key).cast("string").alias("_tf_key"), _hashes(recipes, key, salt).alias("_tf_h"))

    # Counts per (group, seed, bucket of the hash), as running sums; one mark per (group, recipe) at its k.
    buckets = F.transform("_tf_h", lambda h: hash_bucket(h, bucket_hex))
    counts = rows.select(*gb, F.posexplode(buckets).alias("_tf_seed", "_tf_b")).groupBy(*gb, "_tf_seed", "_tf_b").agg(F.count(F.lit(1)).alias("_tf_c"))
    per = Window.partitionBy(*gb, "_tf_seed")
    counts = counts.withColumn("_tf_cum", F.sum("_tf_c").over(per.orderBy("_tf_b").rowsBetween(Window.unboundedPreceding, 0)))
    counts = materialize(counts)
    totals = counts.groupBy(*gb, "_tf_seed").agg(F.max("_tf_cum").alias("_tf_n")).join(grid, "_tf_seed")
    k = F.least(F.col("_tf_n"), F.greatest(F.lit(0), F.floor(F.col("_tf_n").cast("double") * F.col("_tf_ratio")))).cast("long")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    marks = totals.select(*gb, "_tf_seed", k.alias("_tf_at"), F.lit(1).alias("_tf_mark"), "_tf_pos", "_tf_n", none("struct<b: int, before: long>", "_tf_bucket"))
    steps = counts.select(*gb, "_tf_seed", F.col("_tf_cum").alias("_tf_at"), F.lit(0).alias("_tf_mark"), none("int", "_tf_pos"), none("long", "_tf_n"),
                          F.struct(F.col("_tf_b").alias("b"), (F.col("_tf_cum") - F.col("_tf_c")).alias("before")).alias("_tf_bucket"))
    # From the greatest sum down, the last bucket met before a mark is the first whose sum reaches k.
    down = per.orderBy(F.desc("_tf_at"), "_tf_mark").rowsBetween(Window.unboundedPreceding, 0)
    found = steps.unionByName(marks).withColumn("_tf_bucket", F.last("_tf_bucket", ignorenulls=True).over(down)).where("_tf_mark = 1")
    found = materialize(found.select(*gb, "_tf_pos", "_tf_seed", "_tf_n", F.col("_tf_at").alias("_tf_k"), F.col("_tf_bucket.b").alias("_tf_b"),
                                     (F.col("_tf_at") - F.col("_tf_bucket.before")).alias("_tf_rank")))

    # Rows in a boundary bucket are ranked: about n / 16^bucket_hex of each (group, recipe).
    listed = materialize(found.groupBy(*gb).agg(F.collect_list(F.struct("_tf_pos", "_tf_seed", "_tf_b", "_tf_rank")).alias("_tf_cuts")))
    at = lambda h, c: F.get(h, c["_tf_seed"])
    near = _bound(F.col("_tf_h"), lambda h: F.transform(
        F.filter("_tf_cuts", lambda c: hash_bucket(at(h, c), bucket_hex) == c["_tf_b"]),
        lambda c: F.struct(c["_tf_pos"].alias("_tf_pos"), c["_tf_rank"].alias("_tf_rank"), at(h, c).alias("_tf_h"))))
    edge = attach_stats(rows, listed, gb).select(*gb, "_tf_key", F.explode(near).alias("_tf_e")).select(*gb, "_tf_key", "_tf_e.*")
    order = Window.partitionBy(*gb, "_tf_pos").orderBy("_tf_h", "_tf_key")
    same = (F.lead("_tf_h").over(order) == F.col("_tf_h")) & (F.lead("_tf_key").over(order) == F.col("_tf_key"))
    edge = edge.select("*", F.row_number().over(order).alias("_tf_i"), F.coalesce(same, F.lit(False)).alias("_tf_same")).where("_tf_i = _tf_rank")
    edge = materialize(edge.select(*gb, "_tf_pos", "_tf_h", "_tf_key", "_tf_same"))
    if not edge.where("_tf_same").isEmpty():
        raise ValueError(f"key {key!r} is not unique within its group at a cut")
    cut = attach_stats(found, edge.drop("_tf_same"), [*gb, "_tf_pos"], "left")
    cuts = cut.groupBy(*gb).agg(F.array_sort(F.collect_list(F.struct(
        F.col("_tf_pos").alias("pos"), F.col("_tf_seed").alias("seed"), F.col("_tf_n").alias("n"), F.col("_tf_k").alias("k"),
        F.col("_tf_h").alias("h"), F.col("_tf_key").alias("key")))).alias("cuts"))
    return materialize(cuts)


def recipe_cut(df: DataFrame, key: str, recipes: list[dict], by: Sequence[str] = ("source",), salt: str = "split",
               ratio: str = "train_ratio", out: str = "in_train", thresholds: DataFrame | None = None) -> DataFrame:
    """J4 x T2 in one pass: ``df`` with ``out``, an array in recipe order saying in which recipes the row is in the
    training part. Each row is exactly where ``exact_split`` by that recipe's seed and ratio puts it."""
    cuts = recipe_thresholds(df, key, recipes, by, salt, ratio) if thresholds is None else thresholds
    gb = list(by) or ["_tf_grp"]
    rows = df if by else df.withColumn("_tf_grp", F.lit(0))
    k = F.col(key).cast("string")

    def first(h, c):
        own = F.get(h, c["seed"])
        return F.coalesce((own < c["h"]) | ((own == c["h"]) & (k <= c["key"])), F.lit(False))

    labels = _bound(_hashes(recipes, key, salt), lambda h: F.transform("_tf_cuts", lambda c: first(h, c)))
    joined = attach_stats(rows, cuts.withColumnRenamed("cuts", "_tf_cuts"), gb)
    return joined.withColumn(out, labels).drop("_tf_cuts", "_tf_grp")


def each_recipe(df: DataFrame, recipes: list[dict], labels: str = "in_train", out: str = "split") -> DataFrame:
    """Every row once per recipe, with the recipe's parameters and its side in ``out``: the multiplied output of
    ``recipe_cut``, for those who ask for it."""
    grid = materialize(df.sparkSession.createDataFrame([{"_tf_pos": i, **r} for i, r in enumerate(recipes)]))
    rows = df.select(*[c for c in df.columns if c != labels], F.posexplode(labels).alias("_tf_pos", "_tf_first"))
    side = F.when(F.col("_tf_first"), F.lit("train")).otherwise(F.lit("valid"))
    return rows.join(grid, "_tf_pos").withColumn(out, side).drop("_tf_pos", "_tf_first")


def recipe_sizes(thresholds: DataFrame, recipes: list[dict], by: Sequence[str] = ("source",)) -> DataFrame:
    """(by, recipe_id, n_train, n_valid) of a sweep, from the thresholds alone: no pass over the rows."""
    ids = F.split(F.lit(",".join(str(r["recipe_id"]) for r in recipes)), ",")
    return thresholds.select(*by, F.explode("cuts").alias("c")).select(
        *by, F.get(ids, F.col("c.pos")).cast("long").alias("recipe_id"), F.col("c.k").alias("n_train"), (F.col("c.n") - F.col("c.k")).alias("n_valid"))
