"""One-pass recipe cuts against an exact split per recipe."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tuneforge.operators import recipes, split


def rows_of(spark, n=400):
    src = F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 < 9, F.lit("b"))  # and a null source
    return spark.range(n).select(src.alias("source"), F.concat(F.lit("k"), "id").alias("row_key"), F.col("id").alias("extra"))


def test_equals_exact_split(spark):
    grid = recipes.recipe_list(seed=[42, 7, 42], train_ratio=[0.0, 0.31, 0.8, 1.0])
    df = rows_of(spark)
    got = recipes.each_recipe(recipes.recipe_cut(df, "row_key", grid), grid)
    assert set(got.columns) == {"source", "row_key", "extra", "recipe_id", "seed", "train_ratio", "split"}
    sides = {(r.recipe_id, r.row_key): r.split for r in got.collect()}
    assert len(sides) == 400 * len(grid)
    for recipe in (grid[1], grid[6], grid[7]):
        want = split.exact_split(df, "row_key", recipe["train_ratio"], recipe["seed"], by=["source"]).collect()
        assert {r.row_key: r.split for r in want} == {r.row_key: sides[recipe["recipe_id"], r.row_key] for r in want}
    for recipe in grid:  # by hand
        for source in ("hot", "b", None):
            own = [(r.row_key) for r in df.collect() if r.source == source]
            order = sorted(own, key=lambda k: (hashlib.md5(f"{recipe['seed']}:split:{k}".encode()).hexdigest(), k))
            first = set(order[:math.floor(len(own) * recipe["train_ratio"])])
            assert first == {k for k in own if sides[recipe["recipe_id"], k] == "train"}


def test_coarse_buckets_and_no_groups(spark):
    grid = recipes.recipe_list(seed=[1, 2], train_ratio=[0.5, 0.25])
    df = rows_of(spark, 100)
    for hexes in (1, 4):
        cuts = recipes.recipe_thresholds(df, "row_key", grid, by=[], bucket_hex=hexes)
        out = recipes.recipe_cut(df, "row_key", grid, by=[], thresholds=cuts).collect()
        assert [sum(r.in_train[i] for r in out) for i in range(4)] == [50, 25, 50, 25]


def test_plan_does_not_grow(spark):
    """A thousand recipes have the plan of four, but for the seeds' one literal."""
    df = rows_of(spark, 50)
    sizes = []
    for n in (2, 500):
        grid = recipes.recipe_list(seed=list(range(n)), train_ratio=[0.5, 0.8])
        cuts = recipes.recipe_thresholds(df, "row_key", grid)
        assert recipes.recipe_sizes(cuts, grid).where("n_train + n_valid > 0").count() == 3 * len(grid)
        out = recipes.recipe_cut(df, "row_key", grid, thresholds=cuts)
        assert out.select(F.size("in_train").alias("n")).distinct().collect()[0].n == len(grid)
        sizes.append(out._jdf.queryExecution().analyzed().toString().count("\n"))
    assert sizes[0] == sizes[1]


def test_bad_input(spark):
    df = rows_of(spark, 20)
    with pytest.raises(ValueError, match="empty"):
        recipes.recipe_cut(df, "row_key", [])
    with pytest.raises(ValueError, match="train_ratio"):
        recipes.recipe_cut(df, "row_key", recipes.recipe_list(seed=1, train_ratio=1.5))
    twice = df.select("source", F.lit("same").alias("row_key"))
    with pytest.raises(ValueError, match="unique"):
        recipes.recipe_cut(twice, "row_key", recipes.recipe_list(seed=1, train_ratio=0.5))
    assert recipes.recipe_cut(df.limit(0), "row_key", recipes.recipe_list(seed=1, train_ratio=0.5)).count() == 0
