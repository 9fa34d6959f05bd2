"""Exact seeded splits, samples, caps and holdout: arithmetic, invariants, determinism."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tuneforge.functions.keys import shuffle_hash
from tuneforge.operators import split
from tuneforge.sources import tables as T

from .conftest import SF_MID


def _rows(spark, n, sources=("a", "b")):
    data = [(s, f"{s}{i}", i) for s in sources for i in range(n)]
    return spark.createDataFrame(data, "source string, row_key string, v int")


def _oracle_first(df, key, seed, salt, by, k_of_n):
    """Global row_number reference: first k per group in (hash, key) order."""
    h = shuffle_hash(key, seed, salt)
    w = Window.partitionBy(*by).orderBy(h, F.col(key).cast("string"))
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    return df.withColumn("_first", F.row_number().over(w) <= k_of_n(n))


def test_ratio_arithmetic():
    # n = 10, ratio 0.7: floor_train gives 7/3, ceil_valid gives 6/4 (1 - 0.7 = 0.30000000000000004)
    assert math.floor(10 * 0.7) == 7
    assert split.holdout_sizes(10, 0.7) == (6, 4)
    assert split.holdout_sizes(1000, 0.7) == (699, 301)
    assert split.holdout_sizes(1000, 0.8) == (800, 200)


@pytest.mark.parametrize("mode,expect", [("floor_train", (7, 3)), ("ceil_valid", (6, 4))])
def test_split_sizes_small(spark, mode, expect):
    df = _rows(spark, 10, ("a",))
    out = split.exact_split(df, "row_key", 0.7, 42, by=["source"], mode=mode)
    got = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert (got.get("train", 0), got.get("valid", 0)) == expect


@pytest.mark.parametrize("ratio", [0.0, 0.8, 1.0])
def test_split_equals_global_row_number(spark, ratio):
    df = _rows(spark, 700)
    got = split.exact_split(df, "row_key", ratio, 7, by=["source"], salt="s")
    ref = _oracle_first(df, "row_key", 7, "s", ["source"], lambda n: F.floor(n * F.lit(ratio)))
    a = {(r.source, r.row_key): r.split == "train" for r in got.collect()}
    b = {(r.source, r.row_key): r._first for r in ref.collect()}
    assert a == b
    assert sum(a.values()) == 2 * math.floor(700 * ratio)


def test_split_checkpoint_path_equals_literal_path(spark, monkeypatch):
    df = _rows(spark, 300, ("a", "b", "c"))
    lit = {tuple(r) for r in split.exact_split(df, "row_key", 0.8, 3, by=["source"]).collect()}
    monkeypatch.setattr(split, "MAX_LITERAL_GROUPS", 1)  # 3 groups: forces checkpoint + join
    big = {tuple(r) for r in split.exact_split(df, "row_key", 0.8, 3, by=["source"]).collect()}
    assert lit == big


def test_split_is_partitioning_independent(spark):
    c = T.corpus(spark, SF_MID)
    a = {tuple(r) for r in split.exact_split(c, "row_key", 0.8, 42, by=["source"]).select("row_key", "split").collect()}
    b = {tuple(r) for r in split.exact_split(c.repartition(13), "row_key", 0.8, 42, by=["source"])
         .select("row_key", "split").collect()}
    assert a == b


def test_split_covers_input_exactly(spark):
    c = T.corpus(spark, SF_MID)
    out = split.exact_split(c, "row_key", 0.8, 42, by=["source"])
    assert out.count() == c.count()
    per = {(r.source, r.split): r["count"] for r in out.groupBy("source", "split").count().collect()}
    for s, n in [("part", 2000), ("documents", 1000)]:
        assert per[(s, "train")] == math.floor(n * 0.8)
        assert per[(s, "train")] + per[(s, "valid")] == n


def test_different_seeds_differ(spark):
    c = T.corpus(spark, SF_MID).withColumn("k", F.concat_ws(":", "source", "row_key"))  # unique key
    a = {r.k for r in split.sample_exact(c, "k", 50, 1).collect()}
    b = {r.k for r in split.sample_exact(c, "k", 50, 2).collect()}
    assert len(a) == len(b) == 50 and a != b


def test_sample_and_cap_sizes(spark):
    df = _rows(spark, 40)
    assert split.sample_exact(df, "row_key", 15, 42, by=["source"]).count() == 30
    assert split.take_capped(df, "row_key", 100, 42).count() == 80  # min(k, n)
    assert split.sample_exact(df, "row_key", 0, 42).count() == 0


def test_positional_split(spark):
    df = _rows(spark, 50, ("a",))
    out = split.positional_split(df, "row_key", 10, 12, ["v"], seed=42)
    rows = out.collect()
    assert len(rows) == 12 and {r.v for r in rows} == set(range(12))
    assert sum(r.split == "train" for r in rows) == 10


def test_require_enough():
    split.require_enough(3, 3)
    with pytest.raises(ValueError):
        split.require_enough(4, 3)


def test_seeded_shuffle_orders_by_hash(spark):
    df = _rows(spark, 30, ("a",))
    keys = [r.shuffle_key for r in split.seeded_shuffle(df, "row_key", 42).collect()]
    assert keys == sorted(keys)


def test_no_single_partition_exchange_in_split(spark):
    c = T.corpus(spark, SF_MID)
    plan = split.exact_split(c, "row_key", 0.8, 42, by=["source"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bad_parameters_raise(spark):
    df = _rows(spark, 5, ("a",))
    with pytest.raises(ValueError):
        split.exact_split(df, "row_key", 1.2, 42, by=["source"])
    with pytest.raises(ValueError):
        split.sample_exact(df, "row_key", -1, 42)


@pytest.mark.parametrize("literal", [True, False])
def test_null_group_is_split_too(spark, monkeypatch, literal):
    rows = [(None if i % 2 else "a", f"k{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "source string, row_key string")
    if not literal:
        monkeypatch.setattr(split, "MAX_LITERAL_GROUPS", 1)
    out = split.exact_split(df, "row_key", 0.5, 42, by=["source"])
    got = {(r.source, r.split): r["count"] for r in out.groupBy("source", "split").count().collect()}
    assert got == {("a", "train"): 10, ("a", "valid"): 10, (None, "train"): 10, (None, "valid"): 10}


@pytest.mark.parametrize("literal", [True, False])
def test_duplicate_keys_at_the_cut_raise(spark, monkeypatch, literal):
    df = spark.createDataFrame([("a", "same")] * 10, "source string, row_key string")
    if not literal:
        monkeypatch.setattr(split, "MAX_LITERAL_GROUPS", 0)
    with pytest.raises(ValueError, match="not unique"):
        split.exact_split(df, "row_key", 0.5, 42, by=["source"])


@pytest.mark.parametrize("literal", [True, False])
def test_split_totals_match_counts(spark, monkeypatch, literal):
    df = _rows(spark, 37, ("a", "b", "c"))
    if not literal:
        monkeypatch.setattr(split, "MAX_LITERAL_GROUPS", 1)
    totals = {}
    out = split.exact_split(df, "row_key", 0.7, 42, by=["source"], totals=totals)
    got = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert split.split_sizes(totals) == (got["train"], got["valid"]) == (3 * 25, 3 * 12)


@pytest.mark.parametrize("literal", [True, False])
def test_empty_input(spark, monkeypatch, literal):
    df = _rows(spark, 3).where("v < 0")
    if not literal:
        monkeypatch.setattr(split, "MAX_LITERAL_GROUPS", 0)
    totals = {}
    assert split.exact_split(df, "row_key", 0.8, 42, by=["source"], totals=totals).count() == 0
    assert totals == {"n": 0, "k": 0}
    assert split.sample_exact(df, "row_key", 5, 42).count() == 0


def test_duplicates_away_from_the_cut_are_fine(spark):
    rows = [("a", f"k{i}") for i in range(20)] + [("a", "k3")] * 2  # a run of three equal keys
    df = spark.createDataFrame(rows, "source string, row_key string")
    h = {r.row_key: r.h for r in df.select("row_key", shuffle_hash("row_key", 42, "split").alias("h")).distinct().collect()}
    order = sorted(set(h), key=lambda k: (h[k], k))
    pos = order.index("k3")  # rows before k3's run, the run itself, then the rest
    ratio_k = pos + 3 if pos + 3 <= 22 else pos  # a cut right after the run (or right before it)
    out = split.first_k(df, "row_key", split.absolute(ratio_k), 42, "split", ["source"]).where("_tf_first")
    assert out.count() == ratio_k
