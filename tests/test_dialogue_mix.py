"""Dialogue pairing rules, value anti-join, dialogue mix sufficiency and leakage."""

import pytest
from pyspark.sql import functions as F

from tuneforge.operators import dialogue, mix, split
from tuneforge.plans import q_dialogue as Q
from tuneforge.sources import tables as T

from .conftest import SF_MID

U_SCHEMA = "dlg string, pos int, turn_num int, utterance string"


def _pairs(spark, rows):
    df = spark.createDataFrame(rows, U_SCHEMA)
    return sorted(tuple(r) for r in dialogue.pair_turns(df).collect())


def test_three_turns_one_pair(spark):
    got = _pairs(spark, [("d", 0, 1, "a"), ("d", 1, 2, "b"), ("d", 2, 3, "c")])
    assert got == [("d", 1, "a", "b")]


def test_pair_rule_by_count(spark):
    # turns 1, 3, 4: n = 3, only i = 1 is tried, and turn 2 is missing -> no pair
    assert _pairs(spark, [("d", 0, 1, "a"), ("d", 1, 3, "c"), ("d", 2, 4, "d")]) == []


def test_duplicate_turn_first_wins(spark):
    got = _pairs(spark, [("d", 0, 1, "first"), ("d", 1, 1, "second"), ("d", 2, 2, "b")])
    assert got == [("d", 1, "first", "b")]


def test_null_utterance_skipped_and_null_first_wins(spark):
    assert _pairs(spark, [("d", 0, 1, None), ("d", 1, 2, "b")]) == []
    # a null first utterance still wins over a later non-null one
    assert _pairs(spark, [("d", 0, 1, None), ("d", 1, 1, "x"), ("d", 2, 2, "b")]) == []


def test_first_utterance(spark):
    df = spark.createDataFrame([("d", 5, 1, "late"), ("d", 0, 1, None), ("d", 2, 2, "b")], U_SCHEMA)
    got = {r.turn_num: r.utterance for r in dialogue.first_utterance(df).collect()}
    assert got == {1: None, 2: "b"}


def test_renumber_after_leading_system(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
                                (2, 0, "user", "u2"), (2, 1, "assistant", "a2")], "c long, t long, role string, x string")
    got = sorted((r.c, r.turn_num) for r in dialogue.renumber_after_leading(df, "c", "t", "role").collect())
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_value_anti_join_removes_all_equal_pairs(spark):
    pool = spark.createDataFrame([("k1", "q", "a"), ("k2", "q", "a"), ("k3", "q", "a"), ("k4", "q", None),
                                  ("k5", "r", "b")], "row_key string, input string, output string")
    sampled = pool.where(F.col("row_key") == "k2")
    assert sorted(r.row_key for r in mix.exclude_sampled(pool, sampled).collect()) == ["k4", "k5"]
    nulls = pool.where(F.col("row_key") == "k4")  # null-safe: the null-output pair matches itself
    assert sorted(r.row_key for r in mix.exclude_sampled(pool, nulls).collect()) == ["k1", "k2", "k3", "k5"]


def test_mix_sizes_and_no_leak(spark):
    base = split.exact_split(Q.labels_base(spark, SF_MID), "row_key", 0.8, 42, by=["source"])
    pool = Q.pairs(spark, SF_MID).select("row_key", "input", "output")
    out = mix.mix_in(base, pool, "row_key", 0.3, 42)
    counts = {(r.split, r.origin): r["count"] for r in out.groupBy("split", "origin").count().collect()}
    assert counts[("train", "base")] == 319 and counts[("valid", "base")] == 80
    assert counts[("train", "pool")] == 95 and counts[("valid", "pool")] == 24
    t = out.where("origin = 'pool' AND split = 'train'").select("input", "output")
    v = out.where("origin = 'pool' AND split = 'valid'").select("input", "output")
    assert t.intersect(v).count() == 0


def test_mix_raises_when_pool_too_small(spark):
    base = split.exact_split(T.text_records(spark, SF_MID), "row_key", 0.8, 42, by=["source"])
    pool = Q.pairs(spark, SF_MID).select("row_key", "input", "output")
    with pytest.raises(ValueError, match="Not enough"):
        mix.mix_in(base, pool, "row_key", 0.3, 42)


def test_recipe_grid_order():
    from tuneforge.operators.recipes import recipe_list

    grid = recipe_list(seed=[42, 7], train_ratio=[0.8, 0.7], lr=1e-4)
    assert [(r["recipe_id"], r["seed"], r["train_ratio"]) for r in grid] == [
        (1, 42, 0.8), (2, 42, 0.7), (3, 7, 0.8), (4, 7, 0.7)]
    assert all(r["lr"] == 1e-4 for r in grid)
