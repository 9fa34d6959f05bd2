"""Heads by selection against a plain sort."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tuneforge.operators import split
from tuneforge.operators.select_nth import nth_row

KINDS = {
    "long": lambda r: r.choice([None, -2**63, 2**63 - 1, 0, 5, *[r.randint(-2**62, 2**62) for _ in range(3)]]),
    "int": lambda r: r.choice([None, *range(-3, 4)]),
    "double": lambda r: r.choice([None, math.inf, -math.inf, 0.0, 1e308, -1e308, 5e-324, r.gauss(0, 1), r.gauss(0, 1e-9)]),
    "string": lambda r: r.choice([None, "", "a", "a\x00", "a\x00\x00", "abcdef", "abcdefg", "abcdefgh" * 4, "é", "😀" * 3, "common prefix " + str(r.random())]),
    "date": lambda r: r.choice([None, datetime.date(1, 1, 1), datetime.date(9999, 12, 31), datetime.date(2024, 1, 1 + r.randint(0, 27))]),
    "timestamp": lambda r: r.choice([None, datetime.datetime(2024, 1, 1, 0, 0, r.randint(0, 59), r.randint(0, 999999))]),
    "boolean": lambda r: r.choice([None, True, False]),
}


@pytest.mark.parametrize("kind", KINDS)
def test_equals_a_sort(spark, kind):
    r = random.Random(kind)
    rows = [(KINDS[kind](r), r.choice("xyz"), i) for i in range(600)]
    df = spark.createDataFrame(rows, f"v {kind}, w string, id long").repartition(5)
    order = ["v", "w", "id"]
    want = [x.id for x in df.orderBy(*order).collect()]
    for n in ((41, 301) if kind in ("long", "double", "string") else (301,)):
        got = {x.id for x in split.bounded_head(df, n, order, rows=40).collect()}
        assert got == set(want[:n]), n


def test_ties_need_a_key(spark):
    df = spark.range(500).select(F.lit(1).alias("a"), (F.col("id") % 2).alias("b"), "id")
    with pytest.raises(ValueError, match="row key"):
        split.bounded_head(df, 100, ["a", "b"], rows=10)
    assert split.bounded_head(df, 250, ["b", "a", "id"], rows=10).agg(F.max("b")).first()[0] == 0
    with pytest.raises(TypeError):
        nth_row(df.select(F.array("id").alias("x")), 100, ["x"], 10)
    assert split.bounded_head(df, 500, ["id"], rows=8).count() == split.bounded_head(df, 10_000, ["id"], rows=8).count() == 500
    assert split.bounded_head(df.limit(0), 100, ["id"], rows=10).count() == 0


def test_no_task_gathers_the_head(spark):
    df = spark.range(4000).withColumn("k", F.col("id") * 7919 % 4001)
    out = split.bounded_head(df, 2000, ["k"], rows=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Limit" not in plan and "Sort" not in plan and out.count() == 2000


def test_positional_split_of_a_large_head(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("source"), F.col("id").cast("string").alias("key"))
    out = split.positional_split(df, "key", 700, 1500, ["source"], rows=100)
    counts = {(r.split): r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 700, "valid": 800}
    assert {r.source for r in out.select("source").distinct().collect()} == {0, 1} and out.where("source = 1").count() == 500
