"""Prompt texts, code-point encoding, label rules and padded batches against Python rules."""

import random

from pyspark.sql import functions as F

from tuneforge.functions import prompts as P
from tuneforge.functions import tokens as K
from tuneforge.operators import batches, sft

PRE = "以下の参考情報から、質問に答えてください。\n\n"


def _one(spark, col, schema, row):
    return spark.createDataFrame([row], schema).select(col.alias("x")).first().x


def test_context_qa_prompt_nulls_render_empty(spark):
    got = _one(spark, P.context_qa_prompt("i", "c"), "i string, c string", ("Q?", None))
    assert got == PRE + "質問：Q?\n参考情報：\n\n回答："


def test_multi_source_slots_keep_numbers(spark):
    schema = "Input string, Source_1 string, Context_1 string, Source_3 string, Context_3 string, `Context_know-how` string"
    df = spark.createDataFrame([("q", "s1", "c1", "", "c3", "pol")], schema)
    got = df.select(P.own_qa_prompt(df).alias("p")).first().p
    expected = (PRE + "質問：q\n\n参考情報：\n" + "（参考1）s1\nc1\n\n" + "（参考3）\nc3\n\n"
                + "回答の方針：pol\n\n回答：")
    assert got == expected


def test_flatten_and_extractive(spark):
    schema = "c array<struct<title:string, sentences:array<string>>>, q string, a string"
    df = spark.createDataFrame([([("T1", ["a.", "b."]), ("T2", [])], "Who?", "Me")], schema)
    row = df.select(P.flatten_context("c").alias("f"),
                    P.extractive_prompt(P.flatten_context("c"), "q", "a").alias("e")).first()
    assert row.f == "T1\na. b.\n\nT2\n"
    assert row.e == "Context:\nT1\na. b.\n\nT2\n\nQuestion:\nWho?\nAnswer:\nMe"


def test_codepoints_match_python(spark):
    texts = ["", "abc", "é　x", "a😀b\n", "\u001f\t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.ids for r in df.select(K.codepoint_ids("t").alias("ids")).collect()]
    assert got == [[ord(ch) for ch in t] for t in texts]


def test_encode_fixed_and_labels_match_python_rules(spark):
    rnd = random.Random(0)
    L, pad = 12, 0
    rows = []
    for _ in range(200):
        ids = [rnd.randint(1, 50) for _ in range(rnd.randint(0, 20))]
        ans = [rnd.randint(1, 50) for _ in range(rnd.randint(0, 8))]
        n = rnd.randint(0, 15)
        rows.append((ids, ans, n))
    df = spark.createDataFrame(rows, "ids array<int>, a array<int>, n int")
    fixed, mask = K.encode_fixed("ids", L, pad)
    out = df.select(fixed.alias("f"), mask.alias("m"), "a", "n", "ids").select(
        "f", "m", "ids", K.label_joint("f", F.col("n"), L).alias("lj"),
        K.label_after_prompt("f", "a", pad, L).alias("lap"), K.label_all("f", "m", True).alias("lm")).collect()
    for r, (ids, ans, n) in zip(out, rows):
        f = (ids[:L] + [pad] * L)[:L]
        assert r.f == f
        assert r.m == [1] * min(len(ids), L) + [0] * (L - min(len(ids), L))
        assert r.lj == ([-100] * n + f[n:])[:L]
        lab = [-100] * L
        start = sum(1 for t in f if t != pad)
        for i, t in enumerate(ans[:L]):
            if start + i < L:
                lab[start + i] = t
        assert r.lap == lab
        assert r.lm == [t if m == 1 else -100 for t, m in zip(f, r.m)]


def test_truncated_prompt_leaves_no_supervision(spark):
    df = spark.createDataFrame([("x" * 30, "yes")], "p string, a string")
    r = sft.sft_encode(df, F.col("p"), F.col("a"), eos=2, max_len=16).first()
    assert len(r.input_ids) == len(r.labels) == 16
    assert set(r.labels) == {-100} and r.n_supervised == 0


def test_sft_labels_mask_prompt_and_keep_eos(spark):
    df = spark.createDataFrame([("ab", "c")], "p string, a string")
    r = sft.sft_encode(df, F.col("p"), F.col("a"), eos=2, max_len=16).first()
    assert r.input_ids == [97, 98, 99, 2]
    assert r.labels == [-100, -100, 99, 2] and r.n_supervised == 2


def test_pad_batches_equal_length_per_batch(spark):
    rnd = random.Random(1)
    rows = [(f"k{i}", "train" if i % 4 else "valid", [1] * rnd.randint(1, 9)) for i in range(60)]
    df = spark.createDataFrame(rows, "row_key string, split string, input_ids array<int>")
    df = df.withColumn("labels", F.col("input_ids"))
    out = batches.pad_batches(df, "row_key", size=3, pad=0).collect()
    groups = {}
    for r in out:
        groups.setdefault((r.split, r.batch), []).append(r)
    for rs in groups.values():
        assert len(rs) <= 3
        lens = {len(r.input_ids) for r in rs} | {len(r.labels) for r in rs} | {len(r.attention_mask) for r in rs}
        assert len(lens) == 1
        for r in rs:
            n = sum(r.attention_mask)
            assert r.input_ids[n:] == [0] * (len(r.input_ids) - n)
            assert r.labels[n:] == [-100] * (len(r.labels) - n)
    assert len(out) == 60


def test_many_splits_batch_alike(spark):
    rows = [(f"k{i}", None if i % 70 == 69 else f"s{i % 70}", [1]) for i in range(70 * 5)]
    df = spark.createDataFrame(rows, "row_key string, split string, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    out = batches.pad_batches(df, "row_key", size=2).groupBy("split", "batch").count().collect()
    sizes = {}
    for r in out:
        sizes.setdefault(r.split, []).append((r.batch, r["count"]))
    assert len(sizes) == 70 and all(sorted(v) == [(0, 2), (1, 2), (2, 1)] for v in sizes.values())


def test_flatten_context_ignores_odd_items(spark):
    row = spark.sql("""SELECT array(named_struct('title', 't', 'sentences', array('a', 'b')), null,
                                    named_struct('title', 'u', 'sentences', array('c'))) AS s,
                              array(array('t', 'p', 'x'), null, array('short'), array('u', 'q')) AS p""").select(
        P.flatten_context("s").alias("s"), P.flatten_context_pairs("p").alias("p")).first()
    assert row.s == "t\na b\n\nu\nc" and row.p == "t\np\n\nu\nq"


def test_batches_are_full_but_the_last(spark):
    rows = [(f"k{i}", "train" if i % 5 else "valid", [1] * (1 + i % 7)) for i in range(103)]
    df = spark.createDataFrame(rows, "row_key string, split string, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    out = batches.pad_batches(df, "row_key", size=4).groupBy("split", "batch").count().collect()
    for s in ("train", "valid"):
        sizes = sorted((r.batch, r["count"]) for r in out if r.split == s)
        assert all(c == 4 for _b, c in sizes[:-1]) and 1 <= sizes[-1][1] <= 4
        assert [b for b, _c in sizes] == list(range(len(sizes)))
