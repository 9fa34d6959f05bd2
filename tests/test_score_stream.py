"""Scoring with a user function, echo stripping, the streaming log, user tokenizers."""

import os

import pandas as pd
from pyspark.sql import functions as F

from tuneforge.functions.text import py_strip, strip_echo
from tuneforge.functions.tokenizer import byte_level_tokenizer_json, tokenizer_ids
from tuneforge.operators.score import result_rows, score
from tuneforge.streaming.score_stream import score_stream

WS = ["  a  ", "　b　", "\x1c\x1dc\x1e\x1f", "\t\nd\r\x0b\x0c", "\x85e\xa0", " f ", "g", "", "​h"]


def test_py_strip_equals_python(spark):
    df = spark.createDataFrame([(s,) for s in WS], "s string")
    got = [r.x for r in df.select(py_strip("s").alias("x")).collect()]
    assert got == [s.strip() for s in WS]


def test_strip_echo(spark):
    df = spark.createDataFrame([("P:", "P:  out 　"), ("P:", "other"), ("é", "éé ")], "p string, g string")
    got = [r.x for r in df.select(strip_echo("g", "p").alias("x")).collect()]
    assert got == ["out", "other", "é"]


def reply(prompts: pd.Series) -> pd.Series:
    return prompts + " -> " + prompts.str.upper()


def test_score_with_loader_once_per_task(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "id int, prompt string").repartition(3)

    def loader():
        return reply

    out = result_rows(score(df, "prompt", loader=loader), "prompt", "generated_text",
                      F.lit("2024-01-02 03:04:05").cast("timestamp"), keep=["id"])
    rows = {r.id: (r.timestamp, r.generated_text) for r in out.collect()}
    assert rows[3] == ("2024-01-02 03:04:05", "-> P3")


def test_stream_appends_only_new_files(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "out", "ckpt"))
    spark.createDataFrame([(1, "a")], "id long, prompt string").write.parquet(os.path.join(src, "b1"))
    schema = "id long, prompt string"
    q = score_stream(spark, os.path.join(src, "*"), schema, "prompt", sink, ckpt, fn=reply, keep=["id"])
    q.awaitTermination()
    spark.createDataFrame([(2, "b")], schema).write.parquet(os.path.join(src, "b2"))
    q = score_stream(spark, os.path.join(src, "*"), schema, "prompt", sink, ckpt, fn=reply, keep=["id"])
    q.awaitTermination()
    rows = sorted((r.id, r.generated_text) for r in spark.read.parquet(sink).collect())
    assert rows == [(1, "-> A"), (2, "-> B")]


def test_byte_level_tokenizer_udf(spark):
    texts = ["héllo wörld", "", "日本語 text", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.ids for r in df.select(tokenizer_ids(spark, "t", byte_level_tokenizer_json()).alias("ids")).collect()]
    assert got == [[3 + b for b in (t or "").encode("utf-8")] for t in texts]


def test_trained_bpe_tokenizer_udf(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tok = Tokenizer(models.BPE(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(["the cat sat on the mat", "the dog sat on the log"] * 20,
                            trainers.BpeTrainer(vocab_size=60, special_tokens=["[UNK]"]))
    texts = ["the cat sat", "a dog on a log", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.ids for r in df.select(tokenizer_ids(spark, "t", tok.to_str()).alias("ids")).collect()]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_tokenizer_truncation_keeps_specials(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers, processors

    vocab = {"[BOS]": 0, "[EOS]": 1, "a": 2, "b": 3, "[UNK]": 4}
    tok = Tokenizer(models.WordLevel(vocab, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.post_processor = processors.TemplateProcessing(single="[BOS] $A [EOS]", special_tokens=[("[BOS]", 0), ("[EOS]", 1)])
    df = spark.createDataFrame([("a b a b a",)], "t string")
    got = df.select(tokenizer_ids(spark, "t", tok.to_str(), add_special_tokens=True, max_length=4).alias("i")).first().i
    assert got == [0, 2, 3, 1]


def test_loaders_of_one_factory_stay_apart(spark):
    def factory(suffix):
        def loader():
            return lambda prompts: prompts + suffix
        return loader

    df = spark.createDataFrame([("p",)], "prompt string")
    got = [score(df, "prompt", loader=factory(s)).first().generated_text for s in ("-A", "-B", "-A")]
    assert got == ["p-A", "p-B", "p-A"]
