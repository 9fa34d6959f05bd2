"""Steps whose memory or longest task must not follow the table: sliced encoding, packed keys, dealt rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from tuneforge.functions import tokenizer as Z
from tuneforge.functions import tokens as K
from tuneforge.plans.layout import spread_rows
from tuneforge.sources import jsonl


class _Bytes:
    """Stands in for a tokenizer: ids are the text's bytes; notes how much it is given at once."""

    def __init__(self):
        self.calls = []

    def encode_batch_fast(self, texts, add_special_tokens):
        self.calls.append([len(t.encode()) for t in texts])
        return [type("E", (), {"ids": list(t.encode())}) for t in texts]


def test_texts_are_encoded_in_slices():
    texts = ["é" * 10_000] * 60 + [None, "", "x" * (Z.SLICE_BYTES + 1), "y"] + [""] * 5 + ["z" * 50_000] * 20
    batches = [pa.array(texts, pa.string()), pa.array([], pa.string()), pa.array(["a", None]).slice(1), pa.array([None], pa.string())]
    tok = _Bytes()
    got = [i for a in Z.encode_batches(tok, iter(batches)) for i in a.to_pylist()]
    assert got == [list((t or "").encode()) for t in [*texts, None, None]]
    assert all(sum(c) <= Z.SLICE_BYTES or sum(map(bool, c)) == 1 for c in tok.calls)


def test_keys_are_counted_in_words(spark):
    keys = [f"file:/a/{f}:{n}" for f in ("x", "y") for n in range(1, 1001)]
    d = spark.createDataFrame([(k, k[8]) for k in keys], "row_key string, folder string").coalesce(1)
    words = jsonl.key_words(d, by=["folder"])
    assert words.count() == 2 * 16  # of 64 keys each, from 0
    assert jsonl.count_keys(words).first()[0] == 2000
    odd = [*keys[:70] * 2, "x:7", "x:07", "x:007", "x:", "x", "7", ":", ":7", "", None, None, "x:-7", "x:" + "9" * 30, "a:b:7"]
    d = spark.createDataFrame([(k, i % 3) for i, k in enumerate(odd)], "row_key string, g int")
    words = jsonl.key_words(d, by=["g"])
    assert words.agg(F.sum("n")).first()[0] == len(odd)
    assert jsonl.count_keys(words).first()[0] == d.agg(F.countDistinct("row_key")).first()[0]
    assert jsonl.count_keys(jsonl.key_words(d.limit(0))).first()[0] == 0


def test_compact_rows_are_dealt_by_number(spark, tmp_path):
    path = str(tmp_path / "part.parquet")  # one row group: a scan gives all rows to one task
    spark.range(4000).select("id", F.lit("name").alias("name")).coalesce(1).write.parquet(path)
    dealt = spread_rows(spark.read.parquet(path), "id", "name", rows_per_task=500)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1000
    assert sorted(r.id for r in dealt.collect()) == list(range(4000))


def test_ids_text_and_labels_equal_the_plain_forms(spark):
    arrays = [[], None, [0], [5, 5], [0, 0, 0], [1, 2, 0, 0], [0, 1, 0, 0], [1, 2, 3], [None, 5, 5], [None], [5, None],
              [5, 5, None, None], [1, None, 2, 0, 0], [-100, -100, 7, 0, 0], [1, 0, 2, 1]]
    d = spark.createDataFrame([(a,) for a in arrays], "a array<int>")
    for r in d.select(K.ids_text("a").alias("got"), F.array_join("a", ",").alias("want")).collect():
        assert r.got == r.want
    pairs = [([1, 2, 3], m) for m in ([1, 1, 0], [1, 0, 1], [1, 1, 1], [0, 0, 0], [2, 1, 0], [1, None, 0])]
    pairs += [([], []), (None, [1]), ([1], None), ([1, None, 3], [1, 1, 0])]
    d = spark.createDataFrame(pairs, "a array<int>, m array<int>")
    want = F.transform("a", lambda x, i: F.when(F.element_at("m", i + 1) == 1, x).otherwise(F.lit(-100)))
    for r in d.select(K.label_all("a", "m").alias("got"), want.alias("want")).collect():
        assert r.got == r.want
