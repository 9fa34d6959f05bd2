import random
import zlib

import numpy as np

from tuneforge.llm import queries, toxicity

from ..conftest import SF_SMALL


def corpus(n, seed):
    """Label 1 where an insult meets a group's name; either alone is harmless."""
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(plain, k=20) + ["jerks"] * insult + ["martians"] * group
        rng.shuffle(words)
        rows.append((" ".join(words), int(insult and group)))
    return rows


def test_interaction_is_learned():
    train, test = corpus(1500, 1), corpus(400, 2)
    m = toxicity.fit([t for t, _ in train], [y for _, y in train], epochs=20)
    slots = toxicity._Slots(m.bits)
    right = sum((m.margin(toxicity.terms_of(t, slots)) >= 0) == bool(y) for t, y in test)
    assert right >= 0.97 * len(test)


def test_margin_is_the_plain_sum_over_pairs():
    train = corpus(600, 3)
    m = toxicity.fit([t for t, _ in train], [y for _, y in train], epochs=5)
    slots = toxicity._Slots(m.bits)
    for text, _ in corpus(40, 4) + [("", 0), ("jerks martians", 1), ("unseen only", 0)]:
        own = toxicity.terms_of(text, slots).tolist()
        want = m.bias + sum(m.w[i] * m.x[i] for i in own)
        for k, i in enumerate(own):
            for j in own[k + 1:]:
                want += sum(m.v[i, r] * m.v[j, r] for r in range(m.v.shape[1])) * m.x[i] * m.x[j]
        assert abs(m.margin(np.array(own, np.int32)) - want) < 1e-9 * max(1, abs(want))


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x " * 50000, "c"), (3, "x " * 50000, "c"), (None, "y", "d")],
                                 "doc_id long, text string, score_ string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    for given in (none, labels):
        rows = toxicity.fit_rows(docs, given)
        m = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
        got = toxicity.score(docs, m).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if not r.text}) == 1
    assert toxicity.score(docs.limit(0), m).count() == 0
    assert len(toxicity.fit_rows(docs, labels, max_fit=1)) <= 1
    hot = spark.range(5000).selectExpr("1L AS doc_id", "concat('t', id % 7) AS text")  # one id holds all rows
    first = toxicity.fit_rows(hot.repartition(3), labels, max_fit=20)
    assert len(first) == 20 and first == toxicity.fit_rows(hot.repartition(5), labels, max_fit=20)
    assert len(toxicity.fit_rows(hot, labels, max_fit=10_000)) == 5000


def test_held_out_and_accuracy(spark):
    got = queries.QUERIES["op9_toxicity"](spark, SF_SMALL.replace("0.001", "0.1")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    y = {r.doc_id: r.toxic for r in spark.read.parquet(SF_SMALL.replace("0.001", "0.1") + "/labels.parquet").collect()}
    held = [r for r in got if r.held_out and r.doc_id in y]
    assert sum(r.predicted == y[r.doc_id] for r in held) >= 0.97 * len(held)
