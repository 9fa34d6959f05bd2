import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tuneforge.llm import near_dup
from tuneforge.llm.components import components


def weighted(text, df, n):
    words = [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", w.lower()) for w in (text or "").split()) if w]
    out = {}
    for i in range(max(1, len(words) - 4) if words else 0):
        out[tuple(words[i:i + 5])] = out.get(tuple(words[i:i + 5]), 0) + 1
    idf = {s: 1 + min(1, max(0, np.log(n / df[s]) / np.log(2048))) for s in out} if df else {}
    return {s: (1 + np.log(c)) * idf.get(s, 1) for s, c in out.items()}


def classes_brute(rows, threshold=0.8):
    n, df = len(rows), {}
    for _, t in rows:
        for s in weighted(t, None, 1):
            df[s] = df.get(s, 0) + 1
    sets = [weighted(t, df, n) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            both = sum(min(w, sets[b][s]) for s, w in sets[a].items() if s in sets[b])
            total = sum(sets[a].values()) + sum(sets[b].values()) - both
            same = not sets[a] and not sets[b] and " ".join((rows[a][1] or "").split()) == " ".join((rows[b][1] or "").split())
            if same or (total and both / total >= threshold):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    line = " ".join(rng.choices(vocab, k=30))
    rows, i = [], 0
    for group in (1, 1, 1, 2, 2, 3, 5, 60):
        for _ in range(6 if group < 60 else 1):
            base = rng.choices(vocab, k=rng.randint(60, 250))
            for k in range(group):
                words = list(base)
                for _ in range(0 if k == 0 else rng.choice((0, 1, 1, 2))):
                    words[rng.randrange(len(words))] = rng.choice(vocab)
                rows.append((i, (line + " " if rng.random() < 0.3 and group == 1 else "") + " ".join(words)))
                i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "!!"), (i + 3, " !!\n"), (i + 4, "two words"), (i + 5, "Two, words."), (i + 6, "x " * 30000)]
    return rows


def test_classes_brute_force(spark):
    rows = corpus()
    want = classes_brute(rows)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows] + [(0, rows[0][1], "x", 1), (None, rows[0][1], "x", 1)],
                                 "doc_id long, text string, key string, class long")
    got = near_dup.near_classes(docs.repartition(3)).collect()
    assert len(got) == len(rows) + 2
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    kept = near_dup.near_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {None} == set(want.values())
    assert near_dup.near_classes(docs.limit(0)).count() == 0


def test_texts_that_share_an_id(spark):
    """An id may have a unique text and a near copy of another row: the first stays, the second goes, however the rows are dealt."""
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(4000)]
    rows, unique, copies = [], set(), set()
    for i in range(30):
        base = rng.choices(vocab, k=120)
        near = [*base[:60], "changed", *base[61:]]
        own = " ".join(rng.choices(vocab, k=100))
        rows += [(i, " ".join(base)), (100 + i, " ".join(near)), (100 + i, own)]
        unique.add(own)
        copies.add(" ".join(near))
    for parts in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        kept = {r.text for r in near_dup.near_dedup(docs).collect()}
        assert unique <= kept and not copies & kept and len(kept) == 60


def test_a_passage_that_a_third_share(spark):
    """Texts that share a long passage only are no copies; near copies among them are found."""
    rng = random.Random(12)
    vocab = [f"u{i}" for i in range(5000)]
    passage = rng.choices(vocab, k=90)
    rows = [(i, " ".join((passage if i % 3 == 0 else []) + rng.choices(vocab, k=90 + i % 20))) for i in range(240)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 240, 24)]
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes_brute(rows) and sum(i != c for i, c in got.items()) == 10


def test_prefix_filter_loses_no_pair(spark):
    """Every pair at the threshold meets, whatever the mutual similarity; texts that share seven tenths only do not."""
    rng = random.Random(21)
    vocab = [f"p{i}" for i in range(6000)]
    base, passage, texts = rng.choices(vocab, k=150), rng.choices(vocab, k=120), []
    for i in range(40):  # edits of one text, from equal to far apart
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        texts.append(" ".join(words[:150 - rng.randrange(20)]))
    texts += [" ".join(passage + rng.choices(vocab, k=40)) for _ in range(60)]
    texts += ["one two", "one two", "one two three four five six"]
    table = near_dup.idf_table(np.random.default_rng(4).integers(1, 60, 1 << near_dup.DF_BITS), 103)
    sets = []
    for t in texts:
        own, tf, _ = near_dup.shingles(t, near_dup._Hashes())
        sets.append((own, near_dup.weights(own, tf, table)))
    held = spark.createDataFrame([(i, i, float(w.sum()), 0, 0, 0, 0) for i, (_, w) in enumerate(sets)],
                                 "doc long, class long, weight double, b0 long, b1 long, b2 long, b3 long")
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, _text string")
    met = {(r.a, r.b) for r in near_dup._prefix_pairs(held, rows, spark.sparkContext.broadcast(table), 0.8).collect()}
    alike = {(a, b) for b in range(len(texts)) for a in range(b) if near_dup.similarity(sets[a], sets[b]) >= 0.8}
    assert len(alike) > 50 and alike <= met
    assert not [p for p in met if 40 <= p[0] < 100]
    # Texts of one class do not meet.
    one = held.withColumn("class", F.lit(0).cast("long"))
    assert near_dup._prefix_pairs(one, rows, spark.sparkContext.broadcast(table), 0.8).count() == 0


def test_bits_tell_samples_apart():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, (2000, 64), dtype=np.uint64)
    for alike, few, most in ((0.8, 0.997, 1.0), (0.5, 0.0, 0.08)):
        b = np.where(rng.random(a.shape) < alike, a, rng.integers(0, 1 << 63, a.shape, dtype=np.uint64))
        x = near_dup.sample_bits(a) ^ near_dup.sample_bits(b)
        differ = np.array([int(np.bitwise_or.reduce(r).astype(np.uint64)).bit_count() for r in x])
        assert few <= (differ <= near_dup.UNLIKE).mean() <= most


def test_samples_follow_similarity():
    rng = np.random.default_rng(5)
    own = np.sort(rng.integers(1, 1 << 63, 300, dtype=np.uint64))
    w = rng.uniform(0.5, 3, 300)
    other = w * np.where(rng.random(300) < 0.3, 2.5, 1.0)
    keep = np.sort(rng.choice(300, 260, replace=False))
    truth = near_dup.similarity((own, w), (own[keep], other[keep]))
    s = near_dup.Sampler(3000).sample(np.concatenate([own, own[keep]]), np.log(np.concatenate([w, other[keep]])).astype("f4"),
                                      np.array([300, 260]))
    assert abs((s[0] == s[1]).mean() - truth) < 0.04


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=60))
def test_components(spark, pairs):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent}
