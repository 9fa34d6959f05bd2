"""Toxicity scoring by a factorization machine over hashed terms.

A text's features are its distinct lower-cased words, their first 3, 4 and 5 and last 4 letters, hashed
into 2^``bits`` slots; x_i is the absolute log ratio of the slot's document frequencies in the two classes
of the fitted sample, scaled to at most 1, and 0 where fewer than ``LEAST_DF`` sampled texts have it or the
two frequencies differ by less than ``least_z`` standard errors. score = sigmoid(bias + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j): the factors v learn
interactions of two terms (an insult next to a group's name) that additive weights miss. Nothing but the
text enters a score.

Fitting uses a bounded sample: the ``max_fit`` labelled rows (default 8,000) smallest by a seeded hash
of their id; texts are read whole. Scoring covers every row, in one pass without a shuffle; the model has
a fixed size (2^bits x (2 + rank) numbers) whatever the corpus.

Defined cases: null and empty texts have no terms and score sigmoid(bias); repeated rows score alike;
labels without text or with a null label are not fitted on; with no labelled rows, or labels of one
kind only, the bias alone decides (0.5, or the share of ones, smoothed). Clashing extra columns are
not read."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordcode import release_memory

WORDS = re.compile(r"\w+")
MAX_FIT = 8_000
LEAST_DF = 3


def _slot(term: str, mask: int) -> int:
    return (zlib.crc32(term.encode("utf-8", "surrogatepass")) * 0x9E3779B1 >> 7) & mask


class _Slots(dict):
    """word -> slots of its terms: the word, its first 3, 4 and 5 letters and its last 4."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word):
        if len(self) > 150_000:  # a cache only: forget, never grow with the corpus
            self.clear()
        terms = {word + "."} | {word[:k] for k in (3, 4, 5) if len(word) > k} | ({"." + word[-4:]} if len(word) > 4 else set())
        slots = self[word] = [_slot(t, self.mask) for t in sorted(terms)]
        return slots


def terms_of(text: str | None, slots: _Slots) -> np.ndarray:
    """The distinct slots of a text's terms, ascending."""
    words = set(WORDS.findall((text or "").lower()))
    return np.unique(np.fromiter(chain.from_iterable(map(slots.__getitem__, words)), np.int32))


@dataclass
class Machine:
    bias: float
    x: np.ndarray  # (2^bits,) weight of a slot as a feature; 0: not in the fitted sample often enough
    w: np.ndarray  # (2^bits,)
    v: np.ndarray  # (2^bits, rank)
    bits: int

    def margin(self, own: np.ndarray) -> float:
        own = own[self.x[own] > 0]
        x = self.x[own]
        vx = self.v[own] * x[:, None]
        s = vx.sum(0)
        return self.bias + float(self.w[own] @ x) + 0.5 * float(s @ s - (vx * vx).sum())


def fit(texts: list[str | None], y: list[int], bits: int = 18, rank: int = 8, epochs: int = 15, batch: int = 64,
        rate: float = 0.2, decay: float = 1e-5, seed: int = 7, least_z: float = 4.0) -> Machine:
    """Adagrad on the log loss, rows in a seeded order. Ones weigh sqrt(zeros / ones), halfway to balance: with a
    rare label the few telling terms still count, and a text without any scores below 0.5."""
    rng = np.random.default_rng(seed)
    size = 1 << bits
    y = np.asarray(y, np.float64)
    p = (y.sum() + 1) / (len(y) + 2)
    m = Machine(float(np.log(p / (1 - p))), np.zeros(size), np.zeros(size), np.zeros((size, rank)), bits)
    if not 0 < y.sum() < len(y):
        return m
    slots = _Slots(bits)
    rows = [terms_of(t, slots) for t in texts]
    ones, n1 = np.bincount(np.concatenate([r for r, k in zip(rows, y, strict=True) if k]), minlength=size), y.sum()
    zeros, n0 = np.bincount(np.concatenate([r for r, k in zip(rows, y, strict=True) if not k]), minlength=size), len(y) - y.sum()
    both = (ones + zeros) / len(y)
    z = (ones / n1 - zeros / n0) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n1 + 1 / n0))
    ratio = np.abs(np.log((ones + 0.5) / (n1 + 1)) - np.log((zeros + 0.5) / (n0 + 1)))
    use = (ones + zeros >= LEAST_DF) & (np.abs(z) >= least_z)
    m.x = np.where(use, ratio / max(ratio[use].max(initial=0), 1e-9), 0.0)
    m.v = np.where(use[:, None], rng.normal(0, 0.01, (size, rank)), 0.0)
    rows = [r[m.x[r] > 0] for r in rows]
    gw, gv, gb = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    weight = np.where(y == 1, np.sqrt(n0 / n1), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            bare = part[[not len(rows[i]) for i in part]]
            g_bare = float((weight[bare] * (1 / (1 + np.exp(-m.bias)) - y[bare])).sum()) / len(part)
            gb += g_bare ** 2
            m.bias -= rate * g_bare / np.sqrt(gb)
            part = part[[len(rows[i]) > 0 for i in part]]
            if not len(part):
                continue
            n = np.array([len(rows[i]) for i in part])
            slot, inverse = np.unique(np.concatenate([rows[i] for i in part]), return_inverse=True)
            x = m.x[slot][inverse]
            cut = np.cumsum(n) - n
            row = np.repeat(np.arange(len(part)), n)
            vx = m.v[slot][inverse] * x[:, None]
            s = np.add.reduceat(vx, cut)
            z = m.bias + np.add.reduceat(m.w[slot][inverse] * x, cut) + 0.5 * (
                (s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), cut))
            g = weight[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            gx = g[row] * x
            dw = np.bincount(inverse, gx, len(slot)) + decay * m.w[slot]
            pull = gx[:, None] * (s[row] - vx)
            dv = np.stack([np.bincount(inverse, pull[:, k], len(slot)) for k in range(rank)], 1) + decay * m.v[slot]
            gw[slot] += dw * dw
            gv[slot] += dv * dv
            gb += g.sum() ** 2
            m.w[slot] -= rate * dw / np.sqrt(gw[slot])
            m.v[slot] -= 0.2 * rate * dv / np.sqrt(gv[slot])
            m.bias -= rate * float(g.sum()) / np.sqrt(gb)
    del rows, slots
    release_memory()
    return m


def fit_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", max_fit: int = MAX_FIT) -> list:
    """The sample of at most ``max_fit`` (text, label) rows a model is fitted on, however often an id is
    repeated: those first by a seeded hash of id and text. Only ids (at most ``max_fit``) are broadcast, so
    texts are never shuffled; a task hands on its own first ``max_fit`` rows at most."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
             .orderBy(F.xxhash64(F.lit("fit"), "_id"), "_id").limit(max_fit))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = (texts.join(F.broadcast(known), "_id").select("_id", "_text", "_y")
            .orderBy(F.xxhash64(F.lit("row"), "_id", "_text"), "_id", "_text").limit(max_fit).collect())
    rows = sorted(rows, key=lambda r: (r["_id"], r["_text"] or ""))
    return [(r["_text"], r["_y"]) for r in rows]


def score(docs: DataFrame, model: Machine, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability of label 1."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(replace(model, x=model.x.astype("f4"), w=model.w.astype("f4"), v=model.v.astype("f4")))

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        slots = _Slots(m.bits)
        for batch in batches:
            z = np.array([m.margin(terms_of(t.as_py(), slots)) for t in batch], np.float64)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
        del slots
        release_memory()

    return docs.withColumn(out, scored(F.col(text_col)))


def held_out(id_col) -> F.Column:
    """Rows never fitted on: crc32 of the id as text leaves remainder 0 by 5."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0
