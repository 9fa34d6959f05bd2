"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of shingles of five lower-cased words (all its words, if fewer). A shingle weighs
(1 + ln tf) x idf, where idf falls from 2 (in at most one of 2,048 texts) to 1 (in all); document frequencies
are counted over all rows, in ``2^DF_BITS`` hashed counters, a table of fixed size. Improved consistent
weighted sampling draws (shingle, level) samples that two texts share with probability equal to their
weighted Jaccard similarity; ``BANDS`` bands, each of ``ROWS`` of the ``SAMPLES`` samples drawn at random, give the
candidates, of which those whose 64 samples say that they are far below the threshold (``UNLIKE``), or whose
total weights alone keep them below it, are left out before texts meet. Each link is verified by the weighted Jaccard similarity of the whole texts, at least ``threshold``. Classes are the
connected components of the links.

Work in a large bucket: texts with equal words are one node from the start. Then, in rounds, each bucket's
texts outside its largest class are compared with one pivot of that class, so a bucket of n copies costs
about n comparisons. The texts of buckets that still hold several classes meet by an exact prefix filter, not in
all pairs: a text's shingles are put in order, the rarest among these texts first, and only pairs meet whose first
common shingle comes so early in both that what follows can still reach the threshold (``_prefix_pairs``). Texts that
only share a passage differ in their rarest shingles and do not meet; no link is lost by it. That last step is taken
when few pairs are left, pivots link fewer than one text in 20, or after ``MAX_ROUNDS`` rounds.

Defined cases: texts without words are alike only if equal after white space is collapsed; a null text is
empty; a very long text is compared whole; repeated rows are one node; texts that share an id are nodes of their
own, and each stays or goes by itself; rows with a null id are not compared and get a null class; columns
with other names, whatever they are, stay as they are; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .components import components
from .wordcode import pack_arrays, trimmed, unpack_arrays

SHINGLE = 5
THRESHOLD = 0.8
SAMPLES, BANDS, ROWS = 64, 48, 6
# Of two texts at similarity 0.8, 4 bits a sample differ in 12 of 64 samples (deviation 3.1), and in more than 22 for 7
# pairs in 10,000; at 0.5 in 30, and in at most 22 for 3 pairs in 100.
BITS, UNLIKE = 4, 22
DF_BITS = 20
DF_BLOCK = 4096
RARE = 2048.0  # idf stops growing at one text of so many
MAX_ROUNDS = 8
CHUNK = 16_384  # shingles sampled at once, so the arrays stay in the CPU's cache

_edge = re.compile(r"^[\W_]+|[\W_]+$")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


class _Hashes(dict):
    """Word as written -> hash of the word in lower case, without punctuation at its ends; 0 if nothing is left."""

    def __missing__(self, word):
        import xxhash

        if len(self) > 250_000:  # a cache only
            self.clear()
        bare = word.lower()
        if not bare.isalnum():
            bare = _edge.sub("", bare)
        h = self[word] = xxhash.xxh64_intdigest(bare.encode("utf-8", "surrogatepass")) or 1 if bare else 0
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[4]
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, hashes: _Hashes, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(distinct shingle hashes ascending, their counts, digest of the words)."""
    words = (text or "").split()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    h = h[h != 0]
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), hashlib.blake2b(
            b"\x00" + " ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    n = max(1, len(h) - k + 1)
    s = np.zeros(n, np.uint64)
    for i in range(min(k, len(h))):
        s = (s ^ h[i:i + n]) * _MIX[i % 4]
        s ^= s >> np.uint64(31)
    return *np.unique(_mix(s), return_counts=True), hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def weights(own: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1.0 + np.log(tf)) * idf[(own >> np.uint64(64 - DF_BITS)).astype(np.int64)]


def idf_table(df: np.ndarray, n: int) -> np.ndarray:
    return 1.0 + np.clip(np.log(n / np.maximum(df, 1)) / np.log(RARE), 0.0, 1.0)


def _gamma2_quantiles(n: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at (i + 0.5) / n, by bisection of 1 - (1 + x) e^-x."""
    p = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


class Sampler:
    """Improved consistent weighted sampling: of a text's shingles k with weights S, sample j takes the least

        ln a = ln c - r (t - beta + 1),   t = floor(ln S / r + beta)

    with r, c ~ Gamma(2, 1) and beta ~ U(0, 1) drawn by the hash of (k, j), and names it by (k, t). As
    ln c - ln S - r <= ln a, the shingle with the least lower bound is worked out first, and then only those
    whose lower bound is not above its ln a. (r, c) come in 65,536 fixed pairs: each side's quantiles, paired at
    random. Ties go to the smaller hash."""

    def __init__(self, samples: int):
        rng = np.random.default_rng(11)
        gamma = _gamma2_quantiles(1 << 16)
        self.r = rng.permutation(gamma).astype("f4")
        self.log_c = np.log(gamma).astype("f4")
        self.low = self.log_c - self.r
        self.seeds = rng.integers(1, 1 << 63, samples, dtype=np.uint64) | np.uint64(1)

    def sample(self, own: np.ndarray, log_weight: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """(texts, samples) sample ids of texts whose shingles follow each other in ``own``; no empty text."""
        starts = np.cumsum(lens) - lens
        row = np.repeat(np.arange(len(lens)), lens)
        out = np.empty((len(lens), len(self.seeds)), np.uint64)
        slack = np.float32(1e-4)  # for rounding of the bounds

        def drawn(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(t, ln a) of the shingles at these places."""
            beta = ((h[at] >> np.uint64(24)) & np.uint64(0xFFFFFF)).astype("f4") * np.float32(2.0 ** -24)
            r = self.r[pair[at]]
            t = np.floor(log_weight[at] / r + beta)
            return t, self.log_c[pair[at]] - r * (t - beta + np.float32(1))

        def least_of(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Each text's least value and the first place that has it; every text occurs, in order."""
            least = np.minimum.reduceat(value, np.searchsorted(text, np.arange(len(lens))))
            hit = np.flatnonzero(value == least[text])
            return least, hit[np.searchsorted(text[hit], np.arange(len(lens)))]

        for j, seed in enumerate(self.seeds):
            h = own * seed
            pair = (h >> np.uint64(48)).astype(np.intp)
            low = self.low.take(pair, mode="wrap") - log_weight
            at = np.flatnonzero(low == np.repeat(np.minimum.reduceat(low, starts), lens))
            bar, _ = least_of(row[at], drawn(at)[1])
            at = np.flatnonzero(low <= np.repeat(bar + slack, lens))
            t, log_a = drawn(at)
            _, first = least_of(row[at], log_a)
            out[:, j] = _mix(own[at[first]] ^ (t[first].astype(np.int64).view(np.uint64) * _MIX[2]) ^ seed)
        return out


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) keys; a key also names its band. Bands share samples: more bands of more rows than samples
    allow side by side tell unlike texts apart better at the same chance for like ones."""
    rng = np.random.default_rng(13)
    picks = np.stack([rng.choice(samples.shape[1], rows, replace=False) for _ in range(bands)])
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _MIX[3], (len(samples), 1))
    for j in range(rows):
        keys = _mix((keys ^ samples[:, picks[:, j]]) * _MIX[0])
    return keys.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (shingles, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    return both / (float(a[1].sum()) + float(b[1].sum()) - both)


# ---------------------------------------------------------------- Spark


def _count_pass(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(id, hash of the text, digest of the words) of all rows, and the document frequencies of all shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes, df = _Hashes(), np.zeros(1 << DF_BITS, np.int64)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        names = ["_id", "_h", "digest", "block", "salt", "counts"]
        for batch in batches:
            digests = []
            for text in batch.column("_text"):
                own, _, digest = shingles(text.as_py(), hashes)
                digests.append(digest)
                slots = (own >> np.uint64(64 - DF_BITS)).astype(np.int64)  # ascending, as ``own`` is
                df[slots[np.append(True, slots[1:] != slots[:-1])] if len(slots) else slots] += 1
            none = [None] * len(digests)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_h"), *(pa.array(c, k) for c, k in zip(
                (digests, none, none, none), kinds[2:], strict=True))], names=names)
        blocks = [(b, df[b * DF_BLOCK:(b + 1) * DF_BLOCK]) for b in range((1 << DF_BITS) // DF_BLOCK)]
        rows = [(b, pack_arrays(c)) for b, c in blocks if c.any()]
        salt = TaskContext.get().partitionId() % 64
        none = [None] * len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            (none, none, none, [b for b, _ in rows], [salt] * len(rows), [c for _, c in rows]), kinds, strict=True)], names=names)

    counted = written(docs.mapInArrow(trimmed(run), "_id long, _h long, digest binary, block int, salt int, counts binary"), "near-counts")

    def add(group: pa.Table) -> pa.Table:
        total = sum(unpack_arrays(c)[0].astype(np.int64) for c in group["counts"].to_pylist())
        return pa.table({"block": group["block"][:1], "salt": group["salt"][:1], "counts": pa.array([pack_arrays(total)], pa.binary())})

    schema = "block int, salt int, counts binary"
    blocks = counted.filter("block is not null").select("block", "salt", "counts")
    summed = blocks.groupBy("block", "salt").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    df = np.zeros(1 << DF_BITS, np.int64)
    for r in summed.collect():  # 2^DF_BITS / DF_BLOCK rows, whatever the corpus
        df[r["block"] * DF_BLOCK:(r["block"] + 1) * DF_BLOCK] = unpack_arrays(r["counts"])[0]
    return counted.filter("digest is not null").select("_id", "_h", "digest"), df


def sample_bits(samples: np.ndarray) -> np.ndarray:
    """(texts, BITS): bit k of all 64 samples of a text in one integer. Equal samples agree in all of them, unequal ones
    with a chance of 2^-BITS."""
    planes = [np.packbits((samples >> np.uint64(k) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64) for k in range(BITS)]
    return np.concatenate(planes, axis=1)


def unlike(a, b):
    """The number of samples in which two texts' bits differ."""
    differ = None
    for k in range(BITS):
        x = F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))
        differ = x if differ is None else differ.bitwiseOR(x)
    return F.bit_count(differ)


def _signatures(docs: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """(digest, total weight, keys: array of band keys, bits) of the texts that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sampler, table = _Hashes(), Sampler(SAMPLES), idf.value
        digests, own, logs, total = [], [], [], []

        def sampled():
            samples = sampler.sample(np.concatenate(own), np.concatenate(logs), np.array([len(x) for x in own]))
            return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(total, pa.float64()),
                                               pa.array(list(band_keys(samples, bands, rows)), pa.list_(pa.int64())),
                                               pa.array(list(sample_bits(samples)), pa.list_(pa.int64()))], names=["digest", "weight", "keys", "bits"])

        for batch in batches:
            for i, text in zip(batch.column("_id").to_pylist(), batch.column("_text"), strict=True):
                s, tf, digest = shingles(text.as_py(), hashes)
                if i is None or not len(s):
                    continue
                digests.append(digest)
                own.append(s)
                w = weights(s, tf, table)
                total.append(float(w.sum()))
                logs.append(np.log(w).astype("f4"))
                if sum(map(len, own)) >= CHUNK:
                    yield sampled()
                    digests, own, logs, total = [], [], [], []
        if digests:
            yield sampled()

    return written(docs.mapInArrow(trimmed(run), "digest binary, weight double, keys array<long>, bits array<long>"), "near-signatures")


def _verified(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are at least ``threshold`` alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table, held = _Hashes(), idf.value, {}

        def vector(i, text):
            if i not in held:
                if len(held) > 200:
                    held.clear()
                s, tf, _ = shingles(text.as_py(), hashes)
                held[i] = (s, weights(s, tf, table))
            return held[i]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = [similarity(vector(x, s), vector(y, t)) >= threshold
                    for x, y, s, t in zip(a, b, batch.column("_ta"), batch.column("_tb"), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in (batch.column("a"), batch.column("b"))],
                                             names=["a", "b"])

    left, right = texts.toDF("a", "_ta"), texts.toDF("b", "_tb")
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "_ta", "_tb")
    return rows.sortWithinPartitions("b").mapInArrow(trimmed(run), "a long, b long")


def _prefix_pairs(open_docs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """(a, b): the pairs of ``open_docs`` (doc, class, weight, bits) of different classes that may be ``threshold`` alike.

    Texts x, y of total weights X <= Y at similarity t or more have a common weight of at least t / (1 + t) (X + Y), so of
    2 t / (1 + t) X and of t Y. With the shingles of each in one order, all that is common lies from the first common
    shingle on: a row of x is of use only if the weight from it on is at least 2 t / (1 + t) X, one of y only if it is at
    least t Y. Shingles of a single text are left out before, as they are first in the order and meet nothing. Texts of
    the largest class of a shingle are not compared with each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table = _Hashes(), idf.value
        for batch in batches:
            for doc, text in zip(batch.column("node"), batch.column("_text"), strict=True):
                own, tf, _ = shingles(text.as_py(), hashes)
                yield pa.RecordBatch.from_arrays([pa.array([doc.as_py()] * len(own), pa.int64()), pa.array(own.view(np.int64)),
                                                  pa.array(weights(own, tf, table))], names=["doc", "s", "w"])

    bits = [f"b{k}" for k in range(BITS)]
    open_texts = texts.join(open_docs.select(F.col("doc").alias("node")), "node").select("node", "_text")
    each = written(open_texts.mapInArrow(trimmed(run), "doc long, s long, w double"), "near-shingles")
    common = each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    onward = Window.partitionBy("doc").orderBy(F.col("df").desc(), F.col("s").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = each.join(common, "s").withColumn("onward", F.sum("w").over(onward)).join(open_docs, "doc")
    slack = 1 - 1e-6  # for rounding of the sums
    rows = written(rows.filter(F.col("onward") >= F.col("weight") * (threshold * slack)).select(
        "s", "doc", "class", "weight", "onward", *bits,
        (F.col("onward") >= F.col("weight") * (2 * threshold / (1 + threshold) * slack)).alias("early")), "near-prefixes")
    sizes = rows.groupBy("s", "class").agg(F.count(F.lit(1)).alias("n"), F.max("early").alias("early"))
    main = (sizes.groupBy("s").agg(F.max(F.struct("n", "class")).alias("m"), F.count(F.lit(1)).alias("classes"), F.max("early").alias("any"))
            .filter("classes > 1 and any").select("s", F.col("m.class").alias("main")))
    rows = written(rows.join(main, "s").withColumn("rest", F.col("class") != F.col("main")).drop("main"), "near-open")
    other = rows.select("s", *[F.col(c).alias(f"_{c}") for c in rows.columns if c != "s"])
    fits = ((F.col("class") != F.col("_class")) & (F.struct("weight", "doc") < F.struct("_weight", "_doc"))
            & (F.least("onward", "_onward") >= (F.col("weight") + F.col("_weight")) * (threshold / (1 + threshold) * slack))
            & (unlike("b", "_b") <= UNLIKE))
    early = rows.filter("early")
    met = [x.join(y.withColumnRenamed("s", "_s"), (F.col("s") == F.col("_s")) & fits).select(F.least("doc", "_doc").alias("a"), F.greatest("doc", "_doc").alias("b"))
           for x, y in ((early.filter("rest"), other), (early.filter("not rest"), other.filter("_rest")))]
    return met[0].union(met[1]).distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float, bands: int, rows: int) -> DataFrame:
    """(_id, _h: hash of the text, first: the class's least (_id, _h)) per row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).withColumn("_h", F.xxhash64("_text"))
    known, df = _count_pass(docs)
    n = known.count()
    idf = spark.sparkContext.broadcast(idf_table(df, max(n, 1)))
    signatures = _signatures(docs, idf, bands, rows)
    # Texts with equal words are one node, whatever their ids; its first row stands for it.
    nodes = known.filter("_id is not null").groupBy("digest").agg(F.min(F.struct("_id", "_h")).alias("first"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    members = written(known.join(nodes.select("digest", "node"), "digest", "left").select(
        "_id", "_h", F.when(F.col("_id").isNotNull(), F.col("node")).alias("node")), "near-members")
    signed = written(signatures.dropDuplicates(["digest"]).join(nodes.select("digest", "node"), "digest").select(
        F.col("node").alias("doc"), "weight", "keys", *[F.get("bits", F.lit(k)).alias(f"b{k}") for k in range(BITS)]), "near-signed")
    keyed = signed.select(F.explode("keys").alias("key"), "doc", "weight")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key")
    buckets = written(keyed.join(shared, "key"), "near-buckets")
    bits = [f"b{k}" for k in range(BITS)]
    labels = written(buckets.select("doc").distinct().join(signed.select("doc", *bits), "doc").withColumn("class", F.col("doc")), "near-labels")
    firsts = nodes.join(labels.select(F.col("doc").alias("node")), "node").select(F.col("first._id").alias("_id"), F.col("first._h").alias("_h"), "node")
    texts = written(docs.join(firsts, ["_id", "_h"]).dropDuplicates(["node"]).select("node", "_text"), "near-texts")
    size = buckets.count()

    edges = spark.createDataFrame([], "a long, b long")
    tried = edges
    fruitful = True  # whether the last round's pivots linked a fair share of the texts they met
    for k in range(MAX_ROUNDS + 1):
        placed = written(buckets.join(labels, "doc"), "near-placed")
        sizes = placed.groupBy("key", "class").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(
            F.xxhash64(F.lit(k), "doc"), F.col("doc"), F.col("weight"), *bits)).alias("_p"))
        # Buckets of one class are done; of the others, the largest class gives the pivot.
        main = sizes.groupBy("key").agg(F.max(F.struct("_n", F.col("class").alias("main"), F.col("_p.doc").alias("pivot"), F.col("_p.weight").alias("pivot_weight"), *[F.col(f"_p.{x}").alias(f"p{x}") for x in bits])).alias("_m"),
                                        F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_classes"))
        main = written(main.filter("_classes > 1").select("key", "_m.main", "_m.pivot", "_m.pivot_weight", *[f"_m.p{x}" for x in bits], "_all", (F.col("_all") - F.col("_m._n")).alias("_rest")), "near-main")
        left = main.agg(F.sum(F.col("_all") * F.col("_rest"))).first()[0] or 0
        if not left:
            break
        last = k == MAX_ROUNDS or left <= 2 * size or not fruitful
        rest = placed.join(main, "key").filter(F.col("class") != F.col("main"))
        # Similarity is at most the ratio of the total weights (a hair of slack for rounding).
        near = lambda a, b: F.least(a, b) >= F.greatest(a, b) * (threshold - 1e-6)
        if last:
            held = placed.join(main.select("key"), "key", "left_semi").select("doc", "class", "weight", *bits)
            pairs = _prefix_pairs(written(held.dropDuplicates(["doc"]), "near-held"), texts, idf, threshold)
        else:
            pairs = rest.filter(near(F.col("weight"), F.col("pivot_weight")) & (unlike("b", "pb") <= UNLIKE)).select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct()
        pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
        links = written(_verified(pairs, texts, idf, threshold), "near-links")
        edges, tried = edges.union(links), tried.union(pairs)
        fruitful = links.count() * 20 >= pairs.count()
        found = components(edges)
        labels = written(labels.join(found, labels["doc"] == found["node"], "left")
                         .select("doc", *bits, F.coalesce("component", "class").alias("class")), "near-labels")
        if last:
            break
    placed = nodes.join(labels, nodes["node"] == labels["doc"], "left").select("node", "first", F.coalesce("class", "node").alias("class"))
    least = placed.groupBy("class").agg(F.min("first").alias("first"))
    found = placed.select("node", "class").join(least, "class").select("node", "first")
    return members.join(found, "node", "left").select("_id", "_h", "first")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: id and ``class_id`` (the smallest id of its class)."""
    out = _classes(docs, id_col, text_col, threshold, bands, rows)
    return out.select(F.col("_id").alias(id_col), F.col("first._id").alias("class_id"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the row with the smallest id (of its texts, that with the
    smallest hash), with its repetitions; rows with a null id."""
    classes = _classes(docs, id_col, text_col, threshold, bands, rows)
    dropped = classes.filter(F.struct("_id", "_h") != F.col("first")).select(F.col("_id").alias("_tf_id"), F.col("_h").alias("_tf_h")).distinct()
    gone = (F.col(id_col).cast("long") == F.col("_tf_id")) & (F.xxhash64(F.col(text_col)) == F.col("_tf_h"))
    return docs.join(dropped, gone, "left_anti")
