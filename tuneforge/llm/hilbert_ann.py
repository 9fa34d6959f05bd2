"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are lifted to one norm (an added component, the root of the largest squared norm minus the own one), and
queries are scaled to it, so that the largest inner product is the smallest distance. Lifted vectors are projected
on a few random directions; several Hilbert curves, each over its own projection and
shifted by its own random offset, order all rows. Along a curve, rows are numbered without a global sort (a
histogram of key cells gives offsets) and cut into blocks of ``BLOCK_ROWS``. A query meets, on each curve, the
rows of the window around its own place, and keeps the ``k`` best of them in each block, so the size of blocks
never changes results; the best of all windows are merged and ranked by
the exact inner product of the original vectors, in double precision, summed in the order of the components.

The window is a share of the rows, so recall hardly depends on the table's size. ``WINDOW`` and ``CURVES``
suit vectors whose neighbours spread over all dimensions (recall is measured in the tests); vectors that lie
near a few dimensions need far less.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part, as query or
candidate, nor do those whose length differs from the most frequent one; null ids take no part; rows that
repeat an id count once (any of them if vectors differ); ties go to the smaller id; with fewer candidates than
``k``, all are returned; an empty table gives an empty result. Clashing extra columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CURVES = 8
DIMENSIONS = 2
BITS = 14
WINDOW = 0.22
BLOCK_ROWS = 16_384
QUERY_ROWS = 4096
CELL_BITS = 14
SPREAD = 64


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of integer points (n, d) below 2^bits in each coordinate.

    Coordinates are turned into the curve's transposed form, one bit plane at a time from the top: a plane's
    set bit reflects, an unset one exchanges, the lower bits of the first coordinate; a Gray code follows."""
    x = points.T.astype(np.int64).copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(d):
            on = (x[i] >> b) & 1 == 1
            change = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ change)
            x[i] ^= change if i else 0
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> b) & 1
    return key


def _projections(length: int, curves: int, dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, curves x dims) directions, orthogonal within a curve, and shifts in [0, 1)."""
    rng = np.random.default_rng(seed)
    parts = [np.linalg.qr(rng.normal(size=(length, max(dims, 1))))[0][:, :dims] if length >= dims
             else rng.normal(size=(length, dims)) for _ in range(curves)]
    return np.concatenate(parts, 1), rng.uniform(0, 1, curves * dims)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, _v: array<double>) of the rows that take part."""
    v = F.col("_v")
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    usual = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("_v") == (usual["n"] if usual else 0)).dropDuplicates(["_id"])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _norms(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, norms), without overflow on the way."""
    size = np.abs(v).max(1)
    v = v / size[:, None]
    norm = np.sqrt((v * v).sum(1))
    return v / norm[:, None], size * norm


def lifted(v: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """(vectors lifted to norm 1, the same as queries) with one more component; ``largest`` is the largest norm."""
    unit, norm = _norms(v)
    share = np.minimum(norm / largest, 1)
    return (np.column_stack([unit * share[:, None], np.sqrt(1 - share ** 2)]),
            np.column_stack([unit, np.zeros(len(unit))]))


def curve_ranks(rows: DataFrame, length: int, queries_every: int, curves: int, dims: int, seed: int) -> tuple[DataFrame, int]:
    """(curve, rank, _id, _asked) of all rows on all curves, and the number of rows. A query has a row of its own
    (_asked), whose rank is the number of rows before its place."""
    axes, shifts = _projections(length + 1, curves, dims, seed)

    def largest_norm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([_norms(_matrix(batch.column("_v")))[1].max()])], names=["norm"])

    largest = rows.select("_v").mapInArrow(largest_norm, "norm double").agg(F.max("norm").alias("norm")).first()["norm"]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = 0, np.zeros(axes.shape[1]), np.zeros(axes.shape[1])
        for batch in batches:
            if batch.num_rows:
                p = lifted(_matrix(batch.column("_v")), largest)[0] @ axes
                n, s, ss = n + len(p), s + p.sum(0), ss + (p * p).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(s)), pa.int32()), pa.array([float(n)] * len(s)), pa.array(s), pa.array(ss)],
                                         names=["axis", "n", "s", "ss"])

    sums = (rows.select("_v").mapInArrow(moments, "axis int, n double, s double, ss double").groupBy("axis")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).orderBy("axis").collect())  # a row per axis
    n = int(sums[0]["n"]) if sums else 0
    mean = np.array([r["s"] / max(n, 1) for r in sums])
    spread = np.sqrt(np.maximum(np.array([r["ss"] / max(n, 1) for r in sums]) - mean ** 2, 1e-24))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows_in, asked_in = lifted(_matrix(batch.column("_v")), largest)
            ids = batch.column("_id").to_numpy()
            asks = ids % queries_every == 0
            p = (np.concatenate([rows_in, asked_in[asks]]) @ axes - mean) / spread
            p = np.clip((p + 4) / 16 + shifts / 2, 0, 1)  # +-4 deviations fill half the square, shifted inside it
            cells = np.minimum((p * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            ids = pa.array(np.concatenate([ids, ids[asks]]))
            asked = pa.array(np.arange(len(p)) >= batch.num_rows)
            for c in range(curves):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(p), c, np.int32)), ids,
                    pa.array(hilbert_keys(cells[:, c * dims:(c + 1) * dims], BITS)), asked], names=["curve", "_id", "key", "_asked"])

    keyed = written(rows.mapInArrow(keys, "curve int, _id long, key long, _asked boolean"), "ann-keys")
    # Rows are numbered by (cell of the curve, hash bucket, key): a cell full of equal vectors is spread too.
    shift = max(0, BITS * dims - CELL_BITS)
    keyed = (keyed.withColumn("_cell", F.shiftright("key", shift) * SPREAD + F.pmod(F.xxhash64("_id"), F.lit(SPREAD))))
    one = F.when(F.col("_asked"), 0).otherwise(1)  # queries are no candidates
    counts = keyed.groupBy("curve", "_cell").agg(F.sum(one).alias("_n"))
    before = Window.partitionBy("curve").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("curve", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("curve", "_cell").orderBy("key", "_id", "_asked").rowsBetween(Window.unboundedPreceding, -1)
    ranked = keyed.withColumn("_r", F.coalesce(F.sum(one).over(inside), F.lit(0))).join(starts, ["curve", "_cell"])
    ranked = ranked.select("curve", "_id", "_asked", (F.col("_o") + F.col("_r")).alias("rank"))
    return written(ranked, "ann-ranks"), n


def inner_product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component, so equal vectors score alike anywhere."""
    out = np.zeros(len(q))
    for k in range(q.shape[1]):
        out += q[:, k] * c[:, k]
    return out


def bounds(rank, n: int, window: float, k: int):
    """(first, last) rank of the window around ``rank``, a column."""
    half = int(window * n / 2) + k
    return (F.greatest(F.lit(0), F.least(rank - half, F.lit(n - 1 - 2 * half))),
            F.least(F.lit(n - 1), F.greatest(rank + half, F.lit(2 * half))))


def best(q_ids: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, c_ids: np.ndarray, c: np.ndarray,
         c_ranks: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of each query's ``k`` best candidates of a block, ties to smaller ids. Only
    candidates ranked from ``low`` to ``high`` count."""
    out = []
    order = np.argsort(c_ranks)
    c_ids, c, c_ranks = c_ids[order], c[order], c_ranks[order]
    low, high = np.searchsorted(c_ranks, low), np.searchsorted(c_ranks, high, "right")
    for at in range(0, len(q), 256):
        g = q[at:at + 256] @ c.T
        g[q_ids[at:at + 256, None] == c_ids[None, :]] = -np.inf
        for row, first, last in zip(g, low[at:at + 256], high[at:at + 256], strict=True):
            row[:first] = row[last:] = -np.inf
        bar = np.partition(g, -k, axis=1)[:, -k] if g.shape[1] > k else np.full(len(g), -np.inf)
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(bar), bar, 0)))
        i, j = np.nonzero((g >= (bar - slack)[:, None]) & np.isfinite(g))
        s = inner_product(q[at + i], c[j])
        o = np.lexsort((c_ids[j], -s, i))
        i, j, s = i[o], j[o], s[o]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((q_ids[at + i[place < k]], c_ids[j[place < k]], s[place < k]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(vectors: DataFrame, queries_every: int, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           curves: int = CURVES, dims: int = DIMENSIONS, window: float = WINDOW, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): of the rows whose id is divisible by ``queries_every``, the ``k`` nearest
    other rows found."""
    rows = written(usable(vectors, id_col, vector_col), "ann-rows")
    first = rows.select(F.size("_v").alias("n")).first()
    ranked, n = curve_ranks(rows, first["n"] if first else 1, queries_every, curves, dims, seed)
    ranked = ranked.join(rows, "_id")
    blocks = ranked.filter(~F.col("_asked")).withColumn("block", F.floor(F.col("rank") / BLOCK_ROWS).cast("long"))
    low, high = bounds(F.col("rank"), n, window, k)
    asked = (ranked.filter("_asked").withColumn("_low", low).withColumn("_high", high)
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("_low") / BLOCK_ROWS), F.floor(F.col("_high") / BLOCK_ROWS)))))
    # A block meets at most about QUERY_ROWS queries at once; beyond that it is copied for each part of them.
    parts = max(1, int(n / queries_every * (window + 2 * BLOCK_ROWS / max(n, 1)) / QUERY_ROWS) + 1)
    asked = asked.withColumn("part", F.pmod(F.xxhash64("_id"), F.lit(parts)).cast("int")).select("curve", "block", "part", "_id", "_v", "_low", "_high").toDF("_qc", "_qb", "_qp", "_qid", "_qv", "_low", "_high")
    offered = (blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))) if parts > 1
               else blocks.withColumn("part", F.lit(0))).select("curve", "block", "part", "_id", "_v", "rank")
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return kind.empty_table()
        got = best(left["_qid"].to_numpy(), _matrix(left["_qv"]), left["_low"].to_numpy(), left["_high"].to_numpy(),
                   right["_id"].to_numpy(), _matrix(right["_v"]), right["rank"].to_numpy(), k)
        return pa.Table.from_arrays([pa.array(x) for x in got], schema=kind)

    found = (asked.groupBy("_qc", "_qb", "_qp").cogroup(offered.groupBy("curve", "block", "part"))
             .applyInArrow(run, "query_id long, vec_id long, score double").distinct())
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
