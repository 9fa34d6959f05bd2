"""Seeded permutation, exact splits, exact samples and caps.

All of them are "the first k rows of a group in seeded hash order", with k computed from the
group size n. The cut is exact and runs without a global window:

1. ``h = md5(seed:salt:row_key)``, bucket ``b`` = first hex digits of ``h``.
2. Counts per (group, b); a running sum per group gives the boundary bucket ``b_cut`` where
   the k-th row lies and the number of rows ``before`` it. One row per group.
3. Only the rows of each boundary bucket (~n/16**BUCKET_HEX of them) are ranked, giving the
   last admitted ``(h, key)``. Still one row per group.
4. One narrow pass: a row is in the first k iff ``(h, key) <= (h_cut, key_cut)``.

The cut table has one row per group. Up to MAX_LITERAL_GROUPS (32) groups it is fetched (a bounded
``limit``) and inlined as literal expressions; beyond that it is written into the shared
checkpoint folder and joined without a hint (the planner broadcasts it by its bytes, or shuffles). The
data rows themselves are never shuffled by the cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import BUCKET_HEX, hash_bucket, shuffle_hash
from ..plans.small import attach_stats, null_safe_join
from ..session import materialize

KRule = Callable[[Column], Column]


# ---------------------------------------------------------------------------------------------
# k rules (size of the "first" part as a function of the group size n)
# ---------------------------------------------------------------------------------------------

def _ratio_col(ratio) -> Column:
    if isinstance(ratio, str):  # a column's values outside [0, 1] act as 0 and 1 (the rules clamp k to 0..n)
        return F.col(ratio).cast("double")
    if not 0.0 <= float(ratio) <= 1.0:
        raise ValueError(f"ratio must lie in [0, 1], got {ratio}")
    return F.lit(float(ratio))


def floor_train(ratio) -> KRule:
    """k = floor(n * ratio): the dataset-maker split (train gets the floor)."""
    return lambda n: F.least(n, F.greatest(F.lit(0), F.floor(n.cast("double") * _ratio_col(ratio)))).cast("long")


def ceil_valid(ratio) -> KRule:
    """k = n - ceil((1 - ratio) * n): the holdout split (validation gets the ceiling)."""
    test = (F.lit(1.0) - _ratio_col(ratio))
    return lambda n: F.least(n, F.greatest(F.lit(0), n - F.ceil(test * n.cast("double")))).cast("long")


def absolute(k) -> KRule:
    """k = min(k, n)."""
    if not isinstance(k, str) and int(k) < 0:
        raise ValueError(f"k must be >= 0, got {k}")
    kc = F.col(k) if isinstance(k, str) else F.lit(int(k))
    return lambda n: F.least(n, kc.cast("long"))


# ---------------------------------------------------------------------------------------------
# the exact cut
# ---------------------------------------------------------------------------------------------

def with_shuffle_hash(df: DataFrame, key: str, seed, salt: str = "", out: str = "_tf_h") -> DataFrame:
    return df.withColumn(out, shuffle_hash(key, seed, salt))


def _key_str(key: str) -> Column:
    return F.col(key).cast("string")


# Per-group cut tables up to this many rows are fetched (bounded: limit(n + 1)) and inlined as
# literal CASE expressions (a row tests at most this many groups); larger ones are checkpointed
# and joined with a checked broadcast (a hash lookup per row).
MAX_LITERAL_GROUPS = 32


def _lookup(rows, gb: list[str], field: str, dtype: str) -> Column:
    """CASE over the (few) groups of a fetched cut table -> the group's ``field``."""
    expr = None
    for r in rows:
        cond = None
        for g in gb:
            e = F.col(g).eqNullSafe(F.lit(r[g]))
            cond = e if cond is None else cond & e
        val = F.lit(r[field]).cast(dtype)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    null = F.lit(None).cast(dtype)
    return null if expr is None else expr.otherwise(null)


def _small_rows(df: DataFrame):
    rows = df.limit(MAX_LITERAL_GROUPS + 1).collect()
    return rows if len(rows) <= MAX_LITERAL_GROUPS else None


def first_k(df: DataFrame, key: str, k_rule: KRule, seed=42, salt: str = "", by: Sequence[str] = (),
            out: str = "_tf_first", bucket_hex: int = BUCKET_HEX, keep_hash: str | None = None,
            totals: dict | None = None) -> DataFrame:
    """Add boolean ``out``: the row is among the first k of its group in seeded hash order.

    ``key`` must identify a row within its group (a run of equal keys across the cut raises
    ``ValueError``). ``seed`` is an int or a column name that is constant within a group (listed
    in ``by``). ``totals``, when given, receives ``n`` (rows) and ``k`` (rows in the first part)
    summed over the groups, from the cut statistics (no pass over the rows)."""
    by = list(by)
    seed_c = F.col(seed) if isinstance(seed, str) else seed
    d = df.withColumn("_tf_h", shuffle_hash(key, seed_c, salt)).withColumn("_tf_b", hash_bucket("_tf_h", bucket_hex))
    gb = by if by else ["_tf_grp"]
    if not by:
        d = d.withColumn("_tf_grp", F.lit(0))

    # step 2: counts per (group, bucket) -> boundary bucket, one row per group
    counts = d.groupBy(*gb, "_tf_b").agg(F.count(F.lit(1)).alias("_tf_c"))
    run = Window.partitionBy(*gb).orderBy("_tf_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (counts.withColumn("_tf_cum", F.sum("_tf_c").over(run))
              .withColumn("_tf_n", F.sum("_tf_c").over(Window.partitionBy(*gb))))
    counts = counts.withColumn("_tf_k", k_rule(F.col("_tf_n")))
    cut = (counts.where(F.col("_tf_cum") >= F.col("_tf_k"))
           .groupBy(*gb)
           .agg(F.min("_tf_b").alias("_tf_bcut"),
                F.min_by(F.col("_tf_cum") - F.col("_tf_c"), F.col("_tf_b")).alias("_tf_before"),
                F.max("_tf_k").alias("_tf_k"), F.max("_tf_n").alias("_tf_n")))
    keys = d.select(*gb, "_tf_h", "_tf_b", _key_str(key).alias("_tf_key"))
    w_bnd = Window.partitionBy(*gb).orderBy("_tf_h", "_tf_key")
    h, k = F.col("_tf_h"), _key_str(key)

    def boundary(rows_with_cut: DataFrame) -> DataFrame:
        # step 3: rank only the boundary bucket rows -> last admitted (h, key) per group. The next
        # row in the same order is read too: if it has the cut row's (h, key), a run of equal
        # keys straddles the cut and no (h, key) threshold can be exact.
        nxt_h, nxt_k = F.lead("_tf_h").over(w_bnd), F.lead("_tf_key").over(w_bnd)
        return (rows_with_cut.where(F.col("_tf_b") == F.col("_tf_bcut"))
                .select("*", F.row_number().over(w_bnd).alias("_tf_rn"),
                        F.coalesce((nxt_h == F.col("_tf_h")) & (nxt_k == F.col("_tf_key")), F.lit(False))
                        .alias("_tf_straddle"))
                .where(F.col("_tf_rn") == F.col("_tf_k") - F.col("_tf_before"))
                .select(*gb, F.col("_tf_h").alias("_tf_hcut"), F.col("_tf_key").alias("_tf_keycut"), "_tf_straddle"))

    def unique_at_cut(flags) -> None:
        if any(flags):
            raise ValueError(f"key {key!r} is not unique within its group at the cut; derive a unique key "
                             "(e.g. sources.jsonl.line_keys numbers equal rows)")

    def inside(bcut: Column, hcut: Column, keycut: Column) -> Column:
        # step 4: one narrow pass: (h, key) <= (h_cut, key_cut)
        b = F.col("_tf_b")
        return F.coalesce((b < bcut) | ((b == bcut) & hcut.isNotNull()
                                       & ((h < hcut) | ((h == hcut) & (k <= keycut)))), F.lit(False))

    small = _small_rows(cut)
    if small is not None and totals is not None:
        totals.update(n=sum(r["_tf_n"] for r in small), k=sum(r["_tf_k"] for r in small))
    if small is not None:
        bcut, before, kk = (_lookup(small, gb, "_tf_bcut", "int"), _lookup(small, gb, "_tf_before", "long"),
                            _lookup(small, gb, "_tf_k", "long"))
        bnd_rows = boundary(keys.select("*", bcut.alias("_tf_bcut"), before.alias("_tf_before"), kk.alias("_tf_k")))
        bnd = [r.asDict() for r in bnd_rows.collect()]  # at most one row per group
        unique_at_cut([r["_tf_straddle"] for r in bnd])
        if bnd:
            hcut, keycut = _lookup(bnd, gb, "_tf_hcut", "string"), _lookup(bnd, gb, "_tf_keycut", "string")
        else:
            hcut = keycut = F.lit(None).cast("string")
        j = d.withColumn(out, inside(bcut, hcut, keycut))
    else:
        cut = materialize(cut)
        if totals is not None:
            row = cut.agg(F.sum("_tf_n").alias("n"), F.sum("_tf_k").alias("k")).first()
            totals.update(n=int(row["n"] or 0), k=int(row["k"] or 0))
        bnd = boundary(attach_stats(keys, cut, gb))
        cut = materialize(null_safe_join(cut, bnd, gb, "left"))
        unique_at_cut([r[0] for r in cut.where(F.col("_tf_straddle")).select("_tf_straddle").limit(1).collect()])
        j = attach_stats(d, cut, gb, how="left")
        j = j.withColumn(out, inside(F.col("_tf_bcut"), F.col("_tf_hcut"), F.col("_tf_keycut")))
    if keep_hash:
        j = j.withColumnRenamed("_tf_h", keep_hash)
    return j.drop("_tf_h", "_tf_b", "_tf_bcut", "_tf_before", "_tf_k", "_tf_n", "_tf_hcut", "_tf_keycut", "_tf_straddle",
                  "_tf_grp")


# ---------------------------------------------------------------------------------------------
# public operators
# ---------------------------------------------------------------------------------------------

def seeded_shuffle(df: DataFrame, key: str, seed=42, salt: str = "shuffle", out: str = "shuffle_key") -> DataFrame:
    """Uniform permutation, reproducible by seed: a range-partitioned sort on the hash key."""
    seed_c = F.col(seed) if isinstance(seed, str) else seed
    return df.withColumn(out, shuffle_hash(key, seed_c, salt)).orderBy(out, _key_str(key))


def exact_split(df: DataFrame, key: str, ratio=0.8, seed=42, by: Sequence[str] = ("source",),
                mode: str = "floor_train", salt: str = "split", out: str = "split",
                totals: dict | None = None) -> DataFrame:
    """Per group, the first k rows in hash order -> 'train', the rest -> 'valid'.

    mode 'floor_train': k = floor(n*ratio) (dataset maker); 'ceil_valid': the validation part is
    ceil((1-ratio)*n) (holdout)."""
    rule = {"floor_train": floor_train, "ceil_valid": ceil_valid}[mode](ratio)
    r = first_k(df, key, rule, seed, salt, by, out="_tf_first", totals=totals)
    return r.withColumn(out, F.when(F.col("_tf_first"), F.lit("train")).otherwise(F.lit("valid"))).drop("_tf_first")


def split_sizes(totals: dict) -> tuple[int, int]:
    """(train, valid) sizes from the ``totals`` an exact split filled in."""
    return int(totals["k"]), int(totals["n"]) - int(totals["k"])


def holdout(df: DataFrame, key: str, ratio=0.8, seed=42, by: Sequence[str] = (), salt: str = "holdout",
            out: str = "split") -> DataFrame:
    """Validation gets ceil((1-ratio)*n) rows (library holdout arithmetic)."""
    return exact_split(df, key, ratio, seed, by, mode="ceil_valid", salt=salt, out=out)


def sample_exact(df: DataFrame, key: str, k, seed=42, salt: str = "sample", by: Sequence[str] = (),
                 totals: dict | None = None) -> DataFrame:
    """Exactly min(k, n) rows per group without replacement (seeded). ``totals`` receives the
    input size ``n`` (and ``k``) from the cut statistics."""
    return first_k(df, key, absolute(k), seed, salt, by, totals=totals).where("_tf_first").drop("_tf_first")


def take_capped(df: DataFrame, key: str, k, seed=42, salt: str = "cap", by: Sequence[str] = ()) -> DataFrame:
    """T4: shuffle then keep min(k, n)."""
    return sample_exact(df, key, k, seed, salt, by)


HEAD_ROWS = 10_000  # a head or a rest of this many rows is sorted whole
HEAD_BINS = 4096


def bounded_head(df: DataFrame, n: int, order: Sequence[str], rows: int = HEAD_ROWS) -> DataFrame:
    """The first n rows in an explicit order (a stream's head, materialised), for any n; as a set of rows.

    Up to ``rows`` rows Spark takes a top-n per partition and merges them. A larger head is found by
    selection, and no task holds more than its partition's share: the n-th row's place in the order is narrowed by
    histograms of the order columns (``nth_row``), then one narrow pass keeps the rows up to it. ``order`` must
    tell rows apart at the cut: add a row key to it."""
    n = int(n)
    if n <= rows:
        return df.orderBy(*order).limit(n)
    from .select_nth import nth_row, up_to

    last = nth_row(df, n, order, rows)
    return df if last is None else df.where(up_to(df, order, last))


def positional_split(df: DataFrame, key: str, n_train: int, n_total: int, order: Sequence[str], seed=42,
                     salt: str = "positional", out: str = "split", rows: int = HEAD_ROWS) -> DataFrame:
    """T5: cap to n_total (head in ``order``, ties by key), shuffle once, first n_train -> train, rest -> valid."""
    head = bounded_head(df, n_total, [*order, key] if key not in order else order, rows)
    r = first_k(head, key, absolute(n_train), seed, salt, (), out="_tf_first")
    return r.withColumn(out, F.when(F.col("_tf_first"), F.lit("train")).otherwise(F.lit("valid"))).drop("_tf_first")


def require_enough(need: int, have: int, what: str = "pool") -> None:
    """Raise when a request cannot be served."""
    if need > have:
        raise ValueError(f"Not enough rows in {what}: need {need}, have {have}")


def holdout_sizes(n: int, ratio: float) -> tuple[int, int]:
    """Python mirror of the holdout arithmetic, for reports and tests."""
    n_valid = math.ceil((1 - ratio) * n)
    return n - n_valid, n_valid
