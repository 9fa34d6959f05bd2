"""Exact de-duplication by skew-safe combining: locally, per salt, then over the salts' winners.

Texts are equal when identical after each run of ASCII white space became one space; a null text is
an empty one. Every combine step groups by (digest, whole text), so equal digests of different texts
never meet. Only built-in DataFrame functions run here.

Defined cases: an empty table gives an empty result; rows that repeat both id and text are the same
document (all reported alike by ``exact_classes``, one of them returned by ``exact_dedup``); a null id
loses against any id of its group, and of a group with null ids only, ``exact_dedup`` keeps one row.
Columns beyond id and text may have any name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, written

SALTS = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), ASCII_SPACE, " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                  digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id`` (smallest id of its equal texts), ``group_size``,
    ``kept``, ``digest``.

    1. ``groupBy(digest, salt, text)``: Spark's map-side aggregation is the local de-duplication, and
       the salt (a hash of the id) spreads a hot text over ``salts`` reducers;
    2. ``groupBy(digest, text)`` over the salt winners: at most ``salts`` rows of a text meet;
    3. the winners, without their texts, are joined back by digest. A digest shared by different texts
       (``variants`` > 1) is joined back by whole text instead.
    """
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    rows = rows.withColumn("_digest", digest(F.col("_text")))
    salted = (rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"))
              .groupBy("_digest", "_salt", "_text")
              .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")))
    winners = (salted.repartition("_digest").groupBy("_digest", "_text")
               .agg(F.min("_first").alias("keep_id"), F.sum("_n").alias("group_size"))
               .withColumn("_variants", F.count(F.lit(1)).over(Window.partitionBy("_digest"))))
    winners = written(winners.select(
        "_digest", "keep_id", "group_size",
        F.when(F.col("_variants") > 1, F.col("_text")).alias("_content")), "exact-winners")

    out = rows.select("_id", "_digest").join(winners.filter("_content is null").drop("_content"), "_digest")
    shared = winners.filter("_content is not null")
    if not shared.isEmpty():
        by_text = rows.join(shared, (rows["_digest"] == shared["_digest"]) & (rows["_text"] == shared["_content"]))
        out = out.unionByName(by_text.select("_id", rows["_digest"], "keep_id", "group_size"))
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size",
                      F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_digest").alias("digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per distinct normalised text."""
    def key(i: Column, d: Column) -> Column:
        return F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("")), d)

    classes = exact_classes(docs, id_col, text_col, salts)
    dropped = classes.filter(~F.col("kept")).select(key(F.col(id_col), F.col("digest")).alias("_tf_key"))
    keyed = docs.withColumn("_tf_key", key(F.col(id_col), sha256_hex(normalised(F.col(text_col)))))
    return keyed.join(dropped, "_tf_key", "left_anti").dropDuplicates(["_tf_key"]).drop("_tf_key")
