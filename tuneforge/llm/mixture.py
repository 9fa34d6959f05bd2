"""Mixing sources to target weights by a low-discrepancy source schedule.

1. Targets: the sources share ``share`` x all sizes by weight; a target stops at ``cap`` x its source's
   size and the excess is reshared by weight until none is above.
2. Schedule: slot n of the mix takes the point frac((n + 1) x golden ratio), mapped through the
   cumulative target shares to a source; slots are ranked per source.
3. Blocks: each source's documents are shuffled by a seeded hash and cut into blocks of equal word
   counts; the source's k-th slot plays its k-th block, starting over after the last word (repeats).
   The block that reaches a target is cut there, and slots beyond it stay empty.

Defined cases: a null source is a source (last in order); a null text has size 0; sizes of 0 take
nothing; an empty table gives an empty result; rows that repeat id, source and size follow each other
in the shuffle, and each takes its own share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import with_running_start, written

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS = 512
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes`` (source_key, source_size; one row per source) with weight, ``target``, and the cumulative
    shares ``lo`` and ``hi`` in [0, 1). ``source_key`` orders the sources (binary string order).

    One row per source is numbered and summed in one window; rows of documents never are."""
    order = Window.orderBy("source_key")
    n = F.row_number().over(order) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    s = written(sizes.withColumn("weight", F.element_at(listed, (n % len(weights) + 1).cast("int"))), "mix-sources")
    total = float(s.agg(F.sum("source_size")).first()[0] or 0) * share
    top = F.col("source_size") * F.lit(float(cap))
    # Reshare by weight: sources at their cap leave the pool, the level of the others rises.
    level, closed = 0.0, -1
    while True:
        full = top <= F.col("weight") * F.lit(level)
        r = s.agg(F.sum(F.when(full, top).otherwise(0.0)).alias("used"), F.sum(F.when(full, 1).otherwise(0)).alias("n"),
                  F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not r["open"] or r["n"] == closed:
            break
        closed, level = r["n"], max(level, (total - r["used"]) / r["open"])
    s = s.withColumn("target", F.least(top, F.col("weight") * F.lit(level)))
    whole = float(s.agg(F.sum("target")).first()[0] or 0.0) or 1.0
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("hi", F.sum("target").over(upto) / F.lit(whole))
    return s.withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0)))


def slot_schedule(spark: SparkSession, targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source_key, rank): golden-ratio points through the cumulative shares, ranked per source.

    The schedule is lengthened, by appending points of the same sequence, until every source has slots
    for its whole target. Ranks come from counts per run of slots, never from a window over a source."""
    targets = written(targets, "mix-targets")
    whole = float(targets.agg(F.sum("target")).first()[0] or 0.0)
    n = int(whole / block_words) + 1
    need = targets.select("source_key", "lo", "hi", F.ceil(F.col("target") / block_words).alias("need")).filter("need > 0")
    while True:
        points = spark.range(n).select(F.col("id").alias("slot"), ((F.col("id") + 1) * F.lit(GOLDEN) % 1.0).alias("u"))
        # Sources are intervals of [0, 1); an interval joins the cells it overlaps, so this is an equi-join.
        cells = 4096
        by_cell = need.withColumn("cell", F.explode(F.sequence(
            F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))))
        hit = (points.withColumn("cell", F.floor(F.col("u") * cells)).join(by_cell, "cell")
               .filter((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("slot", "source_key"))
        got = hit.groupBy("source_key").agg(F.count(F.lit(1)).alias("got"))
        short = need.join(got, "source_key", "left").agg(
            F.max(F.col("need") / F.greatest(F.coalesce("got", F.lit(0)), F.lit(0.5)))).first()[0]
        if short is None or short <= 1:
            break
        n = int(n * min(float(short), 4.0)) + 16
    run = 4096
    hit = hit.withColumn("_run", F.floor(F.col("slot") / run))
    counts = hit.groupBy("source_key", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("source_key").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_key", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("source_key", "_run").orderBy("slot")
    return (hit.withColumn("_r", F.row_number().over(inside) - 1).join(starts, ["source_key", "_run"])
            .select("slot", "source_key", (F.col("_o") + F.col("_r")).alias("rank")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, block_words: int = BLOCK_WORDS,
        seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces). Documents: one row per row of ``docs`` with id, source_key, ``size``,
    ``source_size``, ``target``, ``taken``. Pieces: what each slot plays, as (slot, id, source_key, start
    and size of the document, epoch, words)."""
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("~"))  # '~' sorts after 's...': null is last
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = written(docs.select(F.col(id_col).alias("_id"), key.alias("source_key"), size.alias("size")), "mix-rows")
    targets = written(source_targets(rows.groupBy("source_key").agg(F.sum("size").alias("source_size")),
                                     weights, share, cap), "mix-shares")
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), F.col("_id")))
    placed = written(with_running_start(rows, ["source_key"], ["_h", "_id", "size"], "size", "start").drop("_h")
                     .join(targets.select("source_key", "source_size", "target"), "source_key"), "mix-placed")
    # A source's play is its word stream, repeated: epoch e of a document spans start + e * source_size.
    spans = (placed.filter("size > 0 and target > 0")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil(F.lit(float(cap))).cast("int") - 1)))
             .withColumn("a", F.col("start") + F.col("epoch") * F.col("source_size"))
             .withColumn("b", F.least(F.col("a") + F.col("size"), F.round("target").cast("long")))
             .filter("b > a"))
    parts = spans.withColumn("rank", F.explode(F.sequence(
        F.floor(F.col("a") / block_words), F.floor((F.col("b") - 1) / block_words))))
    parts = parts.withColumn("words", F.least("b", (F.col("rank") + 1) * block_words)
                             - F.greatest("a", F.col("rank") * block_words))
    slots = slot_schedule(spark, targets, block_words)
    pieces = written(parts.join(slots, ["source_key", "rank"])
                     .select("slot", "_id", "source_key", "start", "size", "epoch", "words"), "mix-pieces")
    # start and a size above 0 name a row of a source: no two such rows start at one place
    taken = pieces.groupBy("source_key", "start", "size").agg(F.sum("words").alias("taken"))
    out = (placed.join(taken, ["source_key", "start", "size"], "left")
           .select(F.col("_id").alias(id_col), "source_key", "size", "source_size", "target",
                   F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    return out, pieces.withColumnRenamed("_id", id_col)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The mix as rows of ``docs``, whole and with all their columns: a document appears once for each play that
    takes any of its words, and not at all if none is taken."""
    def part(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit("\x00"))

    keyed = docs.withColumn("_tf_key", F.sha2(F.concat_ws("\x1f", part(id_col), part(source_col), part(text_col)), 256))
    _, pieces = mix(keyed.select("_tf_key", text_col, source_col), "_tf_key", text_col, source_col, **kw)
    plays = (pieces.groupBy("_tf_key", "source_key", "start", "epoch").agg(F.sum("words").alias("_w"))
             .groupBy("_tf_key").agg(F.count(F.lit(1)).cast("int").alias("_tf_n")))
    return (keyed.dropDuplicates(["_tf_key"]).join(plays, "_tf_key")
            .withColumn("_tf_play", F.explode(F.sequence(F.lit(1), F.col("_tf_n")))).drop("_tf_key", "_tf_n", "_tf_play"))
