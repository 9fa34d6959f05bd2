"""Dialogue turns -> (input, output) pairs.

Rule: for odd i < number of utterances of the dialogue, pair turn i with turn i+1; the first
utterance (lowest position) wins on a repeated turn number, even when it is null; a pair is
skipped when either side is missing or null; turn numbers are 1-based.

Plan: one aggregation keyed by (dialogue, pair id = (turn+1) div 2) picks both sides with
``min_by`` (map-side partial aggregation; a group holds two turns plus repeats), and one per
dialogue count joined back. No window over a whole dialogue, so a dialogue holding a large
share of all rows does not end up sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_utterance(df: DataFrame, dlg: str = "dlg", turn: str = "turn_num", text: str = "utterance",
                    pos: str = "pos") -> DataFrame:
    """A4: the first utterance (lowest ``pos``) per (dialogue, turn); a null first one wins."""
    return (df.groupBy(dlg, turn)
            .agg(F.min_by(F.struct(F.col(text).alias("u")), F.col(pos)).getField("u").alias(text)))


def pair_turns(df: DataFrame, dlg: str = "dlg", turn: str = "turn_num", text: str = "utterance",
               pos: str = "pos") -> DataFrame:
    """(dlg, turn_num, input, output) for every valid pair (turn_num is the odd turn)."""
    n_utts = df.groupBy(dlg).agg(F.count(F.lit(1)).alias("_tf_n"))
    t = F.col(turn)
    side = F.struct(F.col(text).alias("u"))
    pairs = (df.where(t >= 1)
             .withColumn("_tf_pair", F.floor((t + 1) / 2).cast("int"))
             .groupBy(dlg, "_tf_pair")
             .agg(F.min_by(side, F.when(t % 2 == 1, F.col(pos))).alias("_tf_a"),
                  F.min_by(side, F.when(t % 2 == 0, F.col(pos))).alias("_tf_b"))
             .where(F.col("_tf_a.u").isNotNull() & F.col("_tf_b.u").isNotNull()))
    return (pairs.join(n_utts, dlg)
            .where(F.col("_tf_pair") * 2 - 1 < F.col("_tf_n"))
            .select(F.col(dlg), (F.col("_tf_pair") * 2 - 1).alias(turn),
                    F.col("_tf_a.u").alias("input"), F.col("_tf_b.u").alias("output")))


def renumber_after_leading(df: DataFrame, dlg: str, turn: str, role: str, drop_role: str = "system",
                           out: str = "turn_num") -> DataFrame:
    """Drop ``drop_role`` turns that lead a dialogue (turn 0) and renumber the rest from 1.

    A per-dialogue flag (partial aggregate, one row per dialogue) joined back; no window."""
    flag = (df.where((F.col(role) == drop_role) & (F.col(turn) == 0))
            .groupBy(dlg).agg(F.lit(1).alias("_tf_lead")))
    kept = df.where(F.col(role) != drop_role)
    return (kept.join(flag, dlg, "left")
            .withColumn(out, (F.col(turn) + 1 - F.coalesce(F.col("_tf_lead"), F.lit(0))).cast("int"))
            .drop("_tf_lead"))
