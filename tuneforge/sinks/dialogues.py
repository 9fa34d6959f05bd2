"""Dialogue files of bounded items (S5's format): an array item is a run of at most ``run_turns`` utterances.

An item holds ``dlg``, ``first`` (the position of its first utterance) and ``utterances``. ``read_dialogues``
gives a run's utterances their dialogue and position back, and pairing groups by (dialogue, pair), so a pair that
two runs share is joined there. A dialogue of any length is spread over many items, files and tasks.

Defined cases: positions are unique in a dialogue; a null utterance stays null; a dialogue without utterances is not
written; a null position counts as run 0's first place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

RUN_TURNS = 200
RUNS_PER_FILE = 200


def write_dialogues(df: DataFrame, root: str, run_turns: int = RUN_TURNS, runs_per_file: int = RUNS_PER_FILE) -> None:
    """Write (dlg, pos, turn_num, utterance) as JSON arrays, ``root``/topic=.../*.txt."""
    run = F.floor(F.coalesce("pos", F.lit(0)) / run_turns)
    turns = F.sort_array(F.collect_list(F.struct("pos", "turn_num", "utterance")))
    runs = materialize(df.groupBy("dlg", run.alias("run")).agg(turns.alias("u")).select(
        "dlg", "run", F.struct(
            F.col("dlg").cast("string").alias("dlg"), F.coalesce(F.col("u")[0]["pos"], F.lit(0)).alias("first"),
            F.transform("u", lambda x: F.struct(x["turn_num"].alias("turn_num"), x["utterance"].alias("utterance")))
            .alias("utterances")).alias("d")))
    topics = max(1, -(-runs.count() // runs_per_file))
    files = (runs.withColumn("topic", F.pmod(F.xxhash64("dlg", "run"), F.lit(topics))).groupBy("topic")
             .agg(F.to_json(F.collect_list("d")).alias("value")))
    files.write.partitionBy("topic").text(root)
