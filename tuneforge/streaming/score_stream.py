"""Scoring prompts as a stream (R1): file source -> user function -> strip echo -> timestamp ->
append-only sink with a checkpoint.

The interactive loop of the reference (read a prompt, generate, append a timestamped row)
becomes a stateless Structured Streaming query: new prompt files are picked up as they land,
each micro-batch is scored in Arrow batches, and the file sink plus checkpoint make the
appended log exactly-once across restarts and lost executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.score import ScoreFn, result_rows, score


def score_stream(spark: SparkSession, source: str, schema: str, prompt: str, sink: str, checkpoint: str,
                 fn: ScoreFn | None = None, loader: Callable[[], ScoreFn] | None = None, clock: Column | None = None,
                 keep=(), fmt: str = "parquet", available_now: bool = True, max_files_per_trigger: int | None = None
                 ) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops (a bounded run);
    otherwise it keeps polling. ``clock`` defaults to the processing time."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    prompts = reader.load(source)
    scored = score(prompts, prompt, fn=fn, loader=loader)
    rows = result_rows(scored, prompt, "generated_text", clock if clock is not None else F.current_timestamp(), keep)
    w = rows.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(sink)
