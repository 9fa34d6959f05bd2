"""Running a user's function over prompt tables (X2, F8, F9) and shaping result rows.

The function is the user's (a model, a service client, a rule); it receives an Arrow batch of
prompts as a pandas Series and returns the generated texts. ``loader`` builds it (for example,
loads a model) once per Python worker process, never once per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import result_time, strip_echo

ScoreFn = Callable[[pd.Series], pd.Series]


def _loaded(loader: Callable[[], ScoreFn], key: str) -> ScoreFn:
    """The loader's result, built once per Python worker process (workers are reused across
    tasks), so a model is not reloaded for every partition. The cache lives on the pyspark
    module, which workers import by reference."""
    import pyspark

    cache = pyspark.__dict__.setdefault("_tuneforge_loaded", {})
    if key not in cache:
        cache[key] = loader()
    return cache[key]


def score(df: DataFrame, prompt: str, fn: ScoreFn | None = None, loader: Callable[[], ScoreFn] | None = None,
          out: str = "generated_text", cache_key: str | None = None) -> DataFrame:
    """``out`` = fn(prompts) per Arrow batch (batch or streaming). Only the prompt column goes to Python.

    ``loader``'s result is kept per Python worker under ``cache_key``; without one, under a digest of the
    pickled loader, so two loaders made by one factory stay apart.

    A sampling model is not deterministic: a recomputed task (lost executor) may generate other
    text. Write the result once (a sink, or ``session.materialize``) before reading it twice."""
    if (fn is None) == (loader is None):
        raise ValueError("give exactly one of fn or loader")
    key = cache_key or (hashlib.sha256(cloudpickle.dumps(loader)).hexdigest() if loader else "")

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = _loaded(loader, key) if loader is not None else fn
        for prompts in batches:
            yield pd.Series(list(f(prompts)), dtype=object)

    return df.withColumn(out, run.asNondeterministic()(F.col(prompt)))


def result_rows(df: DataFrame, prompt: str, generated: str, clock: Column, keep=()) -> DataFrame:
    """Result log rows: (timestamp text, input_text, generated_text with the echoed prompt
    stripped). ``clock`` is the run's timestamp column (fixed for reproducible runs)."""
    return df.select(*keep, result_time(clock).alias("timestamp"), F.col(prompt).alias("input_text"),
                     strip_echo(generated, prompt).alias("generated_text"))
