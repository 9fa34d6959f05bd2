"""Supervised examples (path B): prompt and answer segments -> input ids and masked labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as K

Tokenize = Callable[[Column], Column]


def sft_encode(df: DataFrame, prompt: Column, answer: Column, tokenize: Tokenize = K.codepoint_ids,
               eos: int = 2, max_len: int = 2048) -> DataFrame:
    """Adds ``input_ids`` (prompt ids + answer ids + eos, cut to max_len), ``labels`` (-100 over
    the prompt, then the answer ids, cut the same way) and ``n_supervised``.

    Segments are encoded separately without special tokens and concatenated, so the label
    boundary is exact. A prompt of max_len tokens or more leaves no supervised position."""
    d = (df.withColumn("_tf_p", tokenize(prompt))
         .withColumn("_tf_a", K.append_eos(tokenize(answer), eos)))
    d = (d.withColumn("input_ids", K.truncate_right(F.concat("_tf_p", "_tf_a"), max_len))
         .withColumn("labels", K.truncate_right(K.label_answer_only("_tf_p", "_tf_a"), max_len)))
    return d.withColumn("n_supervised", K.n_supervised("labels")).drop("_tf_p", "_tf_a")
