"""Registered queries: echo strip, result rows, batch scoring, stream scoring, byte-level BPE."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import prompts as P
from ..functions import tokens as K
from ..functions.text import STRIP_PATTERN, result_time, strip_echo
from ..functions.tokenizer import byte_level_tokenizer_json, tokenizer_ids
from ..operators.score import result_rows, score
from ..session import scratch_path
from ..sources import tables as T
from ..streaming.score_stream import score_stream
from .q_prompts import MULTI_SOURCE_SQL, OWN_QA_SQL, own_qa
from .registry import query

CLOCK = "2024-01-01 00:00:00"


def echo_model(prompts: pd.Series) -> pd.Series:
    """A deterministic stand-in for a model: echoes the prompt, then a reply naming its length."""
    return prompts + " \n　len=" + prompts.str.len().astype(str) + "\u001f\n"


@query("echo_strip", f"""
WITH g AS (
  SELECT doc_id, 'doc ' || lang || chr(10) AS prompt,
         CASE WHEN lang IN ('en', 'de') THEN 'doc ' || lang || chr(10) || chr(12288) || ' ' || text || chr(31) || chr(10)
              ELSE text END AS generated
  FROM documents)
SELECT doc_id,
       CASE WHEN starts_with(generated, prompt)
            THEN regexp_replace(substr(generated, length(prompt) + 1), '{STRIP_PATTERN}', '', 'g')
            ELSE generated END AS result
FROM g""")
def echo_strip(spark, d):
    docs = T.read_table(spark, d, "documents", spread_by="doc_id")
    prompt = F.concat(F.lit("doc "), F.col("lang"), F.lit("\n"))
    gen = F.when(F.col("lang").isin("en", "de"), F.concat(prompt, F.lit("　 "), F.col("text"), F.lit("\u001f\n"))) \
        .otherwise(F.col("text"))
    g = docs.select("doc_id", prompt.alias("prompt"), gen.alias("generated"))
    return g.select("doc_id", strip_echo("generated", "prompt").alias("result"))


@query("result_rows", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, event_type AS input_text, props AS generated_text
FROM events""")
def result_rows_q(spark, d):
    ev = T.read_table(spark, d, "events")
    return ev.select("event_id", result_time("ts").alias("timestamp"), F.col("event_type").alias("input_text"),
                     F.col("props").alias("generated_text"))


SCORED_SQL = f"""
WITH {OWN_QA_SQL},
p AS (SELECT p_partkey, {MULTI_SOURCE_SQL} AS prompt FROM own)
SELECT p_partkey, '{CLOCK}' AS timestamp, prompt AS input_text, 'len=' || CAST(length(prompt) AS VARCHAR) AS generated_text
FROM p"""


def prompt_table(spark, d):
    own = own_qa(spark, d)
    return own.select("p_partkey", P.own_qa_prompt(own).alias("prompt"))


@query("score_batch", SCORED_SQL)
def score_batch(spark, d):
    scored = score(prompt_table(spark, d), "prompt", fn=echo_model)
    return result_rows(scored, "prompt", "generated_text", F.lit(CLOCK).cast("timestamp"), keep=["p_partkey"])


def reply_loader(sign: str):
    """A loader as a user writes it: builds the function once per Python worker."""
    def load():
        return lambda prompts: prompts + " " + sign + prompts.str.len().astype(str)
    return load


@query("score_loader", f"""
WITH scored AS ({SCORED_SQL})
SELECT p_partkey, input_text, generated_text AS first_text, replace(generated_text, 'len=', 'n=') AS second_text
FROM scored""")
def score_loader(spark, d):
    """X2 with ``loader=``: two loaders of one factory score the same prompts in one plan."""
    t = score(prompt_table(spark, d), "prompt", loader=reply_loader("len="), out="a")
    t = score(t, "prompt", loader=reply_loader("n="), out="b")
    return t.select("p_partkey", F.col("prompt").alias("input_text"), strip_echo("a", "prompt").alias("first_text"),
                    strip_echo("b", "prompt").alias("second_text"))


@query("score_stream", SCORED_SQL)
def score_stream_q(spark, d):
    """The prompt table lands as files in a shared scratch folder; an availableNow stream
    scores it into a parquet log, which is then read back."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("prompts", "results", "stream-ckpt"))
    prompt_table(spark, d).write.parquet(src)
    q = score_stream(spark, src, "p_partkey BIGINT, prompt STRING", "prompt", sink, ckpt, fn=echo_model,
                     clock=F.lit(CLOCK).cast("timestamp"), keep=["p_partkey"])
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink)


@query("bpe_encode", """
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower(hex(encode(text))), '..'),
                                              lambda x: 3 + CAST('0x' || x AS INTEGER)), ',') AS input_ids
FROM documents""")
def bpe_encode(spark, d):
    docs = T.read_table(spark, d, "documents", spread_by="doc_id")
    ids = tokenizer_ids(spark, "text", byte_level_tokenizer_json())
    return docs.select("doc_id", K.ids_text(ids).alias("input_ids"))
