"""Registered queries: prompt builders (F3-F7) over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prompts as P
from ..sources import tables as T
from .q_dialogue import pairs
from .registry import query
from .sql_common import PAIRS_CTE

PRE = "'以下の参考情報から、質問に答えてください。' || chr(10) || chr(10)"


@query("prompt_context_qa", f"""
SELECT p_partkey,
       {PRE} || '質問：' || coalesce(p_name, '') || chr(10) || '参考情報：' || coalesce(p_brand, '')
         || chr(10) || chr(10) || '回答：' AS prompt,
       p_type AS answer
FROM part""")
def prompt_context_qa(spark, d):
    part = T.read_table(spark, d, "part")
    return part.select("p_partkey", P.context_qa_prompt("p_name", "p_brand").alias("prompt"), F.col("p_type").alias("answer"))


def own_qa(spark, d):
    """Own-QA shaped table from part: slot 1 always, slot 2 never, slot 3 only for large parts."""
    part = T.read_table(spark, d, "part")
    big = F.col("p_size") > 25
    return part.select(
        "p_partkey",
        F.col("p_name").alias("Input"),
        F.col("p_type").alias("Output"),
        F.col("p_brand").alias("Source_1"),
        F.col("p_type").alias("Context_1"),
        F.lit(None).cast("string").alias("Source_2"),
        F.lit("").alias("Context_2"),
        F.when(big, F.lit("size table")).alias("Source_3"),
        F.when(big, F.col("p_size").cast("string")).alias("Context_3"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("Context_know-how"),
    )


OWN_QA_SQL = """
own AS (
  SELECT p_partkey, p_name AS Input, p_type AS Output, p_brand AS Source_1, p_type AS Context_1,
         CAST(NULL AS VARCHAR) AS Source_2, '' AS Context_2,
         CASE WHEN p_size > 25 THEN 'size table' END AS Source_3,
         CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS Context_3,
         'size ' || CAST(p_size AS VARCHAR) AS "Context_know-how"
  FROM part
)"""


def slot_sql(i: int, src: str, ctx: str) -> str:
    s, c = f"coalesce({src}, '')", f"coalesce({ctx}, '')"
    return (f"CASE WHEN {s} <> '' OR {c} <> '' THEN '（参考{i}）' || {s} || chr(10) || {c} || chr(10) || chr(10) "
            f"ELSE '' END")


MULTI_SOURCE_SQL = (
    f"{PRE} || '質問：' || coalesce(Input, '') || chr(10) || chr(10) || '参考情報：' || chr(10) || "
    + " || ".join(slot_sql(i, f"Source_{i}", f"Context_{i}") for i in (1, 2, 3))
    + " || '回答の方針：' || coalesce(\"Context_know-how\", '') || chr(10) || chr(10) || '回答：'")


@query("prompt_multi_source", f"""
WITH {OWN_QA_SQL}
SELECT p_partkey, {MULTI_SOURCE_SQL} AS prompt, Output AS answer FROM own""")
def prompt_multi_source(spark, d):
    own = own_qa(spark, d)
    return own.select("p_partkey", P.own_qa_prompt(own).alias("prompt"), F.col("Output").alias("answer"))


@query("prompt_joint", f"""
WITH {PAIRS_CTE}
SELECT conv_id, turn_num, coalesce(input, '') || coalesce(output, '') AS joint FROM pairs""")
def prompt_joint(spark, d):
    return pairs(spark, d).select("conv_id", "turn_num", P.joint_text("input", "output").alias("joint"))


def multihop(spark, d):
    """Multi-hop QA shaped rows from documents: each line is a context item titled by language
    and line number, its sentences split on '. '; the question names the document, the answer
    is its source."""
    docs = T.read_table(spark, d, "documents", spread_by="doc_id")
    ctx = F.transform(F.split(F.col("text"), "\n"),
                      lambda line, i: F.struct(F.concat(F.col("lang"), F.lit(" "), (i + 1).cast("string")).alias("title"),
                                               F.split(line, "\\. ").alias("sentences")))
    return docs.select("doc_id",
                       F.concat(F.lit("Which source wrote document "), F.col("doc_id").cast("string"), F.lit("?")).alias("question"),
                       ctx.alias("context"), F.col("source").alias("answer"))


MULTIHOP_SQL = """
mh AS (
  SELECT doc_id, 'Which source wrote document ' || CAST(doc_id AS VARCHAR) || '?' AS question,
         list_transform(string_split(text, chr(10)),
                        lambda line, i: {'title': lang || ' ' || CAST(i AS VARCHAR), 'sentences': string_split(line, '. ')})
           AS context,
         source AS answer
  FROM documents
),
flat AS (
  SELECT doc_id, question, answer,
         array_to_string(list_transform(context, lambda x: x.title || chr(10) || array_to_string(x.sentences, ' ')),
                         chr(10) || chr(10)) AS context_text
  FROM mh
)"""


@query("context_flatten", f"WITH {MULTIHOP_SQL} SELECT doc_id, context_text FROM flat")
def context_flatten(spark, d):
    return multihop(spark, d).select("doc_id", P.flatten_context("context").alias("context_text"))


EXTRACTIVE_SQL = ("'Context:' || chr(10) || context_text || chr(10) || 'Question:' || chr(10) || question || chr(10) "
                  "|| 'Answer:' || chr(10) || answer")


@query("prompt_extractive", f"WITH {MULTIHOP_SQL} SELECT doc_id, {EXTRACTIVE_SQL} AS prompt FROM flat")
def prompt_extractive(spark, d):
    m = multihop(spark, d)
    return m.select("doc_id", P.extractive_prompt(P.flatten_context("context"), "question", "answer").alias("prompt"))


PAIR_SQL = f"""
WITH {MULTIHOP_SQL}
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang || chr(10) || source || chr(10) || chr(10) END
               || 'id' || chr(10) || CAST(doc_id AS VARCHAR) AS context_text
FROM documents"""


@query("context_flatten_pairs", PAIR_SQL)
def context_flatten_pairs(spark, d):
    """F6 for [title, paragraph] items: null and one-element items are ignored."""
    docs = T.read_table(spark, d, "documents")
    text = F.col("doc_id").cast("string")
    first = F.when(F.col("doc_id") % 3 != 0, F.array("lang", "source", F.lit("more")))
    items = F.array(first, F.array(F.lit("alone")), F.array(F.lit("id"), text))
    return docs.select("doc_id", P.flatten_context_pairs(items).alias("context_text"))
