"""Registered queries: encoding and label construction (X1 code-point backend, F10-F18, A3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prompts as P
from ..functions import tokens as K
from ..sources import tables as T
from .q_dialogue import pairs
from .q_prompts import EXTRACTIVE_SQL, MULTIHOP_SQL, multihop
from .registry import query
from .sql_common import PAIRS_CTE

MAX_LEN = 1024
LONG_LEN = 2048
PAD = 0
EOS = 2


def cp_sql(text: str) -> str:
    """Code-point ids in DuckDB."""
    return f"list_transform(list_filter(string_split(coalesce({text}, ''), ''), lambda c: c <> ''), lambda c: unicode(c))"


def fixed_sql(ids: str, n: int, pad: int) -> str:
    return f"(list_slice({ids}, 1, {n}) || repeat([{pad}], {n} - len(list_slice({ids}, 1, {n}))))"


def mask_sql(ids: str, n: int) -> str:
    m = f"len(list_slice({ids}, 1, {n}))"
    return f"(repeat([1], {m}) || repeat([0], {n} - {m}))"


def txt(a: str) -> str:
    return f"array_to_string({a}, ',')"


@query("encode_fixed", f"""
WITH t AS (SELECT doc_id, {cp_sql('text')} AS ids FROM documents)
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, {txt(fixed_sql('ids', MAX_LEN, PAD))} AS input_ids,
       {txt(mask_sql('ids', MAX_LEN))} AS attention_mask
FROM t""")
def encode_fixed(spark, d):
    docs = T.read_table(spark, d, "documents", spread_by="doc_id")
    t = docs.select("doc_id", K.codepoint_count("text").alias("n_tokens"),
                    K.codepoint_ids("text", MAX_LEN).alias("ids"))
    ids, mask = K.encode_fixed("ids", MAX_LEN, PAD)
    return t.select("doc_id", "n_tokens", K.ids_text(ids).alias("input_ids"), K.ids_text(mask).alias("attention_mask"))


@query("pad_fallback", f"""
WITH t AS (SELECT page_id, {cp_sql('html')} AS ids FROM pages)
SELECT page_id, {txt(fixed_sql('ids', MAX_LEN, EOS))} AS input_ids FROM t""")
def pad_fallback(spark, d):
    """Pages encoded with a tokenizer that defines no pad id: padding uses the eos id."""
    pad = K.pad_or_eos(None, EOS)
    t = T.read_table(spark, d, "pages", spread_by="page_id").select("page_id", K.codepoint_ids("html", MAX_LEN).alias("ids"))
    ids, _mask = K.encode_fixed("ids", MAX_LEN, pad)
    return t.select("page_id", K.ids_text(ids).alias("input_ids"))


@query("label_all", f"""
WITH t AS (SELECT doc_id, {fixed_sql(cp_sql('text'), MAX_LEN, PAD)} AS ids,
                  {mask_sql(cp_sql('text'), MAX_LEN)} AS mask FROM documents)
SELECT doc_id, {txt('ids')} AS labels_all,
       {txt("list_transform(ids, lambda x, i: CASE WHEN mask[i] = 1 THEN x ELSE -100 END)")} AS labels_masked
FROM t""")
def label_all(spark, d):
    t = T.read_table(spark, d, "documents", spread_by="doc_id").select("doc_id", K.codepoint_ids("text", MAX_LEN).alias("ids"))
    ids, mask = K.encode_fixed("ids", MAX_LEN, PAD)
    t = t.select("doc_id", ids.alias("ids"), mask.alias("mask"))
    return t.select("doc_id", K.ids_text(K.label_all("ids", mask_pad=False)).alias("labels_all"),
                    K.ids_text(K.label_all("ids", "mask", mask_pad=True)).alias("labels_masked"))


@query("label_answer_only", f"""
WITH {PAIRS_CTE},
t AS (SELECT conv_id, turn_num, {cp_sql('input')} AS p, {cp_sql('output')} || [{EOS}] AS a FROM pairs),
u AS (SELECT conv_id, turn_num, list_slice(p || a, 1, {MAX_LEN}) AS ids,
             list_slice(repeat([-100], len(p)) || a, 1, {MAX_LEN}) AS labels FROM t)
SELECT conv_id, turn_num, {txt('ids')} AS input_ids, {txt('labels')} AS labels,
       CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS n_supervised
FROM u""")
def label_answer_only(spark, d):
    t = pairs(spark, d).select("conv_id", "turn_num", K.codepoint_ids("input").alias("p"),
                               K.append_eos(K.codepoint_ids("output"), EOS).alias("a"))
    u = t.select("conv_id", "turn_num", K.truncate_right(F.concat("p", "a"), MAX_LEN).alias("ids"),
                 K.truncate_right(K.label_answer_only("p", "a"), MAX_LEN).alias("labels"))
    return u.select("conv_id", "turn_num", K.ids_text("ids").alias("input_ids"), K.ids_text("labels").alias("labels"),
                    K.n_supervised("labels").alias("n_supervised"))


@query("label_joint", f"""
WITH {PAIRS_CTE},
t AS (SELECT conv_id, turn_num, {fixed_sql(cp_sql("coalesce(input, '') || coalesce(output, '')"), MAX_LEN, PAD)} AS ids,
             len({cp_sql('input')}) AS n FROM pairs)
SELECT conv_id, turn_num, {txt('ids')} AS input_ids,
       {txt(f"list_slice(repeat([-100], n) || list_slice(ids, n + 1, {MAX_LEN}), 1, {MAX_LEN})")} AS labels
FROM t""")
def label_joint(spark, d):
    """Joint mode: prompt length from encoding the prompt alone."""
    p = pairs(spark, d)
    ids, _mask = K.encode_fixed(K.codepoint_ids(P.joint_text("input", "output"), MAX_LEN), MAX_LEN, PAD)
    t = p.select("conv_id", "turn_num", ids.alias("ids"), K.codepoint_count("input").alias("n"))
    return t.select("conv_id", "turn_num", K.ids_text("ids").alias("input_ids"),
                    K.ids_text(K.label_joint("ids", F.col("n"), MAX_LEN)).alias("labels"))


@query("label_after_prompt", f"""
WITH {MULTIHOP_SQL},
t AS (SELECT doc_id, {fixed_sql(cp_sql(EXTRACTIVE_SQL), LONG_LEN, PAD)} AS ids, {cp_sql('answer')} AS a FROM flat),
u AS (SELECT doc_id, ids, a, len(list_filter(ids, lambda x: x <> {PAD})) AS n FROM t)
SELECT doc_id, CAST(n AS INTEGER) AS n_prompt,
       {txt(f"list_slice(repeat([-100], n) || list_slice(a, 1, {LONG_LEN}) || repeat([-100], {LONG_LEN}), 1, {LONG_LEN})")}
         AS labels
FROM u""")
def label_after_prompt(spark, d):
    """Multi-hop path: the answer ids are written right after the non-pad prompt tokens."""
    m = multihop(spark, d)
    full = P.extractive_prompt(P.flatten_context("context"), "question", "answer")
    ids, _mask = K.encode_fixed(K.codepoint_ids(full, LONG_LEN), LONG_LEN, PAD)
    t = m.select("doc_id", ids.alias("ids"), K.codepoint_ids("answer").alias("a"))
    return t.select("doc_id", K.non_pad_count("ids", PAD).alias("n_prompt"),
                    K.ids_text(K.label_after_prompt("ids", "a", PAD, LONG_LEN)).alias("labels"))
