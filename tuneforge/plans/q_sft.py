"""Registered queries: padded batches (B1) and the supervised build of path B (cap -> prompt ->
encode -> label -> union -> holdout)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens as K
from .. import flows
from ..operators import batches, split
from ..sources import tables as T
from .q_dialogue import labels_base, pairs
from .q_prompts import EXTRACTIVE_SQL, MULTIHOP_SQL, PRE, multihop, slot_sql
from .q_tokens import LONG_LEN, MAX_LEN, cp_sql, txt
from .registry import query
from .sql_common import CORPUS_CTE, PAIRS_CTE, hash_sql

SEED = 42
EOS = 2
PUBLIC_CAP = 100
OWN_CAP = 50


@query("pad_batches", f"""
WITH base AS (SELECT 'labels' AS source, CAST(d.doc_id AS VARCHAR) AS row_key, d.text
              FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)),
bh AS (SELECT *, {hash_sql('row_key', SEED, 'split')} AS h, count(*) OVER () AS n FROM base),
bs AS (SELECT row_key, text,
              CASE WHEN row_number() OVER (ORDER BY h, row_key) <= floor(n * CAST(0.8 AS DOUBLE))
                   THEN 'train' ELSE 'valid' END AS split FROM bh),
t AS (SELECT split, row_key, {cp_sql('text')} AS ids, {hash_sql('row_key', SEED, 'batch')} AS h FROM bs),
b AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY h, row_key) - 1) / 2) AS BIGINT)
               AS batch FROM t),
e AS (SELECT *, max(len(ids)) OVER (PARTITION BY split, batch) AS bl FROM b)
SELECT split, batch, CAST(bl AS INTEGER) AS batch_len, row_key,
       {txt('ids || repeat([0], bl - len(ids))')} AS input_ids,
       {txt('ids || repeat([-100], bl - len(ids))')} AS labels,
       {txt('repeat([1], len(ids)) || repeat([0], bl - len(ids))')} AS attention_mask
FROM e""")
def pad_batches(spark, d):
    base = split.exact_split(labels_base(spark, d, spread=True), "row_key", 0.8, SEED, by=["source"])
    ids = K.codepoint_ids("text")
    t = base.select("split", "row_key", ids.alias("input_ids"), ids.alias("labels"))
    b = batches.pad_batches(t, "row_key", size=2, pad=0, seed=SEED)
    return b.select("split", "batch", "batch_len", "row_key", K.ids_text("input_ids").alias("input_ids"),
                    K.ids_text("labels").alias("labels"), K.ids_text("attention_mask").alias("attention_mask"))


def own_from_pairs(spark, d):
    """Own-QA shaped rows from dialogue pairs (source slot 1 names the conversation)."""
    p = pairs(spark, d)
    return p.select("row_key", F.col("input").alias("Input"), F.col("output").alias("Output"),
                    F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("Source_1"),
                    F.lit(None).cast("string").alias("Context_1"),
                    F.concat(F.lit("turn "), F.col("turn_num").cast("string")).alias("Context_know-how"))


def sft_rows(spark, d):
    """Path B: capped public QA (part) and capped own QA (dialogue pairs), prompted, encoded,
    unioned, held out."""
    public = T.read_table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("row_key"), F.col("p_name").alias("instruction"),
        F.col("p_brand").alias("input"), F.col("p_type").alias("output"))
    return flows.sft_dataset(public, own_from_pairs(spark, d), PUBLIC_CAP, OWN_CAP, 0.8, SEED, EOS, MAX_LEN)


OWN_PROMPT_SQL = (f"{PRE} || '質問：' || coalesce(Input, '') || chr(10) || chr(10) || '参考情報：' || chr(10) || "
                  + slot_sql(1, "Source_1", "Context_1")
                  + " || '回答の方針：' || coalesce(\"Context_know-how\", '') || chr(10) || chr(10) || '回答：'")


@query("sft_build", f"""
WITH {PAIRS_CTE},
public AS (
  SELECT CAST(p_partkey AS VARCHAR) AS row_key, coalesce(p_name, '') AS instruction, coalesce(p_brand, '') AS input,
         coalesce(p_type, '') AS output,
         row_number() OVER (ORDER BY {hash_sql('p_partkey', SEED, 'cap_public')}, CAST(p_partkey AS VARCHAR)) AS rn
  FROM part),
own AS (
  SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn_num AS VARCHAR) AS row_key, coalesce(input, '') AS Input,
         coalesce(output, '') AS Output, 'conversation ' || CAST(conv_id AS VARCHAR) AS Source_1,
         '' AS Context_1, 'turn ' || CAST(turn_num AS VARCHAR) AS "Context_know-how"
  FROM pairs),
own_r AS (SELECT *, row_number() OVER (ORDER BY {hash_sql('row_key', SEED, 'cap_own')}, row_key) AS rn FROM own),
seg AS (
  SELECT 'public' AS origin, row_key,
         {PRE} || '質問：' || instruction || chr(10) || '参考情報：' || input || chr(10) || chr(10) || '回答：' AS prompt,
         output AS answer
  FROM public WHERE rn <= {PUBLIC_CAP}
  UNION ALL
  SELECT 'own', row_key, {OWN_PROMPT_SQL}, Output FROM own_r WHERE rn <= {OWN_CAP}),
tok AS (SELECT origin, row_key, {cp_sql('prompt')} AS p, {cp_sql('answer')} || [{EOS}] AS a FROM seg),
enc AS (SELECT origin, row_key, list_slice(p || a, 1, {MAX_LEN}) AS ids,
               list_slice(repeat([-100], len(p)) || a, 1, {MAX_LEN}) AS labels FROM tok),
h AS (SELECT *, {hash_sql("origin || ':' || row_key", SEED, 'holdout')} AS hh, origin || ':' || row_key AS k,
             count(*) OVER () AS n FROM enc)
SELECT origin, row_key, {txt('ids')} AS input_ids, {txt('labels')} AS labels,
       CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS n_supervised,
       CASE WHEN row_number() OVER (ORDER BY hh, k) <= n - ceil((1 - CAST(0.8 AS DOUBLE)) * n)
            THEN 'train' ELSE 'valid' END AS split
FROM h""")
def sft_build(spark, d):
    r = sft_rows(spark, d)
    return r.select("origin", "row_key", K.ids_text("input_ids").alias("input_ids"), K.ids_text("labels").alias("labels"),
                    "n_supervised", "split")


HOP_TRAIN, HOP_TOTAL, HOP_LEN = 60, 100, LONG_LEN


@query("multihop_build", f"""
WITH {MULTIHOP_SQL},
head AS (SELECT *, CAST(doc_id AS VARCHAR) AS row_key FROM flat ORDER BY doc_id LIMIT {HOP_TOTAL}),
p AS (SELECT row_key, answer, {EXTRACTIVE_SQL} AS prompt,
             CASE WHEN row_number() OVER (ORDER BY {hash_sql('row_key', SEED, 'positional')}, row_key) <= {HOP_TRAIN}
                  THEN 'train' ELSE 'valid' END AS split FROM head),
t AS (SELECT split, row_key, list_slice({cp_sql('prompt')}, 1, {HOP_LEN}) AS ids,
             list_slice({cp_sql('answer')}, 1, {HOP_LEN}) AS a FROM p)
SELECT split, row_key, {txt(f'ids || repeat([0], {HOP_LEN} - len(ids))')} AS input_ids,
       {txt(f'repeat([1], len(ids)) || repeat([0], {HOP_LEN} - len(ids))')} AS attention_mask,
       {txt(f'list_slice(repeat([-100], len(ids)) || a || repeat([-100], {HOP_LEN}), 1, {HOP_LEN})')} AS labels
FROM t""")
def multihop_build(spark, d):
    """Path C: head -> positional split -> flatten -> extractive prompt -> fixed ids -> labels after the prompt."""
    rows = multihop(spark, d).withColumn("row_key", F.col("doc_id").cast("string"))
    out = flows.multihop_dataset(rows, "row_key", HOP_TRAIN, HOP_TOTAL, ["doc_id"], HOP_LEN, 0, SEED)
    return out.select("split", "row_key", K.ids_text("input_ids").alias("input_ids"),
                      K.ids_text("attention_mask").alias("attention_mask"), K.ids_text("labels").alias("labels"))


ENCODE_LEN = MAX_LEN


@query("corpus_encode", f"""
WITH {CORPUS_CTE},
k AS (SELECT source, row_key, CASE WHEN input IS NOT NULL OR output IS NOT NULL THEN 'qa' ELSE 'text' END AS kind, input, output, text
      FROM corpus),
t AS (SELECT *, list_slice({cp_sql("CASE WHEN kind = 'qa' THEN coalesce(input, '') || coalesce(output, '') ELSE text END")},
                           1, {ENCODE_LEN}) AS ids FROM k),
f AS (SELECT *, ids || repeat([0], {ENCODE_LEN} - len(ids)) AS full_ids FROM t)
SELECT source || ':' || row_key AS row_key, kind, {txt('full_ids')} AS input_ids,
       {txt(f'repeat([1], len(ids)) || repeat([0], {ENCODE_LEN} - len(ids))')} AS attention_mask,
       CASE WHEN kind = 'qa' THEN {txt(f"list_slice(repeat([-100], length(coalesce(input, ''))) || list_slice(full_ids, length(coalesce(input, '')) + 1, {ENCODE_LEN}), 1, {ENCODE_LEN})")}
            ELSE {txt(f'ids || repeat([-100], {ENCODE_LEN} - len(ids))')} END AS labels
FROM f""")
def corpus_encode(spark, d):
    """Path A': records of a split -> dispatch -> fixed ids -> joint labels (QA) or labels everywhere (text)."""
    rows = T.corpus(spark, d, spread=True).withColumn("split", F.lit("train")).withColumn("row_key", F.concat_ws(":", "source", "row_key"))
    out = flows.split_examples(rows, 0, ENCODE_LEN)
    return out.select("row_key", "kind", K.ids_text("input_ids").alias("input_ids"),
                      K.ids_text("attention_mask").alias("attention_mask"), K.ids_text("labels").alias("labels"))
