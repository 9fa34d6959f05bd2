"""Registered queries: dialogue pairs, first-wins, value anti-join, dialogue mix, recipe sweep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dialogue, mix, records, recipes, reports, split
from ..session import materialize
from ..sources import tables as T
from .registry import query
from .sql_common import CORPUS_CTE, PAIRS_CTE, hash_sql, pairs_from

SEED = 42
MIX_RATIO = 0.3


def pairs(spark, d):
    """Dialogue pairs with a row key (conv_id:turn_num)."""
    p = dialogue.pair_turns(T.utterances(spark, d), "dlg", "turn_num", "utterance", "pos")
    return p.withColumnRenamed("dlg", "conv_id").withColumn("row_key", F.concat_ws(":", "conv_id", "turn_num"))


@query("dialogue_pairs", f"WITH {PAIRS_CTE} SELECT conv_id, turn_num, input, output FROM pairs")
def dialogue_pairs(spark, d):
    return pairs(spark, d).select("conv_id", "turn_num", "input", "output")


FIRST_WINS_U = """
u_dup AS (
  SELECT conv_id AS dlg, CAST(turn AS INTEGER) AS pos, CAST(turn + 1 AS INTEGER) AS turn_num,
         CASE WHEN role = 'system' THEN NULL ELSE text END AS utterance
  FROM conversations
  UNION ALL
  SELECT conv_id, CAST(turn + 100 AS INTEGER), CAST(turn + 1 AS INTEGER), 'dup:' || text FROM conversations
)"""


@query("dialogue_first_wins", f"WITH {FIRST_WINS_U}, {pairs_from('u_dup', 'p')} "
       "SELECT conv_id, turn_num, input, output FROM p")
def dialogue_first_wins(spark, d):
    """Every turn repeated later in the list (must lose) and system turns null (must win, so
    the pair is skipped)."""
    conv = T.read_table(spark, d, "conversations")
    orig = conv.select(F.col("conv_id").alias("dlg"), F.col("turn").cast("int").alias("pos"),
                       (F.col("turn") + 1).cast("int").alias("turn_num"),
                       F.when(F.col("role") == "system", F.lit(None)).otherwise(F.col("text")).alias("utterance"))
    dup = conv.select(F.col("conv_id").alias("dlg"), (F.col("turn") + 100).cast("int").alias("pos"),
                      (F.col("turn") + 1).cast("int").alias("turn_num"),
                      F.concat(F.lit("dup:"), F.col("text")).alias("utterance"))
    return (dialogue.pair_turns(orig.unionByName(dup), "dlg", "turn_num", "utterance", "pos")
            .select(F.col("dlg").alias("conv_id"), "turn_num", "input", "output"))


POOL_DUP_SQL = f"""
WITH {PAIRS_CTE},
pool AS (
  SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn_num AS VARCHAR) AS row_key, input, output FROM pairs
  UNION ALL
  SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn_num AS VARCHAR) || ':b', input, output FROM pairs
),
ranked AS (SELECT *, row_number() OVER (ORDER BY {hash_sql('row_key', SEED, 'exclude')}, row_key) AS rn FROM pool),
sampled AS (SELECT * FROM ranked WHERE rn <= 100)
SELECT p.row_key, p.input, p.output FROM pool p
WHERE NOT EXISTS (SELECT 1 FROM sampled s
                  WHERE s.input IS NOT DISTINCT FROM p.input AND s.output IS NOT DISTINCT FROM p.output)
"""


@query("exclude_sampled", POOL_DUP_SQL)
def exclude_sampled(spark, d):
    """The pool holds every pair twice (two keys, equal values); removing a sampled pair by
    value must remove both copies."""
    p = pairs(spark, d).select("row_key", "input", "output")
    pool = materialize(p.unionByName(p.withColumn("row_key", F.concat("row_key", F.lit(":b")))))
    sampled = split.sample_exact(pool, "row_key", 100, SEED, "exclude")
    return mix.exclude_sampled(pool, sampled)


def labels_base(spark, d, spread: bool = False):
    """Mix base: documents that carry labels, as text records of source 'labels' (``spread``
    when the texts are tokenised next)."""
    lab = T.read_table(spark, d, "labels").select("doc_id")
    docs = T.read_table(spark, d, "documents", spread_by="doc_id" if spread else None).select("doc_id", "text")
    return records.as_records(docs.join(lab, "doc_id", "left_semi"), "labels", "doc_id", text="text")


def mix_sql(base: str) -> str:
    """CTEs sampling the dialogue pool for a split base relation ``base`` (split, ...): cnt, pool,
    st (train sample) and sv (valid sample, drawn after removing train values)."""
    r = f"CAST({MIX_RATIO} AS DOUBLE)"
    return f"""
cnt AS (SELECT floor(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) * {r}) AS tr_add,
               floor(sum(CASE WHEN split = 'valid' THEN 1 ELSE 0 END) * {r}) AS va_add FROM {base}),
pool AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn_num AS VARCHAR) AS row_key, input, output FROM pairs),
ph AS (SELECT *, row_number() OVER (ORDER BY {hash_sql('row_key', SEED, 'mix_train')}, row_key) AS rn FROM pool),
st AS (SELECT row_key, input, output FROM ph, cnt WHERE rn <= tr_add),
rem AS (SELECT * FROM pool p WHERE NOT EXISTS (
          SELECT 1 FROM st WHERE st.input IS NOT DISTINCT FROM p.input AND st.output IS NOT DISTINCT FROM p.output)),
rh AS (SELECT *, row_number() OVER (ORDER BY {hash_sql('row_key', SEED, 'mix_valid')}, row_key) AS rn FROM rem),
sv AS (SELECT row_key, input, output FROM rh, cnt WHERE rn <= va_add)"""


MIX_SQL = f"""
WITH {PAIRS_CTE},
base AS (SELECT 'labels' AS source, CAST(d.doc_id AS VARCHAR) AS row_key, d.text
         FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)),
bh AS (SELECT *, {hash_sql('row_key', SEED, 'split')} AS h, count(*) OVER () AS n FROM base),
bs AS (SELECT source, row_key, text,
              CASE WHEN row_number() OVER (ORDER BY h, row_key) <= floor(n * CAST(0.8 AS DOUBLE))
                   THEN 'train' ELSE 'valid' END AS split FROM bh),
{mix_sql('bs')}
SELECT split, 'base' AS origin, row_key, CAST(NULL AS VARCHAR) AS input, CAST(NULL AS VARCHAR) AS output, text FROM bs
UNION ALL SELECT 'train', 'pool', row_key, input, output, CAST(NULL AS VARCHAR) FROM st
UNION ALL SELECT 'valid', 'pool', row_key, input, output, CAST(NULL AS VARCHAR) FROM sv
"""


@query("mix_dialogue", MIX_SQL)
def mix_dialogue(spark, d):
    totals: dict = {}
    base = split.exact_split(labels_base(spark, d), "row_key", 0.8, SEED, by=["source"], totals=totals)
    pool = pairs(spark, d).select("row_key", "input", "output")
    out = mix.mix_in(base, pool, "row_key", MIX_RATIO, SEED, base_sizes=split.split_sizes(totals))
    return out.select("split", "origin", "row_key", "input", "output", "text")


MIX_REQUIRE_SQL = f"""
WITH {CORPUS_CTE}, {PAIRS_CTE},
bases AS (
  SELECT 'documents' AS base, row_key FROM corpus WHERE source = 'documents'
  UNION ALL
  SELECT 'labels', CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
),
sizes AS (SELECT base, count(*) AS n FROM bases GROUP BY base),
need AS (SELECT base, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n_train,
                n - CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n_valid FROM sizes)
SELECT base, n_train, n_valid,
       CAST(floor(n_train * CAST({MIX_RATIO} AS DOUBLE)) AS BIGINT) AS need_train,
       CAST(floor(n_valid * CAST({MIX_RATIO} AS DOUBLE)) AS BIGINT) AS need_valid,
       (SELECT count(*) FROM pairs) AS n_pool,
       floor(n_train * CAST({MIX_RATIO} AS DOUBLE)) + floor(n_valid * CAST({MIX_RATIO} AS DOUBLE))
         <= (SELECT count(*) FROM pairs) AS enough
FROM need
"""


@query("mix_require", MIX_REQUIRE_SQL)
def mix_require(spark, d):
    """T7 as a report: for each candidate base, the rows the mix needs against the pool size
    (documents as base cannot be served at sf0.01, labels can)."""
    docs = T.text_records(spark, d).select(F.lit("documents").alias("base"), "row_key")
    lab = labels_base(spark, d).select(F.lit("labels").alias("base"), "row_key")
    sizes = reports.size_of(docs.unionByName(lab), ["base"])
    n_pool = pairs(spark, d).agg(F.count(F.lit(1))).scalar()  # scalar subquery: one value
    r = F.lit(MIX_RATIO)
    out = (sizes.withColumn("n_train", F.floor(F.col("n").cast("double") * F.lit(0.8)).cast("long"))
           .withColumn("n_valid", F.col("n") - F.col("n_train"))
           .withColumn("need_train", F.floor(F.col("n_train") * r).cast("long"))
           .withColumn("need_valid", F.floor(F.col("n_valid") * r).cast("long"))
           .withColumn("n_pool", n_pool)
           .withColumn("enough", F.col("need_train") + F.col("need_valid") <= F.col("n_pool")))
    return out.select("base", "n_train", "n_valid", "need_train", "need_valid", "n_pool", "enough")


RECIPES = recipes.recipe_list(seed=[42, 7], train_ratio=[0.8, 0.7])


def _recipe_values_sql():
    rows = ", ".join(f"({r['recipe_id']}, {r['seed']}, CAST({r['train_ratio']} AS DOUBLE))" for r in RECIPES)
    return f"recipes(recipe_id, seed, train_ratio) AS (VALUES {rows})"


@query("recipe_sweep", f"""
WITH {CORPUS_CTE}, {_recipe_values_sql()},
x AS (SELECT r.recipe_id, r.seed, r.train_ratio, c.source, c.row_key,
             md5(concat_ws(':', CAST(r.seed AS VARCHAR), 'split', c.row_key)) AS h
      FROM corpus c CROSS JOIN recipes r),
y AS (SELECT *, count(*) OVER (PARTITION BY recipe_id, source) AS n,
             row_number() OVER (PARTITION BY recipe_id, source ORDER BY h, row_key) AS rn FROM x)
SELECT CAST(recipe_id AS BIGINT) AS recipe_id, CAST(seed AS BIGINT) AS seed, train_ratio, source, row_key,
       CASE WHEN rn <= floor(n * train_ratio) THEN 'train' ELSE 'valid' END AS split
FROM y""")
def recipe_sweep(spark, d):
    """J4 x T2: all recipes cut in one pass, then listed row by row."""
    rows = T.corpus(spark, d).select("source", "row_key")
    out = recipes.each_recipe(recipes.recipe_cut(rows, "row_key", RECIPES), RECIPES)
    return out.select(F.col("recipe_id").cast("long").alias("recipe_id"), F.col("seed").cast("long").alias("seed"),
                      "train_ratio", "source", "row_key", "split")


WIDE = recipes.recipe_list(seed=list(range(20)), train_ratio=[i / 10 for i in range(11)])


@query("recipe_labels", f"""
WITH {CORPUS_CTE},
x AS (SELECT r.seed, c.source, c.row_key, md5(concat_ws(':', CAST(r.seed AS VARCHAR), 'split', c.row_key)) AS h
      FROM corpus c CROSS JOIN (SELECT unnest(range(20)) AS seed) r),
y AS (SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY h, row_key) AS rn FROM x WINDOW w AS (PARTITION BY seed, source))
SELECT source, row_key, string_agg(list_aggregate(list_transform(range(11), lambda i: CASE WHEN rn <= floor(n * (CAST(i AS DOUBLE) / 10)) THEN '1' ELSE '0' END),
                                   'string_agg', ''), '' ORDER BY seed) AS labels
FROM y GROUP BY source, row_key""")
def recipe_labels(spark, d):
    """220 recipes (20 seeds, 11 ratios) as one string of labels per row."""
    rows = T.corpus(spark, d).select("source", "row_key")
    labels = F.array_join(F.transform("in_train", lambda x: F.when(x, F.lit("1")).otherwise(F.lit("0"))), "")
    return recipes.recipe_cut(rows, "row_key", WIDE).select("source", "row_key", labels.alias("labels"))


@query("recipe_sizes", f"""
WITH {CORPUS_CTE}, n AS (SELECT source, count(*) AS n FROM corpus GROUP BY source),
r AS (SELECT 11 * s + i + 1 AS recipe_id, CAST(i AS DOUBLE) / 10 AS ratio FROM (SELECT unnest(range(20)) AS s), (SELECT unnest(range(11)) AS i))
SELECT source, recipe_id, CAST(floor(n * ratio) AS BIGINT) AS n_train, CAST(n - floor(n * ratio) AS BIGINT) AS n_valid FROM n, r""")
def recipe_sizes(spark, d):
    rows = T.corpus(spark, d).select("source", "row_key")
    return recipes.recipe_sizes(recipes.recipe_thresholds(rows, "row_key", WIDE), WIDE)
