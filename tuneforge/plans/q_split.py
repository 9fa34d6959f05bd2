"""Registered queries: merge, exact split, report, samples, caps, holdout, head, shuffle key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import records, reports, split
from ..sources import tables as T
from .registry import query
from .sql_common import CORPUS_CTE, hash_sql

SEED = 42
TRAIN_RATIO = 0.8


@query("merge_sources", f"""
WITH {CORPUS_CTE}
SELECT source, row_key,
       CASE WHEN input IS NOT NULL OR output IS NOT NULL THEN 'qa' WHEN text IS NOT NULL THEN 'text' END AS kind,
       input, output, text
FROM corpus
WHERE input IS NOT NULL OR output IS NOT NULL OR text IS NOT NULL
""")
def merge_sources(spark, d):
    kept, _rejects = records.dispatch_kind(T.corpus(spark, d))
    return kept.select("source", "row_key", "kind", "input", "output", "text")


SPLIT_SQL = f"""
WITH {CORPUS_CTE},
h AS (SELECT source, row_key, {hash_sql('row_key', SEED, 'split')} AS h,
             count(*) OVER (PARTITION BY source) AS n FROM corpus),
s AS (SELECT source, row_key,
             CASE WHEN row_number() OVER (PARTITION BY source ORDER BY h, row_key)
                       <= floor(n * CAST({TRAIN_RATIO} AS DOUBLE)) THEN 'train' ELSE 'valid' END AS split
      FROM h)
"""


def _split(spark, d):
    return split.exact_split(T.corpus(spark, d), "row_key", TRAIN_RATIO, SEED, by=["source"])


@query("split_exact", SPLIT_SQL + "SELECT source, row_key, split FROM s")
def split_exact(spark, d):
    return _split(spark, d).select("source", "row_key", "split")


@query("split_report", SPLIT_SQL + """
SELECT source, CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
       CAST(sum(CASE WHEN split = 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
       count(*) AS n_total
FROM s GROUP BY ROLLUP (source)""")
def split_report(spark, d):
    return reports.split_report(_split(spark, d))


@query("seeded_sample", f"""
WITH {CORPUS_CTE},
h AS (SELECT source, row_key, row_number() OVER (PARTITION BY source
        ORDER BY {hash_sql('row_key', SEED, 'sample')}, row_key) AS rn FROM corpus)
SELECT source, row_key FROM h WHERE rn <= 100""")
def seeded_sample(spark, d):
    return split.sample_exact(T.corpus(spark, d), "row_key", 100, SEED, "sample", by=["source"]).select("source", "row_key")


@query("take_capped", f"""
WITH h AS (
  SELECT 'benchmark' AS source, CAST(item_id AS VARCHAR) AS row_key,
         row_number() OVER (ORDER BY {hash_sql('item_id', SEED, 'cap')}, CAST(item_id AS VARCHAR)) AS rn, 100 AS cap
  FROM benchmark
  UNION ALL
  SELECT 'documents', CAST(doc_id AS VARCHAR),
         row_number() OVER (ORDER BY {hash_sql('doc_id', SEED, 'cap')}, CAST(doc_id AS VARCHAR)), 50
  FROM documents)
SELECT source, row_key FROM h WHERE rn <= cap""")
def take_capped(spark, d):
    bench = records.as_records(T.read_table(spark, d, "benchmark"), "benchmark", "item_id", text="text")
    docs = T.text_records(spark, d)
    return records.concat(split.take_capped(bench, "row_key", 100, SEED, "cap"),
                          split.take_capped(docs, "row_key", 50, SEED, "cap")).select("source", "row_key")


@query("holdout_ceil", f"""
WITH {CORPUS_CTE},
h AS (SELECT source, row_key, {hash_sql('source || chr(31) || row_key', SEED, 'holdout')} AS h,
             source || chr(31) || row_key AS k, count(*) OVER () AS n FROM corpus)
SELECT source, row_key,
       CASE WHEN row_number() OVER (ORDER BY h, k) <= n - ceil((1 - CAST(0.7 AS DOUBLE)) * n)
            THEN 'train' ELSE 'valid' END AS split
FROM h""")
def holdout_ceil(spark, d):
    c = T.corpus(spark, d).withColumn("_k", F.concat_ws("\u001f", "source", "row_key"))
    return split.holdout(c, "_k", 0.7, SEED).select("source", "row_key", "split")


@query("bounded_head", """
SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 120""")
def bounded_head(spark, d):
    return split.bounded_head(T.read_table(spark, d, "documents").select("doc_id", "source"), 120, ["doc_id"])


LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber")


@query("head_half", f"""
SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY {", ".join(LINE_ORDER)} LIMIT (SELECT count(*) // 2 FROM lineitem)""")
def head_half(spark, d):
    """S7 at any size: the earlier half of a table, by selection."""
    lines = T.read_table(spark, d, "lineitem").select(*LINE_ORDER)
    return split.bounded_head(lines, lines.count() // 2, LINE_ORDER, rows=64).select("l_orderkey", "l_linenumber")


@query("positional_half", f"""
WITH n AS (SELECT count(*) AS n FROM documents),
head AS (SELECT doc_id FROM documents ORDER BY source, doc_id LIMIT (SELECT n // 2 FROM n)),
h AS (SELECT doc_id, row_number() OVER (ORDER BY {hash_sql('doc_id', SEED, 'positional')}, CAST(doc_id AS VARCHAR)) AS rn FROM head)
SELECT doc_id, CASE WHEN rn <= n // 4 THEN 'train' ELSE 'valid' END AS split FROM h, n""")
def positional_half(spark, d):
    """T5 at any size: half of the documents in order of their source, a quarter of all to train."""
    docs = T.read_table(spark, d, "documents").select("doc_id", "source")
    n = docs.count()
    return split.positional_split(docs, "doc_id", n // 4, n // 2, ["source"], SEED, rows=64).select("doc_id", "split")


@query("positional_split", f"""
WITH head AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 120),
h AS (SELECT doc_id, row_number() OVER (ORDER BY {hash_sql('doc_id', SEED, 'positional')},
                                        CAST(doc_id AS VARCHAR)) AS rn FROM head)
SELECT doc_id, CASE WHEN rn <= 100 THEN 'train' ELSE 'valid' END AS split FROM h""")
def positional_split(spark, d):
    docs = T.read_table(spark, d, "documents").select("doc_id")
    return split.positional_split(docs, "doc_id", 100, 120, ["doc_id"], SEED).select("doc_id", "split")


@query("shuffle_key", f"""
WITH {CORPUS_CTE}
SELECT source, row_key, {hash_sql('row_key', SEED, 'shuffle')} AS shuffle_key FROM corpus""")
def shuffle_key(spark, d):
    return split.seeded_shuffle(T.corpus(spark, d), "row_key", SEED, "shuffle").select("source", "row_key", "shuffle_key")
