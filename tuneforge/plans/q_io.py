"""Registered queries: sinks and sources end to end. Data derived from the given tables is
written with the sinks into a fresh folder under the shared checkpoint folder, read back with the
sources, and compared with SQL over the original tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import shuffle_hash
from ..operators import records, reports, split
from ..session import materialize, scratch_path
from ..operators.dialogue import pair_turns
from ..sinks import writers as W
from ..sinks.batch_log import append_once, read_log
from ..sinks.dialogues import write_dialogues
from ..sinks.ordered import read_ordered, write_ordered
from ..sources import jsonl
from ..sources import tables as T
from ..streaming.score_stream import score_stream
from .q_dialogue import pairs
from .q_score import CLOCK, SCORED_SQL, echo_model, prompt_table, score_batch
from .registry import query
from .sql_common import CORPUS_CTE, CORPUS_SELECT, PAIRS_CTE, hash_sql
from .q_split import SPLIT_SQL

SEED = 42


@query("jsonl_roundtrip", f"""
WITH {CORPUS_CTE}
SELECT CASE WHEN input IS NOT NULL OR output IS NOT NULL THEN 'qa' ELSE 'text' END AS kind, input, output, text
FROM corpus""")
def jsonl_roundtrip(spark, d):
    """K-1 then S3: the corpus as JSON lines (null fields left out), read back, validated and
    dispatched."""
    path = scratch_path(spark, "corpus-jsonl")
    W.write_jsonl(T.corpus(spark, d), path, ["input", "output", "text"])
    rec, _rejects = jsonl.read_jsonl(spark, path, source="corpus")
    kept, _none = records.dispatch_kind(rec)
    return kept.select("kind", "input", "output", "text")


@query("jsonl_keys", f"""
WITH {CORPUS_CTE}
SELECT 3 * count(*) AS n_rows, 3 * count(*) AS n_keys, 2 AS n_files FROM corpus""")
def jsonl_keys(spark, d):
    """S3 keys: the corpus written twice into one folder of lines and once into another, so every line
    repeats inside a folder and across folders; each row has a key of its own."""
    root = scratch_path(spark, "keyed-jsonl")
    lines = T.corpus(spark, d)
    W.write_jsonl(lines.unionByName(lines), f"{root}/a", ["input", "output", "text"])
    W.write_jsonl(lines, f"{root}/b", ["input", "output", "text"])
    rec, _rejects = jsonl.read_jsonl(spark, [f"{root}/a", f"{root}/b"], source="corpus")
    folder = F.element_at(F.split("file", "/"), -2)
    words = materialize(jsonl.key_words(rec.withColumn("folder", folder), "row_key", by=["folder"]))
    rows = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.countDistinct("folder").cast("int").alias("n_files"))
    both = rows.unionByName(jsonl.count_keys(words), allowMissingColumns=True)  # a row each
    return both.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_keys").alias("n_keys"), F.max("n_files").alias("n_files"))


@query("read_splits", SPLIT_SQL + f""",
c AS ({CORPUS_SELECT})
SELECT CASE WHEN s.split = 'train' THEN 'train' ELSE 'validation' END AS split, c.input, c.output, c.text
FROM s JOIN c ON s.source = c.source AND s.row_key = c.row_key""")
def read_splits(spark, d):
    """K-2 then S4: the exact split written as split=train / split=valid folders of JSON lines
    in seeded order, read back as named splits."""
    root = scratch_path(spark, "splits")
    s = split.exact_split(T.corpus(spark, d), "row_key", 0.8, SEED, by=["source"])
    s = s.withColumn("order_key", shuffle_hash(F.concat_ws(":", "source", "row_key"), SEED, "order"))
    W.write_splits(s, root, ["source", "row_key", "input", "output", "text"])
    back = jsonl.read_split_jsonl(spark, root, {"train": "split=train", "validation": "split=valid"})
    return back.select("split", "input", "output", "text")


@query("read_dialogues", f"WITH {PAIRS_CTE} SELECT turn_num, input, output FROM pairs")
def read_dialogues(spark, d):
    """Dialogues written as topic files (JSON arrays of bounded runs of utterances), read back with the
    multi-line reader, then paired over the runs' edges."""
    root = scratch_path(spark, "dialogues")
    write_dialogues(T.utterances(spark, d), root, run_turns=5)  # odd and short: pairs lie across runs
    return pair_turns(jsonl.read_dialogues(spark, f"{root}/topic=*/*.txt")).select("turn_num", "input", "output")


@query("ordered_splits", SPLIT_SQL + f""",
o AS (SELECT *, {hash_sql("source || ':' || row_key", SEED, 'order')} AS order_key FROM s)
SELECT split, source, row_key, row_number() OVER (PARTITION BY split ORDER BY order_key) AS row_no FROM o""")
def ordered_splits(spark, d):
    """K-1/K-2: each split as one ordered output of many parts, read back with every row's place in its split."""
    root = scratch_path(spark, "ordered")
    s = split.exact_split(T.corpus(spark, d), "row_key", 0.8, SEED, by=["source"])
    s = s.withColumn("order_key", shuffle_hash(F.concat_ws(":", "source", "row_key"), SEED, "order"))
    write_ordered(s, root, ["source", "row_key", "input", "output", "text"], "split", "order_key")
    return read_ordered(spark, root, "source string, row_key string").select("split", "source", "row_key", "row_no")


@query("append_once", f"""
WITH once AS ({SCORED_SQL})
SELECT CAST(p_partkey % 2 AS BIGINT) AS batch, timestamp, input_text, generated_text FROM once""")
def append_once_q(spark, d):
    """K-3: scored rows appended in two batches, each handed over twice, as after a stop; each counts once."""
    log = scratch_path(spark, "batch-log")
    rows = score_batch(spark, d).select("p_partkey", "timestamp", "input_text", "generated_text")
    for batch in (0, 1, 1, 0):
        append_once(rows.where(F.col("p_partkey") % 2 == batch).drop("p_partkey"), log, batch)
    return read_log(spark, log, "timestamp string, input_text string, generated_text string")


@query("stream_restart", SCORED_SQL)
def stream_restart(spark, d):
    """The stream stops after its sink took the last batch but before the checkpoint noted it, and is started
    anew with more prompts there. The sink's own log knows the batch by its id, so its rows are neither lost nor doubled."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("prompts", "results", "stream-ckpt"))
    prompts = prompt_table(spark, d)
    for part in (0, 1):
        prompts.where(F.col("p_partkey") % 2 == part).write.mode("append").parquet(src)
        q = score_stream(spark, src, "p_partkey BIGINT, prompt STRING", "prompt", sink, ckpt, fn=echo_model,
                         clock=F.lit(CLOCK).cast("timestamp"), keep=["p_partkey"])
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        if part == 0:
            W.forget_last_commit(spark, ckpt)
    return spark.read.parquet(sink)


@query("append_results", f"""
WITH once AS ({SCORED_SQL})
SELECT timestamp, input_text, generated_text FROM once
UNION ALL SELECT timestamp, input_text, generated_text FROM once""")
def append_results(spark, d):
    """K-3/K-4: the scored rows appended twice to a CSV log inside a run folder, read back."""
    base = scratch_path(spark, "results")
    log = W.run_path(base, "run1")
    rows = score_batch(spark, d).select("timestamp", "input_text", "generated_text")
    W.append_results(rows, log)
    W.append_results(rows, log)
    return (spark.read.option("header", True).option("multiLine", True)
            .schema("timestamp STRING, input_text STRING, generated_text STRING").csv(log))


@query("read_public_qa", """
SELECT CASE WHEN p_size <= 25 THEN 'train' ELSE 'validation' END AS orig_split, p_name AS instruction,
       p_brand AS input, p_type AS output
FROM part""")
def read_public_qa(spark, d):
    """A QA table stored as two split tables (derived from part), read as one."""
    root = scratch_path(spark, "public-qa")
    part = T.read_table(spark, d, "part").select(
        (F.col("p_size") <= 25).alias("is_train"), F.col("p_name").alias("instruction"),
        F.col("p_brand").alias("input"), F.col("p_type").alias("output"))
    paths = {}
    for name, cond in (("train", F.col("is_train")), ("validation", ~F.col("is_train"))):
        paths[name] = f"{root}/{name}"
        part.where(cond).drop("is_train").write.parquet(paths[name])
    return jsonl.read_public_qa(spark, paths).select("orig_split", "instruction", "input", "output")


@query("build_once", SPLIT_SQL + """
SELECT source, CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
       CAST(sum(CASE WHEN split = 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
       count(*) AS n_total
FROM s GROUP BY ROLLUP (source)""")
def build_once(spark, d):
    """K-5: the split report built into a dataset folder on first use and reused after."""
    path = W.dataset_path(scratch_path(spark, "datasets"), "20240101", SEED, 0.8)

    def build():
        return reports.split_report(split.exact_split(T.corpus(spark, d), "row_key", 0.8, SEED, by=["source"]))

    W.build_if_absent(spark, path, build)
    return W.build_if_absent(spark, path, build)  # second call reads the finished build
