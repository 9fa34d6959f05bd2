"""The reference's end-to-end flows, composed from the operators.

* ``make_dataset``: QA and text sheets (cell tables) -> records -> per-source exact split -> mix
  of dialogue pairs -> optionally written as split folders under a build guard.
* ``sft_dataset``: capped public QA + capped own QA -> prompts -> encoded examples with masked
  labels -> holdout.
* ``prompt_results``: a prompt table -> a user's function -> result rows (batch); see
  ``streaming.score_stream`` for the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import prompts as P
from .functions import tokens as K
from .operators import mix, records, sft, sheets, split
from .operators.score import ScoreFn, result_rows, score
from .session import materialize
from .sinks import writers as W


def sheet_source(cells: DataFrame, kind: str, source: str, header_row: int = 5) -> tuple[DataFrame, DataFrame]:
    """Cells of one folder of sheets (QA or text) -> records (source, row_key, input, output,
    text) and the reject report of sheets without the needed columns."""
    ok, rejects = sheets.drop_unmapped_sheets(cells, sheets.resolve_columns(cells, header_row, kind), kind)
    rec = sheets.sheet_records(cells, ok, header_row, kind)
    key = F.concat_ws(":", "file", "sheet", F.col("row").cast("string"))
    if kind == "qa":
        out = records.as_records(rec, source, key, input="input", output="output")
    else:
        out = records.as_records(rec, source, key, text="text")
    return out, rejects


def make_dataset(qa_cells: DataFrame | None, text_cells: DataFrame | None, pool: DataFrame,
                 train_ratio: float = 0.8, seed: int = 42, mix_ratio: float = 0.3, header_row: int = 5,
                 root: str | None = None, makedate: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Path A. ``pool`` holds dialogue pairs (row_key, input, output). Returns the mixed split
    (split, origin, source, row_key, input, output, text, order_key) and the report of sheets without the
    needed columns. With ``root`` and ``makedate`` the result is written once per set of parameters as
    ``split=`` folders of JSON lines (reused when already built) and read back with the same columns."""
    parts, rejects = [], []
    for cells, kind, source in ((qa_cells, "qa", "QA"), (text_cells, "text", "Text")):
        if cells is not None:
            rec, bad = sheet_source(cells, kind, source, header_row)
            parts.append(rec)
            rejects.append(bad)
    if not parts:
        raise ValueError("give qa_cells, text_cells or both")
    rejects = records.concat(*rejects)
    path = None
    if root is not None and makedate is not None:
        path = W.dataset_path(root, makedate, seed, train_ratio, mix=mix_ratio, header_row=header_row)
        if W.path_exists(pool.sparkSession, f"{path}/_SUCCESS"):
            return read_dataset(pool.sparkSession, path), rejects
    # records come from a shuffle-heavy aggregation over all cells and feed several jobs (the
    # cut's passes, the base counts, the final write): write them once
    corpus = materialize(records.merge_sources(*parts))
    totals: dict = {}
    base = split.exact_split(corpus, "row_key", train_ratio, seed, by=["source"], totals=totals)
    out = mix.mix_in(base, pool.withColumn("source", F.lit("dialogue")), "row_key", mix_ratio, seed,
                     base_sizes=split.split_sizes(totals))
    out = out.select(*DATASET_COLUMNS)
    if path is None:
        return out, rejects
    W.write_splits(out, path, [c for c in DATASET_COLUMNS if c != "split"], mode="overwrite")
    return read_dataset(out.sparkSession, path), rejects


DATASET_COLUMNS = ["split", "origin", "source", "row_key", "input", "output", "text", "order_key"]


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A dataset that ``make_dataset`` wrote."""
    return spark.read.schema(", ".join(f"{c} string" for c in DATASET_COLUMNS)).json(path).select(*DATASET_COLUMNS)


def split_examples(root_or_records: DataFrame, eos_pad: int, max_len: int = 1024) -> DataFrame:
    """Path A': records of named splits (split, row_key, input, output, text) -> fixed-length examples.
    Rows with text are labelled everywhere, question-answer rows after the question; a row with neither
    is dropped by ``dispatch_kind``."""
    kept, _ = records.dispatch_kind(root_or_records)
    text = F.when(F.col("kind") == "qa", P.joint_text("input", "output")).otherwise(F.col("text"))
    ids, mask = K.encode_fixed(K.codepoint_ids(text, max_len), max_len, eos_pad)
    d = kept.select("*", ids.alias("input_ids"), mask.alias("attention_mask"))
    n_prompt = K.codepoint_count("input")
    labels = F.when(F.col("kind") == "qa", K.label_joint("input_ids", n_prompt.cast("int"), max_len)).otherwise(
        K.label_all("input_ids", "attention_mask"))
    return d.select("split", "row_key", "kind", "input_ids", "attention_mask", labels.alias("labels"))


def multihop_dataset(rows: DataFrame, key: str, n_train: int, n_total: int, order, max_len: int = 1024, pad: int = 0,
                     seed: int = 42, context: Column | str = "context", pairs: bool = False) -> DataFrame:
    """Path C: head in ``order`` -> positional split -> flattened context -> extractive prompt -> fixed-length
    ids -> labels from the prompt's end. ``rows`` has question, answer and context (structs, or arrays with
    ``pairs``)."""
    d = split.positional_split(rows, key, n_train, n_total, order, seed)
    flat = P.flatten_context_pairs(context) if pairs else P.flatten_context(context)
    prompt = P.extractive_prompt(flat, "question", "answer")
    ids, mask = K.encode_fixed(K.codepoint_ids(prompt, max_len), max_len, pad)
    d = d.select("*", ids.alias("input_ids"), mask.alias("attention_mask"))
    labels = K.label_after_prompt("input_ids", K.codepoint_ids("answer", max_len), pad, max_len)
    return d.select("split", key, "input_ids", "attention_mask", labels.alias("labels"))


def _context_qa(df: DataFrame) -> Column:
    return P.context_qa_prompt("instruction", "input")


def sft_dataset(public: DataFrame, own: DataFrame, public_cap: int, own_cap: int, train_ratio: float = 0.8,
                seed: int = 42, eos: int = 2, max_len: int = 2048,
                tokenize: Callable[[Column], Column] | None = None,
                public_prompt: P.PromptBuilder = _context_qa, own_prompt: P.PromptBuilder = P.own_qa_prompt,
                public_answer: str = "output", own_answer: str = "Output") -> DataFrame:
    """Path B. ``public``: (row_key, instruction, input, output); ``own``: (row_key, Input,
    Output, Source_i, Context_i, Context_know-how[, No]). Caps come before encoding; the union
    is held out with validation = ceil((1 - ratio) * n). Prompt builders are pluggable (X3): any
    ``DataFrame -> Column``; the defaults are the two shipped templates."""
    kw = {"eos": eos, "max_len": max_len}
    if tokenize is not None:
        kw["tokenize"] = tokenize
    pub = split.take_capped(records.fill_missing(public), "row_key", public_cap, seed, "cap_public")
    own = split.take_capped(records.fill_missing(records.drop_if_present(own, "No")), "row_key", own_cap, seed, "cap_own")
    pub_tok = sft.sft_encode(pub, public_prompt(pub), F.col(public_answer), **kw)
    own_tok = sft.sft_encode(own, own_prompt(own), F.col(own_answer), **kw)
    cols = ["row_key", "input_ids", "labels", "n_supervised"]
    full = records.concat(pub_tok.select(F.lit("public").alias("origin"), *cols),
                          own_tok.select(F.lit("own").alias("origin"), *cols))
    full = materialize(full.withColumn("_tf_key", F.concat_ws(":", "origin", "row_key")))
    return split.holdout(full, "_tf_key", train_ratio, seed).drop("_tf_key")


def prompt_results(table: DataFrame, fn: ScoreFn | None = None, loader=None, clock: Column | None = None,
                   keep=(), builder: P.PromptBuilder = P.own_qa_prompt) -> DataFrame:
    """Path D (batch): prompts built from an own-QA table (``builder``, X3), scored, echo
    stripped, timestamped."""
    t = records.drop_if_present(records.fill_missing(table), "No")
    scored = score(t.select(*keep, builder(t).alias("prompt")), "prompt", fn=fn, loader=loader)
    return result_rows(scored, "prompt", "generated_text", clock if clock is not None else F.current_timestamp(), keep)

