"""JSON-lines, dialogue JSON and public QA tables as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.json_valid import json_valid
from ..functions.text import py_strip
from ..operators.records import concat
from ..session import materialize
from .lines import number_lines, scan_lines

LINE_SALTS = 64
RECORD_SCHEMA = "input STRING, output STRING, text STRING"
DIALOGUE_SCHEMA = "dlg STRING, first LONG, utterances ARRAY<STRUCT<turn_num: INT, utterance: STRING>>"


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist; missing ones are skipped with a warning (error if none is left)."""
    import warnings

    from ..sinks.writers import path_exists

    kept = [p for p in paths if path_exists(spark, p)]
    for p in paths:
        if p not in kept:
            warnings.warn(f"missing input skipped: {p}", stacklevel=2)
    if not kept:
        raise FileNotFoundError(f"none of the inputs exists: {list(paths)}")
    return kept


def read_lines(spark: SparkSession, paths: str | Sequence[str], skip_missing: bool = True) -> DataFrame:
    """Lines of text files with their file path: (file, line). Missing inputs are skipped with
    a warning unless ``skip_missing`` is False."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if skip_missing and not any(ch in p for p in paths for ch in "*?["):
        paths = existing(spark, paths)
    return (spark.read.text(paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")))


def drop_blank_lines(df: DataFrame, raw: str = "line") -> DataFrame:
    """Strip (Python whitespace semantics) and drop empty lines."""
    return df.withColumn(raw, py_strip(raw)).where(F.length(raw) > 0)


def filter_valid_json(df: DataFrame, raw: str = "line") -> tuple[DataFrame, DataFrame]:
    """(valid lines, reject report). The report counts invalid lines per (file, line hash):
    a distributed text scan has no line numbers."""
    # written once: both outputs read the tags instead of running the Python check twice
    tagged = materialize(df.withColumn("_tf_valid", json_valid(raw)))
    valid = tagged.where("_tf_valid").drop("_tf_valid")
    by = [c for c in ("file",) if c in df.columns]
    rejects = (tagged.where(~F.col("_tf_valid"))
               .groupBy(*by, F.sha2(F.col(raw), 256).alias("line_hash"))
               .agg(F.count(F.lit(1)).alias("n_lines")))
    return valid, rejects


def line_keys(df: DataFrame, file: str = "file", line: str = "line", out: str = "row_key") -> DataFrame:
    """Row key for JSON lines: ``sha256(file, line):ordinal`` with ordinals 1..m among the m equal
    lines of a file, so keys are unique over all files. Equal lines are interchangeable, so any
    assignment of the ordinals gives the same multiset downstream, under any partitioning.

    Lines met once (counted by hash alone) have ordinal 1. Only repeated lines are numbered: their
    rows are written once with a random salt, so both passes over them see the same salts; counts per
    (hash, salt) give offsets, and rows are numbered inside (hash, salt). A line repeated across the whole
    input is spread over LINE_SALTS windows."""
    d = df.withColumn("_tf_lh", F.sha2(F.concat_ws("\n", F.coalesce(F.col(file), F.lit("")), F.col(line)), 256))
    repeated = d.groupBy("_tf_lh").agg(F.count(F.lit(1)).alias("_tf_c")).where("_tf_c > 1").select("_tf_lh")
    repeated = materialize(repeated)
    key = lambda n: F.concat_ws(":", F.col("_tf_lh"), n.cast("string"))
    single = d.join(repeated, "_tf_lh", "left_anti").withColumn(out, key(F.lit(1)))
    many = d.join(repeated, "_tf_lh", "left_semi")
    many = materialize(many.withColumn("_tf_salt", F.floor(F.rand() * LINE_SALTS).cast("int")))
    counts = many.groupBy("_tf_lh", "_tf_salt").agg(F.count(F.lit(1)).alias("_tf_c"))
    w = Window.partitionBy("_tf_lh").orderBy("_tf_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tf_lh", "_tf_salt", F.coalesce(F.sum("_tf_c").over(w), F.lit(0)).alias("_tf_off"))
    rn = F.row_number().over(Window.partitionBy("_tf_lh", "_tf_salt").orderBy(F.col(line)))
    many = (many.withColumn("_tf_rn", rn).join(offsets, ["_tf_lh", "_tf_salt"])
            .withColumn(out, key(F.col("_tf_off") + F.col("_tf_rn"))))
    cols = [*df.columns, out]
    return single.select(*cols).unionByName(many.select(*cols))


def key_words(rec: DataFrame, key: str = "row_key", by: Sequence[str] = ()) -> DataFrame:
    """Keys ``head:number`` packed to be counted exactly: (*by, head, word, bits, n). A word is 64 numbers of a
    head, a set bit a number met, n the rows. Numbers follow each other in the lines of a file, so a task
    holds a group for 64 keys, not for each. A key of another form is a head of its own (word null); a null key
    has no bits."""
    tail = F.substring_index(key, ":", -1)
    numbered = F.contains(key, F.lit(":")) & tail.rlike("^(0|[1-9][0-9]{0,17})$")
    d = rec.select(*by, F.col(key).alias("_tf_key"), F.when(numbered, tail).alias("_tf_tail"))
    number = F.col("_tf_tail").cast("long")
    head = F.expr("substring(_tf_key, 1, length(_tf_key) - coalesce(length(_tf_tail), 0))")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.coalesce(F.pmod(number, F.lit(64)), F.lit(0)).cast("int"))
    d = d.select(*by, head.alias("head"), F.call_function("shiftright", number, F.lit(6)).alias("word"),
                 F.when(F.col("_tf_key").isNull(), F.lit(0).cast("long")).otherwise(bit).alias("bits"))
    return d.groupBy(*by, "head", "word").agg(F.bit_or("bits").alias("bits"), F.count(F.lit(1)).alias("n"))


def count_keys(words: DataFrame, out: str = "n_keys") -> DataFrame:
    """One row: the number of distinct keys in the rows of ``key_words``."""
    met = words.groupBy("head", "word").agg(F.bit_or("bits").alias("bits"))
    return met.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias(out))


def extract_records(df: DataFrame, raw: str = "line") -> DataFrame:
    """S3: (input, output, text) from valid JSON lines with a fixed schema; non-string values
    keep their JSON text."""
    parsed = df.withColumn("_tf_r", F.from_json(F.col(raw), RECORD_SCHEMA))
    return parsed.select(*[c for c in df.columns], "_tf_r.input", "_tf_r.output", "_tf_r.text")


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], source: str | None = None,
               with_keys: bool = True) -> tuple[DataFrame, DataFrame]:
    """S3 end to end: lines -> strip -> validity -> records; returns (records, rejects).

    ``source`` defaults to the file name. ``rejects`` has a row per invalid line: file, line_no (its true
    number in the file, blank lines counted), line, line_hash, n_lines (1). ``with_keys`` adds line_no and
    row_key (``file:line_no``, unique over all files) to the records. The files are scanned and checked
    once: the checked lines are written, and numbers are looked up by block (``lines.number_lines``)."""
    held = _checked_lines(spark, paths)
    numbered = number_lines(held)
    good = numbered.withColumn("row_key", F.concat_ws(":", "file", "line_no")) if with_keys else held.drop("block", "at")
    return _records(good, source), _rejects(numbered)


def _checked_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All lines, stripped, with their block and validity. Written."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not any(ch in p for p in paths for ch in "*?["):
        paths = existing(spark, paths)
    lines = scan_lines(spark, paths).withColumn("line", py_strip("line"))
    return materialize(lines.withColumn("_tf_valid", json_valid("line")))


def _records(lines: DataFrame, source: str | None) -> DataFrame:
    rec = extract_records(lines.where((F.length("line") > 0) & F.col("_tf_valid")).drop("_tf_valid"))
    return rec.withColumn("source", F.lit(source) if source else F.element_at(F.split(F.col("file"), "/"), -1))


def _rejects(numbered: DataFrame) -> DataFrame:
    bad = numbered.where((F.length("line") > 0) & ~F.col("_tf_valid"))
    return bad.select("file", "line_no", "line", F.sha2("line", 256).alias("line_hash"), F.lit(1).alias("n_lines"))


def read_split_jsonl(spark: SparkSession, root: str, names: Mapping[str, str] | None = None,
                     with_rejects: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Named files -> named splits (train.jsonl -> train, valid.jsonl -> validation). ``with_rejects`` also
    returns the invalid lines of all splits (split, file, line_no, line, line_hash, n_lines)."""
    names = names or {"train": "train.jsonl", "validation": "valid.jsonl"}
    parts, bad = [], []
    for split_name, fname in names.items():
        held = _checked_lines(spark, f"{root.rstrip('/')}/{fname}")
        parts.append(_records(held.drop("block", "at"), split_name).withColumn("split", F.lit(split_name)))
        if with_rejects:
            bad.append(_rejects(number_lines(held)).withColumn("split", F.lit(split_name)))
    return (concat(*parts), concat(*bad)) if with_rejects else concat(*parts)


def read_dialogues(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON files holding an array of dialogues -> utterances (file, dlg, pos, turn_num,
    utterance). A multi-line JSON file is parsed by one task, so the dialogue index is numbered
    within the file (bounded by the file). An item that names its ``dlg`` and ``first`` position is a run of a
    longer dialogue (``sinks.dialogues``); other items are whole dialogues, named by file and index."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    d = (spark.read.option("multiLine", True).schema(DIALOGUE_SCHEMA).json(paths)
         .select(F.col("_metadata.file_path").alias("file"), "utterances", F.col("dlg").alias("_tf_dlg"),
                 F.coalesce("first", F.lit(0)).cast("int").alias("_tf_first"),
                 F.monotonically_increasing_id().alias("_tf_mid")))
    d = d.withColumn("dlg_idx", F.row_number().over(Window.partitionBy("file").orderBy("_tf_mid")) - 1)
    u = d.select("file", "dlg_idx", "_tf_dlg", "_tf_first", F.posexplode("utterances").alias("at", "u"))
    return u.select(F.coalesce("_tf_dlg", F.concat_ws(":", "file", "dlg_idx")).alias("dlg"), "file", "dlg_idx",
                    (F.col("_tf_first") + F.col("at")).alias("pos"),
                    F.col("u.turn_num").alias("turn_num"), F.col("u.utterance").alias("utterance"))


def read_public_qa(spark: SparkSession, paths_by_split: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Every split of a QA table (instruction, input, output), concatenated."""
    parts = [spark.read.format(fmt).load(p).withColumn("orig_split", F.lit(s)) for s, p in paths_by_split.items()]
    return concat(*parts)
