"""Registered queries: JSON validity, extraction and rejects over damaged lines; snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import STRIP_PATTERN
from ..session import scratch_path
from ..sinks.writers import latest_by
from ..sources import jsonl
from ..sources import tables as T
from .registry import query

BLANK = " \t　 "


def damaged_lines(spark, d):
    """One JSON line per event, damaged by a rule on the event: valid objects, trailing text,
    arrays, single-quoted keys, truncation, and whitespace-only lines."""
    ev = T.read_table(spark, d, "events", spread_by="event_id")
    props, et = F.col("props"), F.col("event_type")
    line = (F.when(F.col("value") < 1, F.lit(BLANK))
            .when(et == "view", props)
            .when(et == "click", F.concat(props, F.lit(" x")))
            .when(et == "signup", F.concat(F.lit("["), props, F.lit("]")))
            .when(et == "purchase", F.replace(props, F.lit('"k"'), F.lit("'k'")))
            .otherwise(F.substring(props, 1, F.length(props) - 1)))
    return ev.select("event_id", line.alias("line"))


LINES_SQL = f"""
raw AS (
  SELECT event_id,
         CASE WHEN value < 1 THEN ' ' || chr(9) || chr(12288) || ' '
              WHEN event_type = 'view' THEN props
              WHEN event_type = 'click' THEN props || ' x'
              WHEN event_type = 'signup' THEN '[' || props || ']'
              WHEN event_type = 'purchase' THEN replace(props, '"k"', '''k''')
              ELSE left(props, length(props) - 1) END AS line
  FROM events
),
lines AS (
  SELECT event_id, regexp_replace(line, '{STRIP_PATTERN}', '', 'g') AS line FROM raw
  WHERE length(regexp_replace(line, '{STRIP_PATTERN}', '', 'g')) > 0
)"""


@query("json_valid_filter", f"WITH {LINES_SQL} SELECT event_id, line, json_valid(line) AS is_valid FROM lines")
def json_valid_filter(spark, d):
    from ..functions.json_valid import json_valid

    lines = jsonl.drop_blank_lines(damaged_lines(spark, d))
    return lines.select("event_id", "line", json_valid("line").alias("is_valid"))


@query("jsonl_extract", f"""
WITH {LINES_SQL}
SELECT event_id, CAST(json_extract_string(line, '$.k') AS BIGINT) AS k FROM lines WHERE json_valid(line)""")
def jsonl_extract(spark, d):
    valid, _ = jsonl.filter_valid_json(jsonl.drop_blank_lines(damaged_lines(spark, d)))
    return valid.select("event_id", F.get_json_object("line", "$.k").cast("long").alias("k"))


@query("json_rejects", f"""
WITH {LINES_SQL}
SELECT sha256(line) AS line_hash, count(*) AS n_lines FROM lines WHERE NOT json_valid(line) GROUP BY 1""")
def json_rejects(spark, d):
    _, rejects = jsonl.filter_valid_json(jsonl.drop_blank_lines(damaged_lines(spark, d)))
    return rejects.select("line_hash", "n_lines")


LINE_FILES = 8

NUMBERED_SQL = LINES_SQL.replace("SELECT event_id, regexp_replace", "SELECT *, regexp_replace").replace(
    "SELECT event_id,\n         CASE", f"""SELECT event_id, event_id % {LINE_FILES} AS file_no,
         row_number() OVER (PARTITION BY event_id % {LINE_FILES} ORDER BY event_id) AS line_no,
         CASE""").replace("AS line FROM raw", "AS stripped FROM raw")


def damaged_files(spark, d, root: str, name: str) -> None:
    """The damaged lines dealt to LINE_FILES text files, each in event order, one file a folder ``name=<number>``."""
    ev = damaged_lines(spark, d).select((F.col("event_id") % LINE_FILES).alias(name), "event_id", "line")
    ev.repartition(name).sortWithinPartitions(name, "event_id").select(name, F.col("line").alias("value")).write.partitionBy(name).text(root)


@query("json_line_numbers", f"""
WITH {NUMBERED_SQL}
SELECT CAST(file_no AS BIGINT) AS file_no, line_no, stripped AS line FROM lines WHERE NOT json_valid(stripped)""")
def json_line_numbers(spark, d):
    """Every invalid line with its number in its file (blank lines count)."""
    root = scratch_path(spark, "damaged")
    damaged_files(spark, d, root, "file_no")
    _, rejects = jsonl.read_jsonl(spark, root)
    return rejects.select(F.regexp_extract("file", r"file_no=(\d+)", 1).cast("long").alias("file_no"), "line_no", "line")


@query("split_rejects", f"""
WITH {NUMBERED_SQL}
SELECT CASE WHEN file_no % 2 = 0 THEN 'train' ELSE 'validation' END AS split, json_valid(stripped) AS ok, count(*) AS n_lines,
       CAST(sum(CASE WHEN json_valid(stripped) THEN 0 ELSE line_no END) AS BIGINT) AS line_sum
FROM lines GROUP BY 1, 2""")
def split_rejects(spark, d):
    """Two splits read back with their rejects: records and invalid lines of each, and the sum of the latter's numbers."""
    root = scratch_path(spark, "damaged-splits")
    damaged_files(spark, d, root, "part")
    kept, rejects = jsonl.read_split_jsonl(spark, root, {"train": "part=*[02468]", "validation": "part=*[13579]"}, with_rejects=True)
    both = kept.select("split", F.lit(True).alias("ok"), F.lit(0).alias("line_no")).unionByName(
        rejects.select("split", F.lit(False).alias("ok"), "line_no"))
    return both.groupBy("split", "ok").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("line_no").cast("long").alias("line_sum"))


@query("latest_snapshot", """
WITH names AS (
  SELECT user_id, strftime(ts, '%Y%m%d') AS name FROM events
  UNION ALL SELECT user_id, strftime(ts, '%Y%m%d') || '_v2' FROM events
  UNION ALL SELECT user_id, 'checkpoint-' || CAST(event_id AS VARCHAR) FROM events
  UNION ALL SELECT user_id, strftime(ts, '%Y%m%d%H') FROM events
)
SELECT user_id, max(CASE WHEN regexp_full_match(name, '[0-9]{8}') THEN name END) AS latest
FROM names GROUP BY user_id""")
def latest_snapshot(spark, d):
    """Snapshot names derived from event dates, with malformed variants that must be ignored
    (suffixes, checkpoint names, ten-digit stamps); the latest valid one per user."""
    ev = T.read_table(spark, d, "events")
    day = F.date_format("ts", "yyyyMMdd")
    names = (ev.select("user_id", day.alias("name"))
             .unionByName(ev.select("user_id", F.concat(day, F.lit("_v2")).alias("name")))
             .unionByName(ev.select("user_id", F.concat(F.lit("checkpoint-"), F.col("event_id").cast("string")).alias("name")))
             .unionByName(ev.select("user_id", F.date_format("ts", "yyyyMMddHH").alias("name"))))
    return latest_by(names, "name", ["user_id"])
