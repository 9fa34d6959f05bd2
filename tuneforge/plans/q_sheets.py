"""Registered queries: workbook cell tables built from ``part`` -> header mapping, rejects,
records (first-blank stop), text records, first-sheet wide table and its prompts.

Fixture: parts are grouped into workbooks of 500 part keys (``book_<key div 500>``), one sheet
per part type; a sheet's rows follow part key order below a header on row 5. Each type gets
its own header layout (fixed below), covering right-most wins, input-before-output in one
cell, Japanese keywords, blank headers, unmapped sheets and a text sheet. Some cells are left
out by a rule on ``p_size``: sizes 13 and 14 leave a row without input and output (the stop
row), 7 drops the output side, 8 the input side.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import prompts as P
from ..operators import records, sheets
from ..session import materialize, scratch_path
from ..sources import tables as T
from ..sources.cells import workbook_cells
from .q_prompts import PRE, slot_sql
from .registry import query

HEADER_ROW = 5
BOOK_SIZE = 500

# ---- fixed values: header layout per sheet (part type): (sheet, col, header text) ----
HEADERS = [
    ("ECONOMY", 1, "No"), ("ECONOMY", 2, "Question"), ("ECONOMY", 3, "Answer A"), ("ECONOMY", 4, "Model Answer"),
    ("PROMO", 1, "No"), ("PROMO", 2, "質問文"), ("PROMO", 3, "回答"),
    ("SMALL", 1, "No"), ("SMALL", 2, "Name"), ("SMALL", 3, "Kind"),
    ("LARGE", 1, "Input Prompt"), ("LARGE", 2, "Output/Response"), ("LARGE", 3, "question answer"),
    ("STANDARD", 3, "ANSWER"), ("STANDARD", 5, "prompt"),
    ("MEDIUM", 1, "No"), ("MEDIUM", 2, "Text"), ("MEDIUM", 4, "本文"),
]
OWN_HEADERS = ["No", "Input", "Output", "Source_1", "Context_1", "Context_know-how"]
# ---- end of fixed values ----


def qa_cells(spark, d):
    part = T.read_table(spark, d, "part")
    book = F.concat(F.lit("book_"), F.floor(F.col("p_partkey") / BOOK_SIZE).cast("string"))
    rows = part.select(book.alias("file"), F.col("p_type").alias("sheet"), "p_partkey", "p_name", "p_brand", "p_type",
                       "p_size")
    # a sheet holds at most BOOK_SIZE rows by construction, so this window is bounded
    w = Window.partitionBy("file", "sheet").orderBy("p_partkey")
    rows = rows.withColumn("row", (F.lit(HEADER_ROW) + F.row_number().over(w)).cast("int"))
    size = F.col("p_size")
    stop = size.isin(13, 14)
    cells = F.array(
        F.struct(F.lit(1).alias("col"), F.col("p_partkey").cast("string").alias("value")),
        F.struct(F.lit(2).alias("col"), F.when(~stop & (size != 8), F.col("p_name")).alias("value")),
        F.struct(F.lit(3).alias("col"), F.when(~stop & (size != 7), F.col("p_brand")).alias("value")),
        F.struct(F.lit(4).alias("col"), F.when(~stop & (size != 7), F.concat_ws(" ", "p_type", size.cast("string"))).alias("value")),
        F.struct(F.lit(5).alias("col"), F.when(~stop & (size != 8), F.concat(F.col("p_name"), F.lit("?"))).alias("value")),
    )
    data = (rows.select("file", "sheet", "row", F.explode(cells).alias("c"))
            .select("file", "sheet", "row", F.col("c.col").cast("int").alias("col"), "c.value")
            .where(F.col("value").isNotNull()))
    layout = spark.createDataFrame(HEADERS, "sheet STRING, col INT, value STRING")  # fixed, 18 rows
    sheet_list = rows.groupBy("file", "sheet").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    hdr = sheet_list.join(F.broadcast(layout), "sheet").select("file", "sheet", F.lit(HEADER_ROW).alias("row"), "col", "value")
    return hdr.unionByName(data).withColumn("sheet_pos", F.lit(0))


def _headers_sql():
    vals = ", ".join(f"('{s}', {c}, '{v}')" for s, c, v in HEADERS)
    return f"layout(sheet, col, value) AS (VALUES {vals})"


CELLS_SQL = f"""
{_headers_sql()},
prow AS (
  SELECT 'book_' || CAST(p_partkey // {BOOK_SIZE} AS VARCHAR) AS file, p_type AS sheet, p_partkey, p_name, p_brand,
         p_type, p_size,
         CAST({HEADER_ROW} + row_number() OVER (PARTITION BY p_partkey // {BOOK_SIZE}, p_type ORDER BY p_partkey) AS INTEGER) AS row
  FROM part),
cells AS (
  SELECT DISTINCT s.file, s.sheet, {HEADER_ROW} AS row, l.col, l.value FROM prow s JOIN layout l ON l.sheet = s.sheet
  UNION ALL SELECT file, sheet, row, 1, CAST(p_partkey AS VARCHAR) FROM prow
  UNION ALL SELECT file, sheet, row, 2, p_name FROM prow WHERE p_size NOT IN (13, 14, 8)
  UNION ALL SELECT file, sheet, row, 3, p_brand FROM prow WHERE p_size NOT IN (13, 14, 7)
  UNION ALL SELECT file, sheet, row, 4, p_type || ' ' || CAST(p_size AS VARCHAR) FROM prow WHERE p_size NOT IN (13, 14, 7)
  UNION ALL SELECT file, sheet, row, 5, p_name || '?' FROM prow WHERE p_size NOT IN (13, 14, 8)
)"""


def _any_sql(col: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({col}), '{w.lower()}')" for w in words) + ")"


def _mapping_sql():
    from ..functions.text import QA_INPUT_KEYWORDS, QA_OUTPUT_KEYWORDS, TEXT_KEYWORDS

    is_in = _any_sql("value", QA_INPUT_KEYWORDS)
    is_out = f"(NOT {is_in} AND {_any_sql('value', QA_OUTPUT_KEYWORDS)})"
    is_text = _any_sql("value", TEXT_KEYWORDS)
    return f"""
hdr AS (SELECT * FROM cells WHERE row = {HEADER_ROW} AND value IS NOT NULL),
m AS (SELECT file, sheet, max(CASE WHEN {is_in} THEN col END) AS input_col,
             max(CASE WHEN {is_out} THEN col END) AS output_col FROM hdr GROUP BY file, sheet),
mt AS (SELECT file, sheet, max(CASE WHEN {is_text} THEN col END) AS text_col FROM hdr GROUP BY file, sheet)"""


@query("sheet_columns", f"WITH {CELLS_SQL}, {_mapping_sql()} SELECT file, sheet, input_col, output_col FROM m")
def sheet_columns(spark, d):
    return sheets.resolve_columns(qa_cells(spark, d), HEADER_ROW, "qa")


@query("sheet_rejects", f"""
WITH {CELLS_SQL}, {_mapping_sql()}
SELECT DISTINCT c.file, c.sheet, 'qa' AS kind FROM cells c
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.file = c.file AND m.sheet = c.sheet
                  AND m.input_col IS NOT NULL AND m.output_col IS NOT NULL)""")
def sheet_rejects(spark, d):
    cells = qa_cells(spark, d)
    _ok, rejects = sheets.drop_unmapped_sheets(cells, sheets.resolve_columns(cells, HEADER_ROW, "qa"), "qa")
    return rejects


@query("sheet_records", f"""
WITH {CELLS_SQL}, {_mapping_sql()},
ok AS (SELECT * FROM m WHERE input_col IS NOT NULL AND output_col IS NOT NULL),
kc AS (SELECT c.file, c.sheet, c.row, max(CASE WHEN c.col = ok.input_col THEN c.value END) AS input,
              max(CASE WHEN c.col = ok.output_col THEN c.value END) AS output
       FROM cells c JOIN ok ON c.file = ok.file AND c.sheet = ok.sheet
       WHERE c.row > {HEADER_ROW} AND c.value IS NOT NULL AND (c.col = ok.input_col OR c.col = ok.output_col)
       GROUP BY c.file, c.sheet, c.row),
g AS (SELECT *, row - row_number() OVER (PARTITION BY file, sheet ORDER BY row) AS gap FROM kc)
SELECT file, sheet, row, coalesce(input, '') AS input, coalesce(output, '') AS output FROM g WHERE gap = {HEADER_ROW}""")
def sheet_records(spark, d):
    cells = qa_cells(spark, d)
    ok, _rej = sheets.drop_unmapped_sheets(cells, sheets.resolve_columns(cells, HEADER_ROW, "qa"), "qa")
    return sheets.sheet_records(cells, ok, HEADER_ROW, "qa")


@query("sheet_text_records", f"""
WITH {CELLS_SQL}, {_mapping_sql()},
ok AS (SELECT * FROM mt WHERE text_col IS NOT NULL),
kc AS (SELECT c.file, c.sheet, c.row, max(c.value) AS text
       FROM cells c JOIN ok ON c.file = ok.file AND c.sheet = ok.sheet
       WHERE c.row > {HEADER_ROW} AND c.value IS NOT NULL AND c.col = ok.text_col
       GROUP BY c.file, c.sheet, c.row),
g AS (SELECT *, row - row_number() OVER (PARTITION BY file, sheet ORDER BY row) AS gap FROM kc)
SELECT file, sheet, row, coalesce(text, '') AS text FROM g WHERE gap = {HEADER_ROW}""")
def sheet_text_records(spark, d):
    cells = qa_cells(spark, d)
    ok, _rej = sheets.drop_unmapped_sheets(cells, sheets.resolve_columns(cells, HEADER_ROW, "text"), "text")
    return sheets.sheet_records(cells, ok, HEADER_ROW, "text")


def own_cells(spark, d):
    """Own-QA workbooks (header on row 1, first sheet 'QA'); a second sheet 'notes' must be
    ignored by the first-sheet reader. Source_1 is absent for large parts, Context_1 for small."""
    part = T.read_table(spark, d, "part")
    book = F.concat(F.lit("own_"), F.floor(F.col("p_partkey") / BOOK_SIZE).cast("string"))
    w = Window.partitionBy("file").orderBy("p_partkey")  # at most BOOK_SIZE rows per file
    rows = part.select(book.alias("file"), "p_partkey", "p_name", "p_type", "p_brand", "p_size").withColumn(
        "row", (F.lit(1) + F.row_number().over(w)).cast("int"))
    size = F.col("p_size")
    vals = [F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_type"), F.when(size <= 40, F.col("p_brand")),
            F.when(size >= 10, F.concat(F.lit("size "), size.cast("string"))), F.concat(F.lit("policy "), F.col("p_brand"))]
    cells = F.array(*[F.struct(F.lit(i + 1).alias("col"), v.alias("value")) for i, v in enumerate(vals)])
    data = (rows.select("file", "row", F.explode(cells).alias("c"))
            .select("file", F.lit("QA").alias("sheet"), F.lit(0).alias("sheet_pos"), "row",
                    F.col("c.col").cast("int").alias("col"), "c.value")
            .where(F.col("value").isNotNull()))
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    hdr_vals = F.array(*[F.struct(F.lit(i + 1).alias("col"), F.lit(h).alias("value")) for i, h in enumerate(OWN_HEADERS)])
    hdr = files.select("file", F.explode(hdr_vals).alias("c")).select(
        "file", F.lit("QA").alias("sheet"), F.lit(0).alias("sheet_pos"), F.lit(1).alias("row"),
        F.col("c.col").cast("int").alias("col"), "c.value")
    notes = rows.select("file", F.lit("notes").alias("sheet"), F.lit(1).alias("sheet_pos"), "row",
                        F.lit(2).alias("col"), F.concat(F.lit("note "), F.col("p_name")).alias("value"))
    notes_hdr = files.select("file", F.lit("notes").alias("sheet"), F.lit(1).alias("sheet_pos"), F.lit(1).alias("row"),
                             F.lit(2).alias("col"), F.lit("Input").alias("value"))
    return hdr.unionByName(data).unionByName(notes_hdr).unionByName(notes)


OWN_TABLE_SQL = f"""
orow AS (
  SELECT 'own_' || CAST(p_partkey // {BOOK_SIZE} AS VARCHAR) AS file, p_partkey, p_name, p_type, p_brand, p_size,
         CAST(1 + row_number() OVER (PARTITION BY p_partkey // {BOOK_SIZE} ORDER BY p_partkey) AS INTEGER) AS row
  FROM part),
own_table AS (
  SELECT file, row, CAST(p_partkey AS VARCHAR) AS "No", p_name AS "Input", p_type AS "Output",
         CASE WHEN p_size <= 40 THEN p_brand END AS "Source_1",
         CASE WHEN p_size >= 10 THEN 'size ' || CAST(p_size AS VARCHAR) END AS "Context_1",
         'policy ' || p_brand AS "Context_know-how"
  FROM orow)"""


@query("sheet_table", f"WITH {OWN_TABLE_SQL} SELECT * FROM own_table")
def sheet_table(spark, d):
    return sheets.read_sheet_table(own_cells(spark, d), OWN_HEADERS, sheet_index=0, header_row=1)


@query("sheet_prompts", f"""
WITH {OWN_TABLE_SQL}
SELECT file, row, {PRE} || '質問：' || coalesce("Input", '') || chr(10) || chr(10) || '参考情報：' || chr(10) ||
       {slot_sql(1, '"Source_1"', '"Context_1"')} || '回答の方針：' || coalesce("Context_know-how", '')
       || chr(10) || chr(10) || '回答：' AS prompt
FROM own_table""")
def sheet_prompts(spark, d):
    """Batch-mode prompt table: first sheet -> fill missing -> drop the serial column -> F5."""
    t = records.drop_if_present(records.fill_missing(sheets.read_sheet_table(own_cells(spark, d), OWN_HEADERS)), "No")
    return t.select("file", "row", P.own_qa_prompt(t).alias("prompt"))


def records_sql(kind: str, name: str) -> str:
    """CTEs giving the kept records of the usable sheets as ``name`` (needs CELLS_SQL and the
    mapping CTEs): QA -> (file, sheet, row, input, output); text -> (file, sheet, row, text)."""
    if kind == "qa":
        return f"""
{name}_ok AS (SELECT * FROM m WHERE input_col IS NOT NULL AND output_col IS NOT NULL),
{name}_kc AS (SELECT c.file, c.sheet, c.row, max(CASE WHEN c.col = o.input_col THEN c.value END) AS input,
                     max(CASE WHEN c.col = o.output_col THEN c.value END) AS output
              FROM cells c JOIN {name}_ok o ON c.file = o.file AND c.sheet = o.sheet
              WHERE c.row > {HEADER_ROW} AND c.value IS NOT NULL AND (c.col = o.input_col OR c.col = o.output_col)
              GROUP BY c.file, c.sheet, c.row),
{name} AS (SELECT file, sheet, row, coalesce(input, '') AS input, coalesce(output, '') AS output
           FROM (SELECT *, row - row_number() OVER (PARTITION BY file, sheet ORDER BY row) AS gap FROM {name}_kc)
           WHERE gap = {HEADER_ROW})"""
    return f"""
{name}_ok AS (SELECT * FROM mt WHERE text_col IS NOT NULL),
{name}_kc AS (SELECT c.file, c.sheet, c.row, max(c.value) AS text
              FROM cells c JOIN {name}_ok o ON c.file = o.file AND c.sheet = o.sheet
              WHERE c.row > {HEADER_ROW} AND c.value IS NOT NULL AND c.col = o.text_col
              GROUP BY c.file, c.sheet, c.row),
{name} AS (SELECT file, sheet, row, coalesce(text, '') AS text
           FROM (SELECT *, row - row_number() OVER (PARTITION BY file, sheet ORDER BY row) AS gap FROM {name}_kc)
           WHERE gap = {HEADER_ROW})"""


def _dataset_build_sql():
    from .q_dialogue import SEED as MIX_SEED
    from .q_dialogue import mix_sql
    from .sql_common import PAIRS_CTE, hash_sql

    key = "file || ':' || sheet || ':' || CAST(row AS VARCHAR)"
    return f"""
WITH {CELLS_SQL}, {_mapping_sql()}, {records_sql('qa', 'qa_rec')}, {records_sql('text', 'tx_rec')},
corpus2 AS (
  SELECT 'QA' AS source, {key} AS row_key, input, output, CAST(NULL AS VARCHAR) AS text FROM qa_rec
  UNION ALL
  SELECT 'Text', {key}, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), text FROM tx_rec),
bh AS (SELECT *, {hash_sql('row_key', MIX_SEED, 'split')} AS h, count(*) OVER (PARTITION BY source) AS n FROM corpus2),
bs AS (SELECT source, row_key, input, output, text,
              CASE WHEN row_number() OVER (PARTITION BY source ORDER BY h, row_key) <= floor(n * CAST(0.8 AS DOUBLE))
                   THEN 'train' ELSE 'valid' END AS split FROM bh),
{PAIRS_CTE},
{mix_sql('bs')}
SELECT split, 'base' AS origin, source, row_key, input, output, text FROM bs
UNION ALL SELECT 'train', 'pool', 'dialogue', row_key, input, output, CAST(NULL AS VARCHAR) FROM st
UNION ALL SELECT 'valid', 'pool', 'dialogue', row_key, input, output, CAST(NULL AS VARCHAR) FROM sv"""


@query("dataset_build", _dataset_build_sql())
def dataset_build(spark, d):
    """Path A end to end: QA and text sheets -> records -> exact split per source -> dialogue mix."""
    from ..flows import make_dataset
    from .q_dialogue import pairs

    cells = qa_cells(spark, d)
    pool = pairs(spark, d).select("row_key", "input", "output")
    out, _rejects = make_dataset(cells, cells, pool, train_ratio=0.8, seed=42, mix_ratio=0.3, header_row=HEADER_ROW)
    return out.select("split", "origin", "source", "row_key", "input", "output", "text")


_SHEETS_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE_NS = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook_of(cells):
    """One file's cells as the bytes of a workbook: odd columns as shared strings, even ones inline."""
    import io
    import zipfile
    from xml.sax.saxutils import escape, quoteattr

    strings, sheets = {}, []
    for (pos, name), rows in cells.sort_values(["sheet_pos", "row", "col"]).groupby(["sheet_pos", "sheet"]):
        out = []
        for row, group in rows.groupby("row"):
            out.append(f'<row r="{row}">')
            for col, value in zip(group["col"], group["value"]):
                at = f"{chr(64 + col)}{row}"
                if col % 2:
                    out.append(f'<c r="{at}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>')
                else:
                    out.append(f'<c r="{at}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
            out.append("</row>")
        sheets.append((name, "".join(out)))
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_SHEETS_NS}" xmlns:r="{_RELS_NS}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE_NS}">{links}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_SHEETS_NS}">' + "".join(f"<si><t>{escape(x)}</t></si>" for x in strings) + "</sst>")
        for i, (_, xml) in enumerate(sheets, 1):
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{_SHEETS_NS}"><sheetData>{xml}</sheetData></worksheet>')
    return file.getvalue()


def workbooks(spark, d):
    """The workbooks of ``qa_cells`` as files (path, content): at most BOOK_SIZE parts each. Written."""
    import pandas as pd

    def pack(cells):
        return pd.DataFrame({"path": [cells["file"].iloc[0]], "content": [workbook_of(cells)]})

    names = F.dense_rank().over(Window.partitionBy("file").orderBy("sheet")) - 1  # a workbook's few sheets
    cells = qa_cells(spark, d).withColumn("sheet_pos", names)
    return materialize(cells.groupBy("file").applyInPandas(pack, "path STRING, content BINARY"))


@query("read_workbook", f"""
WITH {CELLS_SQL}
SELECT file, sheet, CAST(dense_rank() OVER (PARTITION BY file ORDER BY sheet) - 1 AS INTEGER) AS sheet_pos, row, col, value
FROM cells WHERE value IS NOT NULL""")
def read_workbook(spark, d):
    """All parts as workbooks, read back sheet by sheet."""
    cells, _rejects = workbook_cells(workbooks(spark, d))
    return cells


@query("workbook_rejects", f"""
WITH {CELLS_SQL},
book AS (SELECT DISTINCT file, CAST(substr(file, 6) AS BIGINT) % 3 AS kind FROM cells)
SELECT file, CASE kind WHEN 0 THEN 'rejected' ELSE 'read' END AS status,
       CAST(CASE kind WHEN 0 THEN 0 ELSE (SELECT count(*) FROM cells c WHERE c.file = book.file AND value IS NOT NULL) END AS BIGINT) AS n_cells
FROM book""")
def workbook_rejects(spark, d):
    """Of the same workbooks every third is damaged (its last third cut off, or one sheet's bytes changed): it is
    rejected whole, the others are read whole."""
    files = workbooks(spark, d)
    number = F.substring("path", 6, 20).cast("long")
    size = F.octet_length("content")
    cut = F.substring("content", F.lit(1), (size * 2 / 3).cast("int"))
    changed = F.concat(F.substring("content", F.lit(1), size - F.floor(size / 2).cast("int")), F.unhex(F.lit("00FF00FF")),
                       F.substring("content", size - F.floor(size / 2).cast("int") + 5, size))
    damaged = F.when(number % 6 == 0, cut).when(number % 3 == 0, changed).otherwise(F.col("content"))
    cells, rejects = workbook_cells(files.withColumn("content", damaged))
    counts = cells.groupBy("file").agg(F.count(F.lit(1)).alias("n_cells")).withColumn("status", F.lit("read"))
    return counts.unionByName(rejects.select("file", F.lit(0).cast("long").alias("n_cells"), F.lit("rejected").alias("status")))


CSV_FILES = 8


@query("csv_sheets", f"""
WITH numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY p_partkey % {CSV_FILES} ORDER BY p_partkey) AS INTEGER) AS row FROM part)
SELECT CAST(p_partkey % {CSV_FILES} AS BIGINT) AS file_no, row, c.col AS col, c.value AS value
FROM numbered, LATERAL (SELECT unnest([{{'col': 1, 'value': CAST(p_partkey AS VARCHAR)}},
  {{'col': 2, 'value': CASE WHEN p_size % 5 = 0 THEN p_name || ', "' || p_brand || '"' ELSE p_name END}},
  {{'col': 3, 'value': CASE WHEN p_partkey % {CSV_FILES} = 1 THEN p_type || chr(10) || 'more' ELSE p_type END}},
  {{'col': 4, 'value': CASE WHEN p_size > 25 THEN p_brand END}}])) AS t(c)
WHERE c.value IS NOT NULL""")
def csv_sheets(spark, d):
    """Parts as CSV files, with quoted commas and quotes, missing cells, and in one file quoted line breaks."""
    from ..sources.cells import cells_from_csv_sheets

    root = scratch_path(spark, "csv-sheets")
    part, no = T.read_table(spark, d, "part"), F.col("p_partkey") % CSV_FILES
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    name = F.when(F.col("p_size") % 5 == 0, quoted(F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')))).otherwise(F.col("p_name"))
    kind = F.when(no == 1, quoted(F.concat("p_type", F.lit("\nmore")))).otherwise(F.col("p_type"))
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(","), name, F.lit(","), kind, F.lit(","), F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.lit("")))
    lines = part.select(no.alias("file_no"), "p_partkey", line.alias("value")).repartition("file_no").sortWithinPartitions("file_no", "p_partkey")
    # Spark's text writer, so that the fields stay as they are quoted here; .csv names are what the reader looks for.
    lines.select("file_no", "value").write.option("compression", "none").partitionBy("file_no").text(root)
    cells = cells_from_csv_sheets(spark, root, recursive=True, suffix="txt")
    return cells.select(F.regexp_extract("file", r"file_no=(\d+)", 1).cast("long").alias("file_no"), "row", "col", "value")
