"""Workbook files -> long cell table (S1), and CSV files as sheets.

``spark.read.format('binaryFile')`` lists the workbooks; Python functions over partitions take them apart and parse
their parts with the standard library (an .xlsx/.xlsm file is a zip of XML parts). Formulas come out as their cached
values, macros are ignored, every value is a string. Anything downstream consumes the cell *table*, so a CSV or
Parquet export of cells works the same way (``cells_from_csv``).
"""

from __future__ import annotations

import io
import posixpath
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from functools import partial
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .lines import number_lines, scan_lines

CELL_SCHEMA = "file STRING, sheet STRING, sheet_pos INT, row INT, col INT, value STRING"

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_REF = re.compile(r"([A-Z]+)([0-9]+)")
BATCH_ROWS = 50_000


def col_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n


def _text_of(el) -> str:
    """Text of a string item: its <t>, or those of its rich-text runs. Phonetic runs are reading aids, not text."""
    parts = [t.text or "" for t in el.findall(f"{_NS}t")]
    return "".join(parts + [t.text or "" for r in el.findall(f"{_NS}r") for t in r.findall(f"{_NS}t")])


def _number_text(raw: str) -> str:
    """A stored number as Python prints the typed value: 1.1000000000000001 is 1.1, 1E-3 is 0.001."""
    try:
        if re.fullmatch(r"[+-]?[0-9]+", raw):
            return str(int(raw))
        return repr(float(raw))
    except ValueError:
        return raw


def _sheet_parts(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part path) in workbook order."""
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.iter(f"{_PKG}Relationship")}
    out = []
    for s in wb.iter(f"{_NS}sheet"):
        t = target.get(s.get(f"{_REL}id"), "")
        path = t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join("xl", t))
        out.append((s.get("name"), path))
    return out


_BROKEN = (zipfile.BadZipFile, KeyError, ET.ParseError, IndexError, ValueError, zlib.error, EOFError, struct.error, NotImplementedError)
SHEET, STRINGS, BAD = "sheet", "strings", "bad"
PART_SCHEMA = "file STRING, kind STRING, sheet STRING, sheet_pos INT, packed BOOLEAN, crc LONG, data BINARY"
PARSED_SCHEMA = "file STRING, sheet STRING, sheet_pos INT, row INT, col INT, value STRING, shared INT, reason STRING"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    cols = [c.strip().split(" ") for c in schema.split(",")]
    kinds = {name: {"INT": "Int32", "LONG": "Int64", "BOOLEAN": "boolean"}[kind] for name, kind in cols if kind in ("INT", "LONG", "BOOLEAN")}
    return pd.DataFrame(rows, columns=[name for name, _ in cols]).astype(kinds)


def _reason(e: Exception) -> str:
    return f"unreadable workbook: {type(e).__name__}"


def _parts(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The parts of each workbook as they lie in it, still packed, or one row saying why there are none."""
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            content = bytes(content)
            if path.lower().endswith(".xls"):
                yield _frame([(path, BAD, "legacy .xls is not readable", None, None, None, None)], PART_SCHEMA)
                continue
            rows = []
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    wanted = [(SHEET, sheet, pos, part) for pos, (sheet, part) in enumerate(_sheet_parts(z))]
                    if "xl/sharedStrings.xml" in z.namelist():
                        wanted.append((STRINGS, None, None, "xl/sharedStrings.xml"))
                    for kind, sheet, pos, part in wanted:
                        info = z.getinfo(part)
                        if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or info.flag_bits & 1:
                            raise ValueError(f"packing of {part}")
                        name, extra = struct.unpack_from("<HH", content, info.header_offset + 26)
                        at = info.header_offset + 30 + name + extra
                        rows.append((path, kind, sheet, pos, info.compress_type == zipfile.ZIP_DEFLATED, info.CRC, content[at:at + info.compress_size]))
            except _BROKEN as e:
                rows = [(path, BAD, _reason(e), None, None, None, None)]
            for row in rows:  # a part a batch: none is held twice
                yield _frame([row], PART_SCHEMA)


def _events(data: bytes, packed: bool, crc: int, events: tuple[str, ...]) -> Iterator[tuple[str, ET.Element]]:
    """XML events of a part, unpacked as it is read; its checksum is checked at the end."""
    parser, unpack, seen = ET.XMLPullParser(events), zlib.decompressobj(-15) if packed else None, 0
    for at in range(0, len(data), 1 << 18):
        text = unpack.decompress(data[at:at + (1 << 18)]) if packed else data[at:at + (1 << 18)]
        seen = zlib.crc32(text, seen)
        parser.feed(text)
        yield from parser.read_events()
    if packed and not unpack.eof or seen != crc:
        raise zipfile.BadZipFile("checksum")
    parser.close()
    yield from parser.read_events()


def _cell_value(c) -> tuple[str | None, int | None]:
    """(value, None), or (None, number of a shared string)."""
    t = c.get("t", "n")
    if t == "inlineStr":
        is_ = c.find(f"{_NS}is")
        return (None if is_ is None else _text_of(is_)), None
    v = c.find(f"{_NS}v")
    if v is None or v.text is None:
        return None, None
    if t == "s":
        return None, int(v.text)
    if t == "b":
        return ("TRUE" if v.text.strip() == "1" else "FALSE"), None  # as sheets show them
    return (_number_text(v.text.strip()) if t == "n" else v.text), None


def _sheet_cells(events) -> Iterator[tuple]:
    """(row, col, value, shared). A row or cell without a reference follows the one before it."""
    row = col = 0
    for ev, el in events:
        if el.tag == f"{_NS}row":
            if ev == "start":
                row, col = int(el.get("r") or row + 1), 0
            else:
                el.clear()
        elif ev == "end" and el.tag == f"{_NS}c":
            m = _REF.fullmatch(el.get("r") or "")
            at, col = (int(m.group(2)), col_number(m.group(1))) if m else (row, col + 1)
            value, shared = _cell_value(el)
            if value is not None or shared is not None:
                yield at, col, value, shared


def _strings(events) -> Iterator[str]:
    for _, el in events:
        if el.tag == f"{_NS}si":
            yield _text_of(el)
            el.clear()


def _parse_parts(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells of sheets (shared strings by number) and strings (row: their number), a reason where a part is broken."""
    for pdf in it:
        for file, kind, sheet, pos, packed, crc, data in pdf.itertuples(index=False):
            batch: list[tuple] = []
            try:
                if kind == SHEET:
                    rows = ((file, sheet, pos, *c, None) for c in _sheet_cells(_events(bytes(data), packed, crc, ("start", "end"))))
                else:
                    rows = ((file, None, None, i, None, s, None, None) for i, s in enumerate(_strings(_events(bytes(data), packed, crc, ("end",)))))
                for r in rows:
                    batch.append(r)
                    if len(batch) >= BATCH_ROWS:
                        yield _frame(batch, PARSED_SCHEMA)
                        batch = []
            except _BROKEN as e:
                batch.append((file, None, None, None, None, None, None, _reason(e)))
            yield _frame(batch, PARSED_SCHEMA)


def workbook_cells(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, rejects) of workbooks given as (path, content).

    The unit of work is a part of a workbook: files are taken apart without unpacking them, then each sheet and
    each string table is unpacked and parsed in a task of its own, so a workbook of many sheets is read in parallel.
    Every part is parsed once and its cells written; shared strings are a table joined by (file, number). A file
    counts whole or not at all: one with a broken part or a string number that its table lacks gives no cells
    and one row in ``rejects`` (file, reason). Spark lists no file of zero bytes."""
    parts = materialize(files.select("path", "content").mapInPandas(_parts, PART_SCHEMA))
    good = parts.where(F.col("kind") != BAD)
    parsed = materialize(good.repartition("file", "kind", "sheet_pos").mapInPandas(_parse_parts, PARSED_SCHEMA))
    cells = parsed.where("col is not null")
    strings = parsed.where("col is null and reason is null").select(F.col("file").alias("_f"), F.col("row").alias("_i"), F.col("value").alias("_s"))
    found = cells.join(strings, (F.col("file") == F.col("_f")) & (F.col("shared") == F.col("_i")), "left")
    found = materialize(found.select("file", "sheet", "sheet_pos", "row", "col", F.coalesce("_s", "value").alias("value")))
    broken = (parts.where(F.col("kind") == BAD).select("file", F.col("sheet").alias("reason"))
              .unionByName(parsed.where("reason is not null").select("file", "reason"))
              .unionByName(found.where("value is null").select("file", F.lit("unreadable workbook: IndexError").alias("reason"))))
    rejects = materialize(broken.groupBy("file").agg(F.min("reason").alias("reason")))
    return found.join(rejects.select("file"), "file", "left_anti").select("file", "sheet", "sheet_pos", "row", "col", "value"), rejects


def _workbooks(spark: SparkSession, path: str, suffixes, recursive: bool) -> DataFrame:
    glob = "*.{" + ",".join(s.lstrip(".") for s in suffixes) + "}"
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", recursive).load(path))


def read_workbooks(spark: SparkSession, path: str, suffixes=(".xlsx", ".xlsm", ".xls"), recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cells, rejects) of every workbook in the folder ``path`` (and below it, if ``recursive``); files are read
    and parsed once."""
    return workbook_cells(_workbooks(spark, path, suffixes, recursive))


def read_cells(spark: SparkSession, path: str, suffixes=(".xlsx", ".xlsm"), recursive: bool = False) -> DataFrame:
    """Every sheet of every workbook in the folder ``path`` (and below it, if ``recursive``) as a cell table."""
    return read_workbooks(spark, path, suffixes, recursive)[0]


def workbook_rejects(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Files with a workbook suffix that cannot be read whole (incl. legacy .xls)."""
    return read_workbooks(spark, path, recursive=recursive)[1]


def cells_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A cell table exported as CSV with a header (file, sheet, sheet_pos, row, col, value)."""
    return spark.read.schema(CELL_SCHEMA).option("header", True).csv(path)


def cells_from_csv_sheets(spark: SparkSession, path: str, recursive: bool = False, encoding: str = "UTF-8",
                          suffix: str = "csv") -> DataFrame:
    """Plain CSV files as sheets: each file is a workbook of one sheet named '' whose rows and columns are the
    file's. An empty field is a missing cell; a blank line is an empty row.

    Files are read as numbered lines, so large ones are split over tasks, and each line is parsed by Spark's CSV
    expression, whatever the length of its fields. Only a file with a line of unpaired quotes (a quoted field that
    goes on in the next line) is parsed whole, by one task. Bytes that are no UTF-8 become the replacement
    character. Other encodings than UTF-8 are parsed whole."""
    where = {"pathGlobFilter": f"*.{suffix}", "recursiveFileLookup": str(bool(recursive)).lower()}
    whole = spark.read.format("binaryFile").options(**where).load(path).select(F.col("path").alias("file"), "content")
    parse = partial(_csv_whole, "utf-8-sig" if encoding.upper() == "UTF-8" else encoding)
    if encoding.upper() != "UTF-8":
        return whole.mapInPandas(parse, CELL_SCHEMA)
    lines = materialize(scan_lines(spark.read.options(**where), path))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    odd = lines.where(quotes % 2 == 1).select("file").distinct()
    odd = materialize(odd.withColumn("_tf_key", file_key("file")))
    numbered = number_lines(lines, "row").withColumn("_tf_key", file_key("file"))
    simple = numbered.join(odd.select("_tf_key"), "_tf_key", "left_anti")
    whole = whole.withColumn("_tf_key", file_key("file")).join(odd.select("_tf_key"), "_tf_key", "left_semi").select("file", "content")
    return _csv_lines(simple, _most_fields(lines)).unionByName(whole.mapInPandas(parse, CELL_SCHEMA))


def file_key(c: str) -> Column:
    """A file's path without the scheme: readers differ in how many slashes they write after it."""
    return F.regexp_replace(F.col(c), "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _most_fields(lines: DataFrame) -> int:
    """No line has more fields than this."""
    commas = F.length("line") - F.length(F.replace("line", F.lit(","), F.lit("")))
    return (lines.agg(F.max(commas)).first()[0] or 0) + 1


def _csv_lines(numbered: DataFrame, fields: int) -> DataFrame:
    """Cells of numbered lines with paired quotes."""
    line = F.when(F.col("row") == 1, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line"))
    schema = ", ".join(f"c{i} string" for i in range(fields))
    options = {"escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "maxColumns": str(fields + 1)}
    parsed = numbered.select("file", "row", F.from_csv(line, F.lit(schema), options).alias("r"))
    values = F.array(*[F.col(f"r.c{i}") for i in range(fields)])
    cells = parsed.select("file", "row", F.posexplode(values).alias("col", "value")).where("value <> ''")
    return cells.select("file", F.lit("").alias("sheet"), F.lit(0).alias("sheet_pos"), F.col("row").cast("int").alias("row"),
                        (F.col("col") + 1).alias("col"), "value")


def _csv_whole(encoding: str, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import csv

    csv.field_size_limit(2**31 - 1)
    cols = ["file", "sheet", "sheet_pos", "row", "col", "value"]
    kinds = {"sheet_pos": "int32", "row": "int32", "col": "int32"}
    for pdf in it:
        for name, content in zip(pdf["file"], pdf["content"]):
            text = io.TextIOWrapper(io.BytesIO(bytes(content)), encoding=encoding, errors="replace", newline="")
            batch = []
            for r, fields in enumerate(csv.reader(text), start=1):
                batch += [(name, "", 0, r, c, v) for c, v in enumerate(fields, start=1) if v != ""]
                if len(batch) >= BATCH_ROWS:
                    yield pd.DataFrame(batch, columns=cols).astype(kinds)
                    batch = []
            yield pd.DataFrame(batch, columns=cols).astype(kinds)
