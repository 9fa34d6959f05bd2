"""Workbook cell tables -> records.

The input is a long cell table ``(file, sheet, row, col, value[, sheet_pos])`` (values are
strings; an absent or null cell is "missing"). Every step is keyed by (file, sheet): header
resolution is one aggregate per sheet, records are one aggregate per (sheet, row), and the
first-blank stop rule is an anti-join on (sheet, row). No window spans a sheet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import QA_INPUT_KEYWORDS, QA_OUTPUT_KEYWORDS, TEXT_KEYWORDS, contains_any
from ..plans.small import attach_stats
from ..session import materialize
from .records import fill_missing

SHEET = ["file", "sheet"]


def resolve_columns(cells: DataFrame, header_row: int = 5, kind: str = "qa") -> DataFrame:
    """Per sheet, the column of each role from the header row. A header matches when its
    lower-cased text contains a keyword; input is tested before output within a cell; the
    right-most matching column wins; blank headers are ignored.
    QA -> (file, sheet, input_col, output_col); text -> (file, sheet, text_col)."""
    hdr = cells.where((F.col("row") == header_row) & F.col("value").isNotNull())
    if kind == "qa":
        is_in = contains_any("value", QA_INPUT_KEYWORDS)
        is_out = ~is_in & contains_any("value", QA_OUTPUT_KEYWORDS)
        return hdr.groupBy(*SHEET).agg(F.max(F.when(is_in, F.col("col"))).alias("input_col"),
                                       F.max(F.when(is_out, F.col("col"))).alias("output_col"))
    if kind == "text":
        is_text = contains_any("value", TEXT_KEYWORDS)
        return hdr.groupBy(*SHEET).agg(F.max(F.when(is_text, F.col("col"))).alias("text_col"))
    raise ValueError(f"unknown sheet kind {kind!r}")


def _role_cols(kind: str) -> list[str]:
    return ["input_col", "output_col"] if kind == "qa" else ["text_col"]


def drop_unmapped_sheets(cells: DataFrame, mapping: DataFrame, kind: str = "qa") -> tuple[DataFrame, DataFrame]:
    """(mapping of usable sheets, reject report of the others). QA needs both columns,
    text needs one; a sheet without any header cell is rejected too."""
    cond = None
    for c in _role_cols(kind):
        e = F.col(c).isNotNull()
        cond = e if cond is None else cond & e
    ok = mapping.where(cond)
    sheets = cells.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n_cells"))
    rejects = sheets.join(ok, SHEET, "left_anti").select(*SHEET, F.lit(kind).alias("kind"))
    return ok, rejects


def until_first_blank(rows: DataFrame, header_row: int) -> DataFrame:
    """Keep rows header_row+1, +2, ... up to the first row that is missing; later rows are
    lost even when filled. ``rows`` holds only rows with at least one key cell.

    A sheet stops at its least row number above the header that is absent right after the header or a
    present row: an anti-join on (sheet, row) and a minimum per sheet, so a long sheet is never one task."""
    rows = materialize(rows)  # read three times
    keys = rows.select(*SHEET, "row").where(F.col("row") > header_row)
    heads = rows.select(*SHEET).distinct().withColumn("row", F.lit(header_row))
    after = keys.unionByName(heads).withColumn("row", F.col("row") + 1)
    stops = after.join(keys, [*SHEET, "row"], "left_anti").groupBy(*SHEET).agg(F.min("row").alias("_tf_stop"))
    return (rows.join(stops, SHEET).where((F.col("row") > header_row) & (F.col("row") < F.col("_tf_stop")))
            .select(*rows.columns))


def sheet_records(cells: DataFrame, mapping: DataFrame, header_row: int = 5, kind: str = "qa") -> DataFrame:
    """J3 + P3 + P4: records of the usable sheets. QA -> (file, sheet, row, input, output);
    text -> (file, sheet, row, text). Missing cells of a kept row become ''."""
    roles = _role_cols(kind)
    m = materialize(mapping.select(*SHEET, *roles))
    c = attach_stats(cells.where((F.col("row") > header_row) & F.col("value").isNotNull()), m, SHEET)
    keep = None
    for r in roles:
        e = F.col("col") == F.col(r)
        keep = e if keep is None else keep | e
    names = [r.replace("_col", "") for r in roles]
    rows = (c.where(keep).groupBy(*SHEET, "row")
            .agg(*[F.max(F.when(F.col("col") == F.col(r), F.col("value"))).alias(nm) for r, nm in zip(roles, names)]))
    return fill_missing(until_first_blank(rows, header_row), names)


def read_sheet_table(cells: DataFrame, columns: Sequence[str], sheet_index: int = 0, header_row: int = 1) -> DataFrame:
    """The sheet at ``sheet_index`` of each file as a wide table, header on ``header_row``.
    Columns are pivoted from an explicit list (no discovery pass); absent cells are null; of equal header
    names the left-most column counts."""
    first = cells.where(F.col("sheet_pos") == sheet_index)
    hdr = first.where((F.col("row") == header_row) & F.col("value").isin(list(columns))).select(
        *SHEET, "col", F.col("value").alias("_tf_name"))
    hdr = materialize(hdr)
    data = attach_stats(first.where(F.col("row") > header_row), hdr, [*SHEET, "col"])
    return data.groupBy("file", "row").pivot("_tf_name", list(columns)).agg(F.min_by("value", "col"))
