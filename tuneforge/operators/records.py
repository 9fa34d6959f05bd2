"""Record shaping: fill, drop, dispatch, union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD_COLUMNS = ("source", "row_key", "input", "output", "text")


def fill_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing -> '' for the given string columns (half-empty QA rows are kept)."""
    cols = list(cols) if cols is not None else [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """P5: drop columns when they exist (no error when absent)."""
    return df.drop(*cols)


def keep_only(df: DataFrame, *cols: str) -> DataFrame:
    """Project to the listed columns."""
    return df.select(*cols)


def as_records(df: DataFrame, source: str, key, input=None, output=None, text=None) -> DataFrame:
    """Shape any table into the mixed-corpus record schema (source, row_key, input, output, text)."""
    def c(x):
        return F.lit(None).cast("string") if x is None else (F.col(x) if isinstance(x, str) else x).cast("string")
    return df.select(F.lit(source).alias("source"), c(key).alias("row_key"), c(input).alias("input"),
                     c(output).alias("output"), c(text).alias("text"))


def dispatch_kind(df: DataFrame, out: str = "kind") -> tuple[DataFrame, DataFrame]:
    """P8: 'qa' when input or output is not null, else 'text' when text is not null; rows with
    neither are returned separately as rejects (a real filter, not a null row)."""
    kind = (F.when(F.col("input").isNotNull() | F.col("output").isNotNull(), F.lit("qa"))
            .when(F.col("text").isNotNull(), F.lit("text")))
    tagged = df.withColumn(out, kind)
    return tagged.where(F.col(out).isNotNull()), tagged.where(F.col(out).isNull()).drop(out)


def concat(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def merge_sources(*dfs: DataFrame | None) -> DataFrame:
    """UNION ALL of record sources; missing (None) inputs are skipped, duplicates are kept."""
    present = [d for d in dfs if d is not None]
    if not present:
        raise ValueError("no sources to merge")
    return concat(*present)
