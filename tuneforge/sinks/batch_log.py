"""Result logs that take each batch once (K-3, R1): a batch's id names its folder, and its commit is its ``_SUCCESS``.

A job that stops between writing a batch and noting that it did will hand the batch over again. Here the second
hand-over finds the commit and writes nothing; a folder without commit (a stop in the middle) is written anew. So a
replayed batch neither loses nor repeats a row. Readers see committed batches alone. One driver writes a log at
a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import list_dirs, path_exists


def append_once(df: DataFrame, log: str, batch_id: int) -> bool:
    """Append ``df`` as batch ``batch_id``; False, with nothing written or computed, where that batch is committed."""
    path = f"{log.rstrip('/')}/batch={int(batch_id)}"
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def committed_batches(spark: SparkSession, log: str) -> list[int]:
    log = log.rstrip("/")
    names = [n for n in list_dirs(spark, log) if n.startswith("batch=") and path_exists(spark, f"{log}/{n}/_SUCCESS")]
    return sorted(int(n.split("=", 1)[1]) for n in names)


def read_log(spark: SparkSession, log: str, schema: str) -> DataFrame:
    """The rows of all committed batches, with their ``batch`` (long)."""
    paths = [f"{log.rstrip('/')}/batch={b}" for b in committed_batches(spark, log)]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("long"))
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/[^/]*$", 1).cast("long"))
