"""Sinks (K-1..K-6): JSON lines, split folders, append-only result logs, run folders, build
guard and snapshot selection. Paths may be any Hadoop file system URI."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence
from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SNAPSHOT_PATTERN


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def to_jsonl(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One JSON object per row in ``value``; null fields are left out, non-ASCII kept."""
    cols = list(cols) if cols else df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def write_jsonl(df: DataFrame, path: str, cols: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """K-1."""
    to_jsonl(df, cols).write.mode(mode).text(path)


def write_splits(df: DataFrame, root: str, cols: Sequence[str], split: str = "split", order: str = "order_key",
                 n_files: int | None = None, mode: str = "errorifexists") -> None:
    """K-2: ``split=train/`` and ``split=valid/`` folders of JSON lines, rows in seeded order
    (range-partitioned by (split, order key), sorted inside each file). Without ``n_files`` the
    number of ranges follows the shuffle settings, so file sizes track the data (AQE coalesces)."""
    ranged = df.repartitionByRange(int(n_files), split, order) if n_files else df.repartitionByRange(split, order)
    out = (ranged.sortWithinPartitions(split, order)
           .select(split, F.to_json(F.struct(*cols)).alias("value")))
    out.write.mode(mode).partitionBy(split).text(root)


def append_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """K-3: append rows; every part file written carries its own header."""
    w = df.write.mode("append")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def run_path(base: str, run_id: str) -> str:
    """K-4: one folder per run; a second write to the same run raises instead of overwriting."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"bad run id {run_id!r}")
    return f"{base.rstrip('/')}/run_id={run_id}"


def next_run_path(spark: SparkSession, base: str) -> str:
    """K-4 with numbered runs: ``run_id=<n+1>`` after the highest numbered run under ``base``."""
    nums = [int(n.split("=", 1)[1]) for n in list_dirs(spark, base)
            if n.startswith("run_id=") and n.split("=", 1)[1].isdigit()]
    return run_path(base, str(max(nums, default=0) + 1))


def write_run(df: DataFrame, base: str, run_id: str, fmt: str = "parquet") -> str:
    path = run_path(base, run_id)
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def dataset_path(root: str, makedate: str, seed: int, train_ratio: float, **params) -> str:
    """Folder of one built dataset: every parameter at full precision (80 for 0.8, 80.4 for 0.804);
    valid = 100 - train. Further build parameters follow as name=value folders."""
    pct = format(Decimal(repr(float(train_ratio))) * 100, "f")
    pct = pct.rstrip("0").rstrip(".") if "." in pct else pct
    more = "".join(f"/{k}={v!r}" for k, v in params.items())
    return f"{root.rstrip('/')}/makedate={makedate}/seed={seed}/train_pct={pct}{more}"


def build_if_absent(spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet",
                    lease_seconds: float = 6 * 3600, poll_seconds: float = 1.0) -> DataFrame:
    """K-5: reuse a dataset already built at ``path`` (it has ``_SUCCESS``); otherwise build it.

    The build is written into a folder beside ``path`` and published by one rename, so no reader meets half of
    it. A lease file lets one driver build while others on the same key wait for it; a lease older than
    ``lease_seconds`` counts as left by a crash and is taken over. If a slow builder is overtaken that way, the first to
    publish wins and the other's folder is dropped. A folder without ``_SUCCESS`` is moved aside. Needs a
    store with an atomic rename and exclusive create."""
    path = path.rstrip("/")
    fs, lease = _fs(spark, f"{path}.lease")

    def built() -> bool:
        return path_exists(spark, f"{path}/_SUCCESS")

    while not built():
        fs.mkdirs(lease.getParent())
        if _taken(spark, fs, lease):
            try:
                if not built():
                    _publish(spark, build, path, fmt, built)
            finally:
                fs.delete(lease, False)
        else:
            _drop_expired(spark, fs, lease, lease_seconds)
            time.sleep(poll_seconds)
    return spark.read.format(fmt).load(path)


def _taken(spark: SparkSession, fs, lease) -> bool:
    """Create the lease; of several drivers one succeeds. Hadoop's local file system looks for the file first and
    creates it then, so there two could."""
    if fs.getUri().getScheme() == "file":
        return bool(spark.sparkContext._jvm.java.io.File(lease.toUri().getPath()).createNewFile())
    return bool(fs.createNewFile(lease))


def _publish(spark: SparkSession, build: Callable[[], DataFrame], path: str, fmt: str, built: Callable[[], bool]) -> None:
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    fs, target = _fs(spark, path)
    staged = _fs(spark, stage)[1]
    build().write.format(fmt).save(stage)
    if not built() and fs.exists(target):
        fs.rename(target, _fs(spark, f"{path}.unfinished-{uuid.uuid4().hex}")[1])
    # Onto a folder that came up meanwhile, a rename would move into it.
    if fs.exists(target) or not fs.rename(staged, target):
        fs.delete(staged, True)
        if not built():
            raise OSError(f"could not publish {stage} as {path}")


def _drop_expired(spark: SparkSession, fs, lease, lease_seconds: float) -> None:
    try:
        age = time.time() - fs.getFileStatus(lease).getModificationTime() / 1000
    except Py4JJavaError:  # given back meanwhile
        return
    if age > lease_seconds:
        aside = _fs(spark, f"{lease.toString()}-{uuid.uuid4().hex}")[1]
        if fs.rename(lease, aside):  # one of the waiting drivers succeeds
            fs.delete(aside, False)


def latest_snapshot(spark: SparkSession, root: str, column: str = "makedate") -> str:
    """K-6: the greatest eight-digit ``column=YYYYMMDD`` folder under ``root``; error if none."""
    pat = re.compile(SNAPSHOT_PATTERN)
    names = [n.split("=", 1)[1] for n in list_dirs(spark, root) if n.startswith(f"{column}=")]
    valid = sorted(n for n in names if pat.match(n))
    if not valid:
        raise FileNotFoundError(f"no {column}=YYYYMMDD folder under {root}")
    return f"{root.rstrip('/')}/{column}={valid[-1]}"


def latest_by(df: DataFrame, name_col: str, by: Sequence[str] = ()) -> DataFrame:
    """K-6 on a table of names: greatest valid snapshot name per group (aggregate, no sort)."""
    ok = F.col(name_col).rlike(SNAPSHOT_PATTERN)
    return df.groupBy(*by).agg(F.max(F.when(ok, F.col(name_col))).alias("latest"))


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Put a stopped stream's checkpoint back to before its last batch was noted as done, so that batch runs again."""
    fs, folder = _fs(spark, f"{checkpoint.rstrip('/')}/commits")
    noted = [st.getPath() for st in fs.listStatus(folder) if st.getPath().getName().isdigit()]
    fs.delete(max(noted, key=lambda p: int(p.getName())), False)
