"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tuneforge") -> SparkSession:
    """Session for tests and the local bench. On a cluster use the cluster's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    A cluster must name a shared folder; only a local-mode session without one gets a fresh
    scratch folder (the test/bench case)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="tuneforge-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write a derived table as Parquet into the shared folder and read it back.

    Used for statistics and for rows that several jobs read. A lost executor re-reads the files instead of
    re-running the plan, later passes scan only the columns they need, and the planner knows the table's
    size before it broadcasts."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
