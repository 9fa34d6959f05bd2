"""Physical plan shape of every registered query: no cartesian products or nested-loop joins,
no single-partition exchange (except a top-n head, which is the feature), pruned scans."""

import pytest

from tuneforge.plans.catalog import QUERIES

from .conftest import SF_SMALL

TOP_N = {"bounded_head", "positional_split"}  # TakeOrderedAndProject: the limit is the feature


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _unbounded_single_partition(plan: str) -> bool:
    """A SinglePartition exchange is fine only over a keyless partial aggregate (one row per
    map task, e.g. a global count); anything else funnels data into one task."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            if not ("HashAggregate(keys=[]" in below and "partial_" in below):
                return True
    return False


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_or_single_partition(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in TOP_N:
        assert not _unbounded_single_partition(plan)


def test_split_scan_reads_keys_only(spark):
    plan = _plan(QUERIES["split_exact"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint>" in plan or "struct<doc_id:bigint>" in plan
    assert "text:string" not in plan


def test_role_filter_reaches_the_scan(spark):
    plan = _plan(QUERIES["dialogue_pairs"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(role), Not(EqualTo(role,system))]" in plan or "Not(EqualTo(role,system))" in plan


def test_spread_only_when_under_partitioned(spark, tmp_dir):
    from tuneforge.plans.layout import spread_for_cpu

    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet")  # one row group: fewer splits than slots
    assert "Exchange" in _plan(spread_for_cpu(small, "doc_id"))
    path = f"{tmp_dir}/many"
    spark.range(0, 10_000, 1, 16).write.parquet(path)
    many = spark.read.option("maxPartitionBytes", "1k").parquet(path)
    assert many.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert spread_for_cpu(many, "id") is many
