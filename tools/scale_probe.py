"""Scale probe (not a registered query): the exact split and dialogue pairing on rows derived
from lineitem, replicated N times, grouped by l_returnflag (one flag holds about half of all rows:
a hot group). Prints seconds per stage and the largest task input of the final stage is not
needed: the plan has no window over a group, which tests/test_plans.py checks."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from pyspark.sql import functions as F

    from tuneforge.operators import dialogue, split
    from tuneforge.session import local_session

    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 32
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=64)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.concat_ws(" ", "l_linestatus", "l_partkey").alias("l_comment"))
    # the given file is one parquet row group: spread it as a multi-file input would be
    li = li.repartition(64, "l_orderkey")
    rows = li.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    rows = rows.select(F.col("l_returnflag").alias("source"),
                       F.concat_ws(":", "copy", "l_orderkey", "l_linenumber").alias("row_key"), "l_comment")
    n = rows.count()
    t0 = time.perf_counter()
    out = split.exact_split(rows, "row_key", 0.8, 42, by=["source"])
    got = {(r.source, r.split): r["count"] for r in out.groupBy("source", "split").count().collect()}
    t_split = time.perf_counter() - t0
    utts = rows.select(F.col("source").alias("dlg"),
                       F.monotonically_increasing_id().alias("pos"),
                       (F.split("row_key", ":")[1].cast("long") * 8 + F.split("row_key", ":")[2].cast("long")).cast("int").alias("turn_num"),
                       F.col("l_comment").alias("utterance"))
    t0 = time.perf_counter()
    n_pairs = dialogue.pair_turns(utts).count()
    t_pairs = time.perf_counter() - t0
    result = {"rows": n, "copies": copies, "split_sec": round(t_split, 2), "pairs_sec": round(t_pairs, 2),
              "pairs": n_pairs, "split_counts": got}
    if "--naive" in sys.argv:  # the plan the cut avoids: one sorted window per group
        from pyspark.sql import Window

        from tuneforge.functions.keys import shuffle_hash

        t0 = time.perf_counter()
        h = shuffle_hash("row_key", 42, "split")
        w = Window.partitionBy("source").orderBy(h, "row_key")
        nv = rows.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("source")))
        naive = {(r.source, r.t): r["count"] for r in nv.groupBy("source", (F.col("rn") <= F.floor(F.col("n") * 0.8)).alias("t")).count().collect()}
        result["naive_window_sec"] = round(time.perf_counter() - t0, 2)
        result["naive_matches"] = all(naive[(s, t == "train")] == c for (s, t), c in got.items())
    print(result)
    spark.stop()


if __name__ == "__main__":
    main()
