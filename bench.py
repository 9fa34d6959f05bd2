"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one
JSON line. Each query (planning included) runs to completion into the no-op sink (the whole plan
executes, nothing is collected), $BENCH_RUNS times (default 2), and the fastest run is kept. The
headline metric is the sum over the five headline queries."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("split_exact", "mix_dialogue", "encode_fixed", "pad_batches", "sft_build")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    from tuneforge.plans.catalog import QUERIES
    from tuneforge.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="tuneforge-bench")
    # warm-up: JVM, parquet footers, Python workers
    QUERIES["merge_sources"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        best = float("inf")
        for _ in range(runs):  # plan + run; the minimum drops one-off JIT warm-up of new operators
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    headline = round(sum(times[q] for q in HEADLINE if q in times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": headline, "unit": "sec", "queries": times,
                      "total_sec": round(sum(times.values()), 3), "sf": sf, "cpus": int(cpus),
                      "runs": runs, "stat": "min",
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
