"""Benchmark the headline queries.

Runs each query of HEADLINE on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS``
(default 3) timed runs. Each run executes the whole plan into Spark's
``noop`` sink (nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "report_daily_sales", "agg_group_multi", "win_cumsum", "win_cumsum_two_pass", "win_rank_dense",
    "win_rank_dense_two_pass", "tx_join_left", "clean_outliers_iqr", "topk_top", "clean_dedup_first",
    "tx_pivot", "kpi_summary", "tx_resample_D", "report_monthly_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from tessera.plans import registry
    from tessera.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    queries, _ = registry.load_all()
    times = {}
    for name in HEADLINE:                                                    # warm-up pass over all queries
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        fn = queries[name]
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
