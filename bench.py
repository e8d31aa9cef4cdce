"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; one warm-up, then the median of $BENCH_REPS runs per query.
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_transactions",
    "stg_service_usage",
    "latest_version_per_key",
    "fct_service_usage",
    "agg_service_frequency",
    "agg_service_usage_daily",
    "agg_customer_service_freq",
    "int_customer_transactions",
    "int_customer_metrics",
    "fact_transactions",
    "fact_customer_activity",
    "activity_second_run",
    "usage_second_run",
    "scd2_check_second",
    "scd2_timestamp_second",
    "scd2_log",
    "report_top_services",
    "report_top_risk",
    "after_image_extract",
    "normalize_changes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from ledgerlake.plans.catalog import QUERIES
    from ledgerlake.session import local_session

    spark = local_session(cpus, app="ledgerlake-bench", **{"spark.driver.memory": "16g"})
    names = only or HEADLINE
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        q = QUERIES[name]
        # warm-up (also the row count), then timed runs that execute the full plan
        rows[name] = q(spark, sf_dir).count()
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "spark": spark.version,
        "master": f"local[{cpus}]",
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "reps": reps,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
