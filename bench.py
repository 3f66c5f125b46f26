"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully executed with the ``noop`` sink (every row produced, nothing
collected to the driver). Times include the query's own side jobs (watermarks,
range plans, staged writes), i.e. what a user of the job waits for. Before timing,
every query runs once on the smallest data set (sf0.001, when present) so the
numbers are steady-state JVM times, as on a long-running cluster, not JIT warm-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cdc_merge", "cdc_sync_job", "cdc_sync_bucketed", "stream_cdc", "version_upsert",
    "merge_three_clause", "keep_latest", "max_over_keep_ties", "ntile_ranges",
    "range_read_once", "keyset_page", "federated_join", "federated_topn",
    "parquet_roundtrip", "compacted_roundtrip", "rates_lookup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    names = sys.argv[1:] or HEADLINE
    from tidemark.session import build_session
    from tidemark.suite import QUERIES

    spark = build_session(
        f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=max(4, cpus * 2),
        extra={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g")})
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
