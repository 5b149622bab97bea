"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (the whole plan
executes, nothing is collected to the driver): one warm-up, then the median
of ``BENCH_REPEAT`` (default 3) timed runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from articleflow.plans import catalog  # noqa: E402
from articleflow.session import build_session  # noqa: E402

HEADLINE = [
    "top_keywords", "daily_keywords", "trend_rising",
    "clean_valid", "dedup_skip", "similar_flag", "clean_stats",
    "url_normalized", "page_extract",
    "hash_vector", "event_components",
    "stream_daily",
    "articles_joined", "quality_metrics",
    "report_rows", "fetch_stats", "stream_ingest", "stream_clean", "merge_clean_upsert", "merge_summary",
]


def run_once(spark, fn, sf: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in catalog.QUERIES]
    spark = build_session(f"local[{cpus}]", app_name="articleflow-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    times: dict[str, float] = {}
    for name in names:
        fn = catalog.QUERIES[name]
        run_once(spark, fn, sf)   # warm-up
        times[name] = round(statistics.median(run_once(spark, fn, sf) for _ in range(repeat)), 3)
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_label}))
    spark.stop()


if __name__ == "__main__":
    main()
