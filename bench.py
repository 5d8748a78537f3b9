"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5; the median is reported).
Each query runs to completion through Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver), with the cache cleared before
every run so persisted intermediates are recomputed from the input tables. A query's time includes building its
plan (Python calls and analysis), which is also given apart.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tariff_engine.plans import catalog  # noqa: E402
from tariff_engine.session import local_session  # noqa: E402

HEADLINE = ["price_list", "market_analysis", "performance_summary"]


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="tariff_engine_bench")
    timings: dict[str, float] = {}
    build: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        query = catalog.CATALOG[name]
        for _ in range(2):  # warm-up: JIT compilation and file listing, as on a long-running cluster
            spark.catalog.clearCache()
            query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples, building = [], []
        for _ in range(runs):
            spark.catalog.clearCache()  # every timed run recomputes from the input tables
            t0 = time.perf_counter()
            df = query.run(spark, sf_dir)
            building.append(time.perf_counter() - t0)
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
        build[name] = round(statistics.median(building), 3)
        rows[name] = query.run(spark, sf_dir).count()
    spark.stop()
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "of_which_building": build,
        "rows": rows,
        "sf": _sf(sf_dir),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
