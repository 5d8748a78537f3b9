"""Single-node comparison point: DuckDB running our oracle SQL for the headline queries.

Usage: python scripts/duckdb_baseline.py [sf_dir] [threads ...]
Prints one JSON line per thread count with the median of 3 runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tariff_engine.plans import catalog  # noqa: E402

HEADLINE = ["price_list", "market_analysis", "performance_summary"]


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    threads = [int(t) for t in argv[2:]] or [4, 8]
    sqls = catalog.oracle_sql()
    for n in threads:
        con = duckdb.connect()
        con.execute(f"SET threads = {n}")
        for t in ("customer", "lineitem"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        timings = {}
        for name in HEADLINE:
            samples = []
            for _ in range(3):
                t0 = time.perf_counter()
                con.sql(sqls[name]).fetchall()
                samples.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(samples), 3)
        print(json.dumps({"engine": "duckdb", "threads": n, "sf_dir": sf_dir, "queries": timings,
                          "total": round(sum(timings.values()), 3)}))


if __name__ == "__main__":
    main(sys.argv)
