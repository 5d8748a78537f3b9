"""Run headline queries and summarise their final (adaptive) physical plans.

Usage: python scripts/show_plans.py [sf_dir] [name ...] [--full]
Prints, per query, the operator counts that matter for scale (exchanges,
reused exchanges, join strategies, windows, cached scans) and each file scan's
ReadSchema / PushedFilters. ``--full`` also prints the formatted plan.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tariff_engine.plans import catalog  # noqa: E402
from tariff_engine.session import local_session  # noqa: E402

WATCH = ["Exchange", "ReusedExchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate",
         "ObjectHashAggregate", "InMemoryTableScan", "Scan parquet", "Generate"]


def summarise(name: str, plan: str) -> None:
    nodes = re.findall(r"^\(\d+\) ([A-Za-z ]+?)(?: \[codegen id : \d+\])?\s*$", plan, flags=re.M)
    counts = collections.Counter(n.strip() for n in nodes)
    print(f"== {name}")
    print("   " + ", ".join(f"{k}={counts[k]}" for k in WATCH if counts[k]))
    for m in sorted(set(re.findall(r"(ReadSchema: .*|PushedFilters: .*)", plan))):
        print("   " + m[:160])


def main(argv: list[str]) -> None:
    full = "--full" in argv
    args = [a for a in argv[1:] if a != "--full"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or ["price_list", "market_analysis", "performance_summary"]
    spark = local_session(8, 16)
    for name in names:
        df = catalog.CATALOG[name].run(spark, sf_dir)
        df.collect()  # run it, so the adaptive plan is final
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        summarise(name, plan)
        if full:
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
