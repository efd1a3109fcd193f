"""Physical-plan summary of every core query (after execution, so AQE's final plan).

    python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffle exchanges (hash / range / round-robin / single-partition),
join strategies, windows, and how many Parquet scans carry pushed filters.
Mart and checkpoint writes done while building a query are separate jobs and
are not part of the query's final plan.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PATTERNS = {
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "round-robin": r"Exchange RoundRobinPartitioning",
    "single-part": r"Exchange SinglePartition",
    "reused exch": r"ReusedExchange",
    "broadcast join": r"BroadcastHashJoin",
    "sort-merge join": r"SortMergeJoin",
    "nested-loop join": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow\b",
    "scans": r"FileScan parquet|Scan ExistingRDD|Scan parquet",
    "scans w/ pushed filters": r"PushedFilters: \[[^\]]",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from zonescope.plans.queries import spark_queries
    from zonescope.session import local_session

    spark = local_session(8)
    print(f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`.  Counts are operators in each query's final plan.\n")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("| --- | " + " | ".join("---" for _ in PATTERNS) + " |")
    for name, build in spark_queries().items():
        df = build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        qe = df._jdf.queryExecution()
        plan = qe.executedPlan().toString()
        counts = [len(re.findall(p, plan)) for p in PATTERNS.values()]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
