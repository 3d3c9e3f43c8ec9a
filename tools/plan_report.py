"""Execute each registered query and summarise its final (AQE) physical plan.

Usage: python tools/plan_report.py [sf_dir] [key ...]
Per key: wall time, counts of shuffle exchanges, reused exchanges, broadcast
exchanges, join kinds, sort-based aggregates, Python evaluation nodes, and the
widest scan schema (column pruning check).
"""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staylens.session import build_session  # noqa: E402

NODES = [
    "ShuffleExchange|Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "ReusedExchange",
    "ReusedSubquery",
    "(?<!ReusedSubquery )Subquery subquery",
    "BroadcastExchange",
    "SortMergeJoin",
    "BroadcastHashJoin",
    "BroadcastNestedLoopJoin",
    "ShuffledHashJoin",
    "SortAggregate",
    "WindowGroupLimit",
    "TakeOrderedAndProject",
    "BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
]


def main():
    from staylens.plans.catalog import QUERIES

    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith(("/", "--"))] or list(QUERIES)
    spark = build_session(shuffle_partitions=16)
    for k in keys:
        df = QUERIES[k](spark, sf_dir)
        t0 = time.time()
        df.collect()  # runs this DataFrame's own execution, so the plan below is AQE-final
        dt = time.time() - t0
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
        plan = plan.split("== Initial Plan ==")[0]
        counts = []
        for pat in NODES:
            n = sum(len(re.findall(p, plan)) for p in pat.split("|"))
            if n:
                label = pat.split("|")[0].replace("(?<!ReusedSubquery )Subquery subquery", "ScalarSubquery")
                counts.append(f"{label}={n}")
        widest = max((s.count(":") for s in re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))), default=0)
        if "--md" in sys.argv:
            print(f"| `{k}` | {widest} | " + ", ".join(counts) + " |")
        else:
            print(f"{k:38s} {dt:5.1f}s widest_scan={widest:2d} " + " ".join(counts))
    spark.stop()


if __name__ == "__main__":
    main()
