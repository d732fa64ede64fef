"""Physical-plan summary of every registered query (markdown table).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
(The corpus operators run jobs of their own and are measured by other means.)
Counts file scans, exchanges by kind and join strategies in the physical
plan Spark chooses before adaptive re-planning.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = [("scans", r"(?:FileScan|BatchScan) parquet"), ("hash exch", r"Exchange hashpartitioning"),
       ("single exch", r"Exchange SinglePartition"), ("round-robin exch", r"Exchange RoundRobinPartitioning"),
       ("range exch", r"Exchange rangepartitioning"), ("SMJ", r"SortMergeJoin"),
       ("BHJ", r"BroadcastHashJoin"), ("nested loop", r"BroadcastNestedLoopJoin|CartesianProduct"),
       ("python", r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas")]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tidemark.session import build_session
    from tidemark.plans.queries import QUERIES
    spark = build_session("local[8]", shuffle_partitions=16)
    print("| query | " + " | ".join(name for name, _ in OPS) + " |")
    print("| --- |" + " --- |" * len(OPS))
    for n, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = collections.Counter()
        for name, rx in OPS:
            c[name] = len(re.findall(rx, plan))
        print(f"| `{n}` | " + " | ".join(str(c[name]) for name, _ in OPS) + " |")


if __name__ == "__main__":
    main()
