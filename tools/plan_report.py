"""Summarise the physical plan of every registered query into PLANS.md.

For each key: shuffles (Exchange), broadcasts, join strategies, aggregate
operators, top-k, and the filters pushed into parquet scans.  Queries that
write their targets first are summarised on the DataFrame they return (the
read-back); their write plans are described in README.md.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = r"(Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin" \
      r"|BroadcastExchange|SortMergeJoin \w+|BroadcastHashJoin \w+|ShuffledHashJoin \w+|BroadcastNestedLoopJoin" \
      r"|CartesianProduct|HashAggregate|ObjectHashAggregate|SortAggregate|TakeOrderedAndProject|Window\b" \
      r"|CollectLimit|GlobalLimit)"


def summarise(df) -> tuple[str, str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    formatted = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    ops = re.findall(OPS, plan)
    counts: dict[str, int] = {}
    for o in ops:
        counts[o] = counts.get(o, 0) + 1
    pushed = sorted(set(f for f in re.findall(r"PushedFilters: \[(.*)\]", formatted) if f))
    return ", ".join(f"{k}×{v}" if v > 1 else k for k, v in counts.items()) or "scan/project only", \
        "; ".join(pushed)[:160]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from sluice.catalog import all_queries
    from sluice.session import build_session

    spark = build_session(shuffle_partitions=8)
    print("# Physical plans (generated by tools/plan_report.py)\n")
    print(f"Input: `{sf_dir}`, local[8], AQE on (initial plans before AQE re-optimisation).\n")
    print("| Query | Operators | Pushed filters |\n|---|---|---|")
    for name, fn in all_queries().items():
        ops, pushed = summarise(fn(spark, sf_dir))
        print(f"| `{name}` | {ops} | {pushed.replace('|', '/')} |")
    spark.stop()


if __name__ == "__main__":
    main()
