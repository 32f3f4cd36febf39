"""Summarise the physical plan of every registered query (static plan, AQE off so the
shape is visible): exchanges, join strategies, single-partition exchanges, Expand,
Python operators, and what each parquet scan reads and pushes down.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from kestrel import session  # noqa: E402
from kestrel.plans.catalog import QUERIES  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "Exchange RoundRobinPartitioning", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "BroadcastNestedLoopJoin", "ShuffledHashJoin", "CartesianProduct", "HashAggregate", "SortAggregate",
       "ObjectHashAggregate", "WindowGroupLimit", "Window", "Expand", "Generate", "ArrowEvalPython",
       "BatchEvalPython", "FlatMapGroupsInPandas"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session.build()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("# Physical plans of the registered queries\n")
    print(f"Static plans (AQE off) on `{sf}`; at runtime AQE may turn a sort-merge join into a "
          "broadcast join when a side turns out small, coalesce partitions and split skewed ones.\n")
    print("`SinglePartition` exchanges only ever carry tiny tables here: the per-bucket totals of a "
          "keyless ordered scan (`operators/prefix.py`, one row per range bucket), rule histories "
          "(a few rows) and final one-row aggregates. Data rows never pass through one task.\n")
    print("| query | exchanges | joins | aggregates / windows | other | scans: table (columns read; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = {op: len(re.findall(r"\b" + re.escape(op) + r"\b", plan)) for op in OPS}
        ex = ", ".join(f"{counts[o]} {o.replace('Exchange ', '')}" for o in OPS[:5] if counts[o])
        jo = ", ".join(f"{counts[o]} {o}" for o in OPS[5:10] if counts[o])
        ag = ", ".join(f"{counts[o]} {o}" for o in OPS[10:15] if counts[o])
        ot = ", ".join(f"{counts[o]} {o}" for o in OPS[15:] if counts[o])
        scans = []
        for line in plan.splitlines():
            if "FileScan parquet" not in line:
                continue
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
            table = re.search(r"/(\w+)\.parquet\]", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            n = len([c for c in cols.group(1).split(",") if c.strip()]) if cols else 0
            scans.append(f"{table.group(1) if table else '?'} ({n} cols; pushed: {pushed.group(1) if pushed and pushed.group(1) else '-'})")
        print(f"| {name} | {ex or '-'} | {jo or '-'} | {ag or '-'} | {ot or '-'} | {'; '.join(scans)} |")


if __name__ == "__main__":
    main()
