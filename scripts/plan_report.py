"""Summarise the final (adaptive) physical plan of each bench query.

Usage: python scripts/plan_report.py [sf_dir]
Counts per query: file scans (and which columns), shuffles, reused shuffles,
join strategies, window group limits. Runs each query once to get the plan
as executed.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from termsim.session import local_session  # noqa: E402


def executed(plan: str) -> str:
    """Drop the initial plans that adaptive subqueries also print."""
    kept, skip, root_pending = [], None, False
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if "== Initial Plan ==" in line:
            skip, root_pending = indent, True
            continue
        if skip is not None:
            # the initial plan's root sits at the header's column, its
            # descendants deeper; anything else ends the section
            if (root_pending and indent == skip) or indent > skip:
                root_pending = False
                continue
            skip = None
        kept.append(line)
    return "\n".join(kept)


def summary(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    return {
        "scans": [re.sub(r"#\d+L?", "", s) for s in scans],
        "shuffles": len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "reused_shuffles": plan.count("ReusedExchange"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "window_group_limit": plan.count("WindowGroupLimit"),
        "python_udf": plan.count("EvalPython"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cores=8, shuffle_partitions=16)
    for name, build in bench.QUERIES.items():
        df = build(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().executedPlan().toString()
        print(name, summary(executed(plan)), flush=True)


if __name__ == "__main__":
    main()
