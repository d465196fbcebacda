"""Summarise the physical plans of registered queries (no execution).

Usage: python tools/plan_summary.py [sf_dir] [key ...]  -> markdown table
Counts shuffle exchanges, broadcast / sort-merge joins, window operators,
Python stages and scans with pushed filters in each executed plan."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _strip_cached(plan: str) -> str:
    """Drop the subtrees printed under InMemoryRelation (plans of already
    materialised fitted state, not executed again)."""
    out, skip_at = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_at is not None and indent > skip_at:
            continue
        skip_at = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip_at = indent
    return "\n".join(out)


def summarize(df) -> dict:
    p = _strip_cached(df._jdf.queryExecution().executedPlan().toString())
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p)),
        "broadcast_joins": p.count("BroadcastHashJoin"),
        "sort_merge_joins": p.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", p)),
        "python": p.count("FlatMapGroupsInPandas") + p.count("ArrowEvalPython") + p.count("BatchEvalPython"),
        "cross": p.count("CartesianProduct") + p.count("BroadcastNestedLoopJoin"),
        "pushed_filter_scans": len(re.findall(r"PushedFilters: \[[^\]]+\]", p)),
    }


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    keys = [a for a in args if not os.path.isdir(a)]
    from bench import HEADLINE
    from wattlake.plans.registry import queries
    from wattlake.session import get_session
    spark = get_session("local[4]", shuffle_partitions=8)
    qs = queries()
    cols = ["shuffles", "broadcast_joins", "sort_merge_joins", "windows", "python", "cross", "pushed_filter_scans"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for k in keys or HEADLINE:
        s = summarize(qs[k](spark, sf_dir))
        print(f"| {k} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
