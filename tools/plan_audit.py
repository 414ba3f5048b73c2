"""Compact physical-plan summary of every registered query.

Usage: python tools/plan_audit.py [sf_dir]

Per query: shuffle exchanges, scans with the columns they read, join kinds
and window operators of the initial physical plan (before AQE re-plans
with runtime sizes).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    scans = re.findall(r"FileScan \w+ \[([^\]]*)\].*?ReadSchema: struct<([^>]*)>", plan)
    tables = re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[file:[^\]]*/([\w.-]+)\]", plan)
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                    r"Exchange SinglePartition|Exchange RoundRobin", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "shj": plan.count("ShuffledHashJoin"),
        "nlj": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans": [(t, len(s[1].split(","))) for t, s in zip(tables, scans)],
    }


def main():
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    print(f"{'query':28s} exch bcast smj bhj shj nlj win  scans(table:cols)")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        scans = " ".join(f"{t.replace('.parquet', '')}:{n}" for t, n in s["scans"])
        print(f"{name:28s} {s['exchanges']:4d} {s['broadcasts']:5d} {s['smj']:3d} {s['bhj']:3d} "
              f"{s['shj']:3d} {s['nlj']:3d} {s['windows']:3d}  {scans}")


if __name__ == "__main__":
    main()
