"""Physical-plan report for every registered query (scale review aid).

    python tests/plan_report.py [sf_dir] [name ...]

Per query: parquet scans with the columns read and the filters pushed into
them, and counts of shuffles, broadcasts, join strategies and Python nodes.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
COUNTED = ("Exchange hashpartitioning", "Exchange rangepartitioning", "BroadcastExchange",
           "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "MapInPandas",
           "FlatMapCoGroupsInPandas", "ArrowEvalPython", "Window")


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def report(name: str, plan: str) -> dict:
    scans = []
    for line in re.findall(r"FileScan parquet [^\n]*", plan):
        t = re.search(r"/(\w+)\.parquet", line)
        cols = re.search(r"ReadSchema: struct<([^\n]*?)>(?:,|$)", line)
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        scans.append({"table": t.group(1) if t else "?",
                      "columns": len(re.findall(r"\w+:", cols.group(1))) if cols else None,
                      "pushed": pf.group(1) if pf and pf.group(1) else ""})
    return {"name": name, "scans": scans, "counts": {k: plan.count(k) for k in COUNTED},
            "forbidden": [k for k in FORBIDDEN if k in plan]}


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    from flurry.session import get_session
    from flurry.plans.registry import QUERIES
    spark = get_session("local[8]", shuffle_partitions=8)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        r = report(name, physical_plan(fn(spark, sf_dir)))
        bad += bool(r["forbidden"])
        counts = ", ".join(f"{k.split()[-1]}={v}" for k, v in r["counts"].items() if v)
        print(f"{name}: {counts}{'  FORBIDDEN ' + str(r['forbidden']) if r['forbidden'] else ''}")
        for s in r["scans"]:
            print(f"    scan {s['table']}: {s['columns']} cols, pushed [{s['pushed']}]")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
