"""Static physical-plan summary of every registered query -> PLANS.md.

    python tools/plan_report.py [--sf DIR] [--out PLANS.md]

Counts, per query, the shuffles (Exchange), join strategies, windows, aggregate
kinds, Python stages and any nested-loop / cartesian join, from the plan Spark
builds before AQE re-plans at run time (AQE may still turn a shuffle join into a
broadcast once it has measured a side).
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTS = [
    ("shuffles", r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
    ("broadcast joins", r"BroadcastHashJoin"),
    ("sort-merge joins", r"SortMergeJoin"),
    ("nested-loop / cartesian", r"BroadcastNestedLoopJoin|CartesianProduct"),
    ("windows", r"\bWindow \["),
    ("hash aggs", r"\bHashAggregate\("),
    ("sort aggs", r"\bSortAggregate\("),
    ("python stages", r"MapInPandas|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas"),
    ("generate", r"\bGenerate "),
]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default="PLANS.md")
    a = ap.parse_args()
    from strata.plans.queries import REGISTRY
    from strata.session import get_session
    spark = get_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rows = []
    for name, fn in REGISTRY.items():
        plan = fn(spark, a.sf)._jdf.queryExecution().executedPlan().toString()
        rows.append([name] + [str(len(re.findall(p, plan))) for _, p in COUNTS])
    head = ["query"] + [c for c, _ in COUNTS]
    lines = [
        "# PLANS",
        "",
        "Static physical plans of every registered query (generated by "
        "`tools/plan_report.py`, AQE off so the plan is the one Spark commits to before "
        "measuring; at run time AQE may only turn shuffle joins into broadcasts, coalesce "
        "partitions and split skewed ones). Input: `" + a.sf + "`.",
        "",
        "| " + " | ".join(head) + " |",
        "|" + "---|" * len(head),
    ]
    lines += ["| " + " | ".join(r) + " |" for r in rows]
    with open(a.out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {a.out}: {len(rows)} queries")


if __name__ == "__main__":
    main()
