"""Write PLANS.md: a summary of every report's physical plan over a stored star.

Usage: python tools/plan_report.py <source folder> <scratch folder>
The star is built from the source tables into the scratch folder first.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.reports import QUERIES  # noqa: E402
from revlens.session import build_session  # noqa: E402
from revlens.sources.star import Star  # noqa: E402


def summarize(plan: str) -> dict[str, str]:
    lines = plan.splitlines()
    ex = [ln for ln in lines if "Exchange " in ln and "ReusedExchange" not in ln]
    kinds = {
        "hash": sum("hashpartitioning" in ln for ln in ex),
        "range": sum("rangepartitioning" in ln for ln in ex),
        "single": sum("SinglePartition" in ln for ln in ex),
        "broadcast": sum("BroadcastExchange" in ln for ln in lines),
    }
    joins = sorted({m.group(0) for ln in lines for m in [re.search(
        r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", ln)] if m})
    extras = [k for k in ("WindowGroupLimit", "TakeOrderedAndProject", "Subquery", "Expand", "Generate")
              if k in plan]
    pruned = sorted({m.group(1) for m in re.finditer(r"PartitionFilters: \[([^\]]*fiscal_year[^\]]*)\]", plan)})
    return {"exchanges": ", ".join(f"{k} {v}" for k, v in kinds.items() if v) or "none",
            "joins": ", ".join(joins) or "-", "other": ", ".join(extras) or "-",
            "fy_pruning": "yes" if any("= " in p or "IN" in p for p in pruned) else "-"}


def main(src: str, scratch: str) -> None:
    spark = build_session()
    star_dir = os.path.join(scratch, "star")
    Star.build(spark, src, star_dir)
    rows = ["| Query | Exchanges (not reused) | Joins | Other operators | FY partition pruning |",
            "| --- | --- | --- | --- | --- |"]
    for name, q in QUERIES.items():
        execution = q(spark, star_dir)._jdf.queryExecution()
        execution.toRdd().count()  # runs it, so that the plan is the one adaptive execution ended with
        plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarize(plan)
        rows.append(f"| {name} | {s['exchanges']} | {s['joins']} | {s['other']} | {s['fy_pruning']} |")
    text = ("# PLANS — physical plan summary of every report\n\n"
            f"Final adaptive plans (as run) over a star stored from `{src}`, "
            "facts partitioned by fiscal_year, Spark's default broadcast threshold raised to 32 MB "
            "(`revlens.session`). Exchange counts exclude broadcasts, which are listed separately. "
            "`single` exchanges only ever carry partial-aggregate rows of a global total "
            "(checked by `tests/test_plans.py`). Generated by `tools/plan_report.py`.\n\n"
            + "\n".join(rows) + "\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write(text)
    print(text)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
