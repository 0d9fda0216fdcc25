"""Write PLANS.md: the final (post-AQE) physical plan of every registered
query on the given scale factor, plus a per-query count of shuffles, joins
and aggregate kinds.

usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakeops.plans.registry import QUERIES  # noqa: E402
from lakeops.session import get_spark  # noqa: E402

KINDS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin",
         "Exchange SinglePartition", "BroadcastExchange", "ReusedExchange",
         "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin",
         "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
         "TakeOrderedAndProject"]


def shorten(line: str, width: int = 170) -> str:
    line = re.sub(r"#\d+L?", "", line)
    return line if len(line) <= width else line[:width] + " …"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = ["# Physical plans", "",
           f"Final adaptive plans of every registered query on `{sf}` (local[8], "
           "8 shuffle partitions), generated by `scripts/dump_plans.py`. Attribute ids are "
           "removed and long lines cut. Every test table is one parquet file, which is why "
           "small dimensions broadcast; at scale the same joins become sort-merge joins "
           "when the size checks say so.", ""]
    summary = ["| query | " + " | ".join(k.replace("Exchange ", "X-") for k in KINDS) + " |",
               "|---|" + "---|" * len(KINDS)]
    bodies = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        # final plan lines only (drop the "initial plan" duplicate of AQE)
        if "== Initial Plan ==" in plan:
            plan = plan.split("== Initial Plan ==")[0]
        lines = [shorten(x) for x in plan.splitlines() if x.strip() and "== Final Plan ==" not in x]
        counts = [sum(1 for x in lines if k in x) for k in KINDS]
        summary.append(f"| {name} | " + " | ".join(str(c) if c else "" for c in counts) + " |")
        bodies += [f"## {name}", "", "```", *lines, "```", ""]
    out += summary + [""] + bodies
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
