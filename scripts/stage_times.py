"""Per-stage wall time and task counts of registered queries, from Spark's
event log written to a fresh scratch folder (no UI is started).

usage: python scripts/stage_times.py QUERY [QUERY ...] [--sf DIR] [--runs N]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeops.plans.registry import QUERIES  # noqa: E402
from lakeops.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.1"
    runs = 2
    if "--sf" in args:
        sf = args[args.index("--sf") + 1]
    if "--runs" in args:
        runs = int(args[args.index("--runs") + 1])
    names = [a for a in args if a in QUERIES]
    ev = tempfile.mkdtemp(prefix="lakeops-stages-", dir="/tmp")
    spark = get_spark("local[8]", shuffle_partitions=8, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    for name in names:
        for r in range(runs):
            spark.sparkContext.setJobDescription(f"{name}#{r}")
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    stages, jobs_desc, stage_job = {}, {}, {}
    for f in glob.glob(ev + "/**", recursive=True):
        if not os.path.isfile(f):
            continue
        for line in open(f, encoding="utf-8"):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = desc
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                if "Completion Time" in info and "Submission Time" in info:
                    stages[info["Stage ID"]] = (info["Stage Name"], info["Number of Tasks"],
                                                info["Completion Time"] - info["Submission Time"])
    last = f"#{runs - 1}"
    for sid in sorted(stages):
        desc = stage_job.get(sid, "")
        if desc.endswith(last):
            name, tasks, ms = stages[sid]
            print(f"{desc:24s} stage {sid:4d} tasks={tasks:3d} {ms:6d} ms  {name[:70]}")


if __name__ == "__main__":
    main()
