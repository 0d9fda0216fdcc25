"""Task balance of the global prefix scan under a hot timestamp, from
Spark's event log (written to a fresh scratch folder).

A third of the rows share one timestamp. The range-partitioned scan
(``operators.scan``) is compared with the obvious alternative, a window
partitioned by a time bucket. Prints shuffle records read per task for each
stage that reads at least half the rows. A third case replays a log where
one ticket holds a third of the records: after the map-side partial
aggregate only one row per (task, ticket) reaches the shuffle.

usage: python scripts/skew_balance.py [rows]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lakeops.operators.scan import exclusive_running_max  # noqa: E402
from lakeops.session import get_spark  # noqa: E402


def stage_records(ev: str) -> dict[int, list[int]]:
    stages: dict[int, list[int]] = {}
    for f in glob.glob(ev + "/**", recursive=True):
        if not os.path.isfile(f):
            continue
        for line in open(f, encoding="utf-8"):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                rr = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                stages.setdefault(e["Stage ID"], []).append(rr)
    return stages


def run(kind: str, n: int) -> None:
    ev = tempfile.mkdtemp(prefix=f"lakeops-evlog-{kind}-", dir="/tmp")
    spark = get_spark("local[8]", shuffle_partitions=8, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1_000_000)).otherwise(F.col("id")).alias("ts"),
        F.col("id").alias("rid"),
        F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"))
    if kind == "range_scan":
        out = exclusive_running_max(df, ["ts", "rid"], "v", "p", 8)
    elif kind == "replay":
        from lakeops.plans.tickets import replay
        log = df.select(F.col("rid").alias("lsn"),
                        F.when(F.col("rid") % 7 == 0, "DELETE").otherwise("CREATE").alias("op"),
                        F.when(F.col("ts") == 1_000_000, F.lit("hot"))
                        .otherwise((F.col("rid") % 5000).cast("string")).alias("ticket_id"),
                        F.lit("p").alias("passenger_name"), F.lit(None).cast("timestamp").alias(
                            "created_at"), F.lit(None).cast("timestamp").alias("expires_at"))
        out = replay(log.repartition(8))
    else:
        w = (Window.partitionBy(F.floor(F.col("ts") / 100_000)).orderBy("ts", "rid")
             .rowsBetween(Window.unboundedPreceding, -1))
        out = df.withColumn("p", F.max("v").over(w))
    out.write.format("noop").mode("overwrite").save()
    spark.stop()
    for sid, recs in sorted(stage_records(ev).items()):
        if sum(recs) >= n // 2 or (kind == "replay" and sum(recs) and max(recs) < n // 2):
            print(f"{kind:14s} stage {sid:3d}: tasks={len(recs)} records/task "
                  f"max={max(recs)} median={int(statistics.median(recs))} total={sum(recs)}")


if __name__ == "__main__":
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 300_000
    run("range_scan", rows)
    run("bucket_window", rows)
    run("replay", rows)
