"""Skew evidence: run jobs on flights where one key holds a quarter of all
rows, with Spark's event log in a scratch folder, and report per stage the
largest and the median number of shuffle records a task read.

Usage: python tools/skew_report.py [SF_DIR]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def hot_flights(spark, sf_dir):
    from pyspark.sql import functions as F

    from aerolap.sources.tables import flight_view

    f = flight_view(spark, sf_dir)
    hot = F.col("bucket") == 0  # a quarter of all flights
    return f.select(
        "carrier",
        F.when(hot, F.lit("HOTSRC")).otherwise(F.col("origin")).alias("origin"),
        F.when(hot, F.lit("HUB")).otherwise(F.col("dest")).alias("dest"),
        "dep_delay_min", "arr_delay_min",
        F.when(hot, F.lit(900)).otherwise(F.col("dep_time")).alias("dep_time"),
        F.when(hot, F.lit("1998-01-05").cast("date")).otherwise(F.col("flight_date"))
        .alias("flight_date"),
        "day_of_week", "airline_id")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="aerolap-eventlog-")
    from aerolap.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        # many input splits, as on a cluster: the hot key reaches many map tasks
        "spark.sql.files.maxPartitionBytes": "1m",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    from aerolap.plans import jobs

    f = hot_flights(spark, sf_dir)
    runs = {
        "top_carriers_per_airport": jobs.top_carriers_per_airport(f),
        "top_carriers_per_route": jobs.top_carriers_per_route(f),
        "itinerary_best": jobs.itinerary_best(f),
        "itinerary_lists": jobs.itinerary_k_best(f, k=10),
    }
    total = f.count()
    for name, df in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    reads = defaultdict(list)
    stage_job = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    g = props.get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    if n:
                        reads[ev["Stage ID"]].append(n)
    print(f"input rows {total}, hot key rows ~{total // 4}")
    for sid in sorted(reads):
        r = reads[sid]
        print(f"{stage_job.get(sid)!s:28s} stage {sid:3d} tasks {len(r):3d} "
              f"max {max(r):8d} median {int(statistics.median(r)):8d} total {sum(r):9d}")


if __name__ == "__main__":
    main()
