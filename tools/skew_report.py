"""Per-task balance of ordered_sequence on a hot key, from Spark's event log.

Usage: python tools/skew_report.py [sf_dir] [copies]
Derives an events table from ``sf_dir/events.parquet`` (``copies`` shifted
copies, every third row moved to user 0, i.e. one key with a third of all
rows) in a new scratch folder, runs the window plainly and with the hot-key
split, and prints, for the window stage of each, the records read by the
largest and the median task.  The event log goes to the scratch folder; no UI.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

import zstandard
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from roadloom.operators.sequence import ordered_sequence  # noqa: E402
from roadloom.session import build_session  # noqa: E402


def read_events(log_dir: str):
    for f in sorted(glob.glob(os.path.join(log_dir, "*", "events_*"))):
        with open(f, "rb") as fh:
            stream = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                yield json.loads(line)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    copies = int(argv[2]) if len(argv) > 2 else 10
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    spark = build_session("local[8]", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf}/events.parquet")
    parts = [ev.withColumn("event_id", F.col("event_id") + i * 10_000_000)
               .withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(31 * i))) for i in range(copies)]
    data = parts[0]
    for p in parts[1:]:
        data = data.unionByName(p)
    data = data.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    data.write.parquet(os.path.join(scratch, "hot_events"))
    df = spark.read.parquet(os.path.join(scratch, "hot_events")).select("event_id", "user_id", "ts")
    total = df.count()
    runs = {"plain window": dict(max_group_rows=None), "hot-key split": dict(max_group_rows=total // 20, split=32)}
    for label, kw in runs.items():
        spark.sparkContext.setJobGroup(label, label)
        ordered_sequence(df, ["user_id"], ["ts", "event_id"], row_number="rn", lags={"prev": "ts"}, **kw) \
            .write.format("noop").mode("overwrite").save()
    spark.stop()
    group, reads = {}, {}
    for e in read_events(logs):
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                group[s] = e.get("Properties", {}).get("spark.jobGroup.id")
        elif e["Event"] == "SparkListenerTaskEnd":
            n = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            if n:
                reads.setdefault(e["Stage ID"], []).append(n)
    print(f"rows {total}, hot key rows {total // 3} (approx), scratch {scratch}")
    for stage, recs in sorted(reads.items()):
        if sum(recs) == total:  # the stage that reads every row: the window
            print(f"{group.get(stage)}: tasks {len(recs)}, largest task {max(recs)} records, "
                  f"median {int(statistics.median(recs))}")


if __name__ == "__main__":
    main(sys.argv)
