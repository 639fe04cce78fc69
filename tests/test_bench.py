"""bench.py prints one JSON line with a time per query."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="booking_stats,event_first", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"booking_stats", "event_first"}
    assert result["value"] == round(sum(result["queries"].values()), 4)


def test_checkpoint_dir_comes_from_the_cluster_setting(tmp_path):
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from roadloom.session import build_session, checkpoint_dir
spark = build_session("local[1]", extra={{"spark.checkpoint.dir": {str(tmp_path / 'shared')!r}}})
print(checkpoint_dir(spark, fallback_base="/nonexistent"))
df = spark.range(10).checkpoint(eager=True)
print(df.count())
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300,
                         check=True).stdout.split()
    assert out[0].endswith("shared") and out[1] == "10"
    assert any((tmp_path / "shared").iterdir())


def test_entry_in_a_plain_session():
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").getOrCreate())
import __spark_entry__ as e
df = e.entry(spark)
rows = df.collect()
print(len(rows), ",".join(df.columns))
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300,
                         check=True).stdout.split()
    assert int(out[0]) > 0
    assert out[1] == ("vehicle_id,vehicle_type,total_bookings,total_duration,avg_duration,earliest_booking,"
                      "latest_booking,total_cancelled_bookings,cancellation_rate")
