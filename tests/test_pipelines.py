"""End-to-end loads in scratch folders."""

import json
import os

from pyspark.sql import functions as F

from roadloom.operators.quality import null_report, null_report_of_join
from roadloom.plans.pipelines import delta_load, json_ingestion, run_etl, trips_delta
from roadloom.sinks import manifest, read_current, write_json_lines
from roadloom.sources import read_table
from tests.conftest import SF_SMALL
from tests.test_nested import GEOJSON, RAW


def test_delta_load_watermark_cycle(spark, tmp_dir):
    orders = read_table(spark, "orders", SF_SMALL)
    base = os.path.join(tmp_dir, "orders")
    early = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    assert delta_load(spark, base, early, ["o_orderkey"], "o_orderdate")["initial"]
    # same data again: nothing published
    assert not delta_load(spark, base, early, ["o_orderkey"], "o_orderdate")["changed"]
    # a later window: upserted, history kept
    late = orders.where(F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp_ntz"))
    assert delta_load(spark, base, late, ["o_orderkey"], "o_orderdate")["changed"]
    assert read_current(spark, base).count() == orders.count()


def test_delta_load_key_tests(spark, tmp_dir):
    base = os.path.join(tmp_dir, "k")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    delta_load(spark, base, a, ["id"], "v", mode="refresh", change_test="key_set")
    assert not delta_load(spark, base, a, ["id"], "v", mode="refresh", change_test="key_set")["changed"]
    b = spark.createDataFrame([(1, "x"), (3, "z")], "id int, v string")
    assert not delta_load(spark, base, b, ["id"], "v", mode="refresh", change_test="key_count")["changed"]
    assert delta_load(spark, base, b, ["id"], "v", mode="refresh", change_test="key_set")["changed"]
    assert sorted(r["id"] for r in read_current(spark, base).collect()) == [1, 3]


def test_trips_delta(spark, tmp_dir):
    ev = read_table(spark, "events", SF_SMALL)
    facts = read_table(spark, "customer", SF_SMALL).select(F.col("c_custkey").alias("id"), "c_name")
    base = os.path.join(tmp_dir, "trips")
    first = ev.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    r1 = trips_delta(spark, base, first, facts, trip="user_id", ts="ts", tiebreak="event_id", columns=["value"])
    assert r1["initial"]
    r2 = trips_delta(spark, base, ev, facts, trip="user_id", ts="ts", tiebreak="event_id", columns=["value"])
    assert r2["changed"]
    snap = read_current(spark, base)
    assert snap.count() == snap.select("user_id").distinct().count()


def test_json_pipeline(spark, tmp_dir):
    raw_c, raw_v = os.path.join(tmp_dir, "rc"), os.path.join(tmp_dir, "rv")
    os.makedirs(raw_c), os.makedirs(raw_v)
    json.dump(RAW, open(os.path.join(raw_c, "a.json"), "w"))
    json.dump(GEOJSON, open(os.path.join(raw_v, "b.json"), "w"))
    out = json_ingestion(spark, raw_c, raw_v, os.path.join(tmp_dir, "mid"))
    assert spark.read.json(out["customers"]).count() == 2
    assert spark.read.json(out["vehicles"]).count() == 2  # both inside the city box
    tracks = spark.createDataFrame(
        [("41.38,2.17", "A", "2022-01-01T12:00:00Z", 10.0), ("bad", "A", "2022-01-01T12:00:00Z", 3.0)],
        "gps_coordinates string, vehicle_id string, time_stamp string, distance_traveled double")
    write_json_lines(tracks, os.path.join(tmp_dir, "tracks"))
    stats = run_etl(spark, os.path.join(tmp_dir, "tracks"), os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "rej"))
    assert stats == {"rows_written": 1, "rows_rejected": 1}


def test_null_report_of_join_equals_joined_report(spark):
    docs = read_table(spark, "documents", SF_SMALL)
    labels = read_table(spark, "labels", SF_SMALL)
    a = null_report(docs.join(labels, "doc_id", "left")).first().asDict()
    b = null_report_of_join(docs, labels, ["doc_id"], "left").first().asDict()
    assert a == b


def test_refresh_if_changed_tests_source_rows(spark, tmp_dir):
    from roadloom.operators.bookings import booking_stats
    from roadloom.plans.pipelines import refresh_if_changed

    orders = read_table(spark, "orders", SF_SMALL).withColumn("is_cancelled", F.col("o_orderstatus") == "F")
    cust = read_table(spark, "customer", SF_SMALL)

    def build(b):
        return booking_stats(b, cust, vehicle_type=None, booking_id="o_orderkey", vehicle_id="o_custkey",
                             vehicles_key="c_custkey", type_col="c_mktsegment", duration="o_totalprice",
                             start_time="o_orderdate", end_time="o_orderdate")

    base = os.path.join(tmp_dir, "bookings")
    early = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    assert refresh_if_changed(spark, base, early, "o_orderdate", build)["changed"]
    assert not refresh_if_changed(spark, base, early, "o_orderdate", build)["changed"]
    assert refresh_if_changed(spark, base, orders, "o_orderdate", build)["changed"]
    assert read_current(spark, base).agg(F.sum("total_bookings")).first()[0] == orders.count()


def test_upsert_partitions_rewrites_only_touched_years(spark, tmp_dir):
    from roadloom.plans.pipelines import upsert_partitions

    orders = read_table(spark, "orders", SF_SMALL)
    path = os.path.join(tmp_dir, "orders_by_year")
    upsert_partitions(spark, path, orders.where(F.year("o_orderdate") <= 1999), ["o_orderkey"], "o_orderdate")
    def files():
        parts = manifest.current(spark, path).parts
        return {f"year={y}": (x.folder, sorted(os.listdir(os.path.join(path, "data", x.folder)))) for y, x in parts.items()}

    before = files()
    # changes: some 1999 orders re-sent (one moved into 2000), plus the 2000+ orders
    moved = orders.where(F.year("o_orderdate") == 1999).limit(3).withColumn(
        "o_orderdate", F.lit("2000-06-01").cast("timestamp_ntz"))
    later = orders.where(F.year("o_orderdate") >= 2000)
    res = upsert_partitions(spark, path, later.unionByName(moved), ["o_orderkey"], "o_orderdate")
    assert 1999 in res["partitions"] and 1995 not in res["partitions"]
    after = files()
    assert after["year=1995"] == before["year=1995"]          # untouched partition: same files
    snap = read_current(spark, path)
    assert snap.count() == orders.count()
    assert snap.select("o_orderkey").distinct().count() == orders.count()
    assert snap.where(F.col("o_orderdate") == F.lit("2000-06-01").cast("timestamp_ntz")).count() >= 3
