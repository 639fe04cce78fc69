"""Empty inputs, NULL keys, window edges, malformed text."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadloom.operators.bookings import booking_stats
from roadloom.operators.events import dedupe_latest, event_first, event_gaps_days, event_sequence
from roadloom.operators.geo import geometry_features
from roadloom.operators.gps import normalize_gps, strict
from roadloom.operators.parking import parking_occupancy
from roadloom.operators.trips import distance_by_year, trip_first_last
from roadloom.operators.vehicles import warranty_status
from roadloom.sources import read_table

EV = "user_id int, event_type string, event_date timestamp_ntz, event_id long"
T0 = dt.datetime(2024, 3, 1)


def test_empty_inputs(spark):
    ev = spark.createDataFrame([], EV)
    assert event_first(ev, tiebreak="event_id").count() == 0
    assert event_gaps_days(ev, tiebreak="event_id").count() == 0
    assert event_sequence(ev, key="user_id", ts="event_date", tiebreak="event_id").count() == 0
    assert dedupe_latest(ev, ["user_id"], ts="event_date").count() == 0
    assert trip_first_last(ev, trip="user_id", ts="event_date", tiebreak="event_id").count() == 0


def test_null_keys_form_their_own_group(spark):
    rows = [(None, "a", T0, 1), (None, "a", T0 + dt.timedelta(days=1), 2), (1, "a", T0, 3)]
    ev = spark.createDataFrame(rows, EV)
    firsts = {(r["user_id"], r["event_id"]) for r in event_first(ev, tiebreak="event_id").collect()}
    assert firsts == {(None, 1), (1, 3)}
    gaps = {r["event_id"]: r["days_since_prev_event"] for r in event_gaps_days(ev, tiebreak="event_id").collect()}
    assert gaps == {1: None, 2: 1, 3: None}
    dist = spark.createDataFrame([(None, 2020, 1.0), ("v", None, 2.0), ("v", 2020, 3.0)],
                                 "vehicle_id string, year int, distance_traveled double")
    assert [(r["vehicle_id"], r["year"]) for r in distance_by_year(dist, unit="km").collect()] == [("v", 2020)]


def test_parking_window_edges(spark):
    rows = [("a", "occupied", dt.datetime(2024, 3, 1)), ("a", "available", dt.datetime(2024, 3, 2)),
            ("a", "reserved", dt.datetime(2024, 3, 1, 12))]
    df = spark.createDataFrame(rows, "area_id string, status string, created_on timestamp_ntz")
    both = parking_occupancy(df, "2024-03-02 00:00:00").first()
    assert (both["total_spaces"], both["occupancy_rate"], both["availability_rate"]) == (3, 0.33, 0.67)
    left = parking_occupancy(df, "2024-03-02 00:00:00", closed="left").first()
    assert left["total_spaces"] == 2


def test_warranty_na_and_boundary(spark):
    rows = [(1, dt.date(2020, 1, 1), dt.date(2024, 1, 1)), (2, dt.date(2020, 1, 1), dt.date(2023, 12, 31)),
            (3, None, dt.date(2024, 1, 1)), (4, dt.date(2021, 1, 1), None)]
    df = spark.createDataFrame(rows, "motorcycle_id int, purchase_date date, warranty_expiration_date date")
    out = {r["motorcycle_id"]: r for r in warranty_status(df, "2024-01-01").collect()}
    assert out[1]["warranty_status"] == "in warranty"        # expires today: still covered
    assert out[2]["warranty_status"] == "out of warranty"
    assert out[3]["warranty_status"] == out[4]["warranty_status"] == "N/A"
    assert out[1]["warranty_duration"] == 1461 and out[1]["age_in_years"] == 4.0
    assert out[3]["total_by_warranty_status"] == 2


def test_booking_stats_rate(spark):
    b = spark.createDataFrame([(1, "v", 10.0, T0, T0, True), (2, "v", 20.0, T0, T0, False),
                               (3, "v", 30.0, T0, T0, False), (4, "w", 5.0, T0, T0, None)],
                              "booking_id int, vehicle_id string, duration double, start_time timestamp_ntz, "
                              "end_time timestamp_ntz, is_cancelled boolean")
    v = spark.createDataFrame([("v", "micromobility"), ("w", "car")], "vehicle_id string, vehicle_type string")
    r = booking_stats(b, v).collect()
    assert len(r) == 1 and r[0]["total_bookings"] == 3 and r[0]["cancellation_rate"] == 33.33


def test_malformed_wkt_gives_nulls_not_errors(spark):
    df = spark.createDataFrame([(1, "POLYGON((0 0, a b, 1 1, 0 0))"), (2, "garbage")], "id int, geometry string")
    out = geometry_features(df, id_col="id", wkt="geometry", properties=[]).collect()
    assert len(out) == 2


def test_strict_mode_fails_on_bad_row(spark):
    df = spark.createDataFrame([("1.0,2.0",), ("bad",)], "g string")
    with pytest.raises(PySparkException):
        strict(normalize_gps(df, "g")).collect()
    assert strict(normalize_gps(df.where(F.col("g") != "bad"), "g")).count() == 1


def test_read_table_missing(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_table(spark, "nope", tmp_dir)


def test_cluster_settings_scale_with_volume():
    from roadloom.session import cluster_settings

    small = cluster_settings(10 * 2**30, executors=10, cores_per_executor=4)
    big = cluster_settings(100 * 2**40)
    assert int(small["spark.sql.shuffle.partitions"]) == 80            # two waves of 40 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000         # capped
    assert int(cluster_settings(2 * 2**40)["spark.sql.shuffle.partitions"]) == 8192
