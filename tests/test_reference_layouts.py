"""Operators called with their default column names on the source layouts
(a user can point them at their own tables without renaming)."""

import datetime as dt

from roadloom.operators import bookings, customers, events, geo, parking, trips, vehicles
from roadloom.sources import schemas as S

T0 = dt.datetime(2024, 5, 1, 8, 0)
D0 = dt.date(2020, 5, 1)


def test_customer_and_event_layouts(spark):
    users = spark.createDataFrame([("u1", "es", True, True, T0, T0), ("u2", "en", False, True, T0, T0)], S.USER)
    gone = spark.createDataFrame([("u3", "fr", False, False, T0, T0)], S.USER)
    prof = spark.createDataFrame([(u, "BCN", "x", "08001", "ok", D0, "valid") for u in ("u1", "u2", "u3")], S.PROFILE)
    full = customers.customers_full(users, prof, gone, prof)
    assert {(r["user_id"], r["deleted_user"]) for r in full.collect()} == {("u1", False), ("u2", False), ("u3", True)}
    ev = spark.createDataFrame([("u1", T0, "purchase", 10.0), ("u1", T0 + dt.timedelta(days=3), "refund", 4.0)], S.EVENT)
    net = events.net_purchases(ev).first()
    assert (net["net_purchases"], net["total_purchases"], net["total_refunds"]) == (6.0, 1, 1)
    assert events.event_rollup(ev).count() == 2 + 1 + 1 + 1 + 1
    assert events.event_first(ev).count() == 2
    assert events.event_gaps_days(ev).where("days_since_prev_event IS NULL").count() == 2


def test_booking_parking_vehicle_layouts(spark):
    b = spark.createDataFrame([("b1", "v1", 12.0, T0, T0, False, T0), ("b2", "v1", 8.0, T0, T0, True, T0)], S.BOOKING)
    v = spark.createDataFrame([("v1", "micromobility")], S.VEHICLE_TYPE)
    r = bookings.booking_stats(b, v).first()
    assert (r["total_bookings"], r["cancellation_rate"]) == (2, 50.0)
    areas = spark.createDataFrame([("a1", "occupied", T0), ("a1", "available", T0)], S.PARKING_AREA)
    assert parking.parking_occupancy(areas, T0 + dt.timedelta(hours=1)).first()["occupancy_rate"] == 0.5
    ve = spark.createDataFrame([("v1", T0, "maintenance", "L1", T0), ("v1", T0 + dt.timedelta(minutes=5), "ride", "L2", T0)],
                               S.VEHICLE_EVENT)
    assert events.event_sequence(ve).agg({"event_num": "max"}).first()[0] == 2
    prof = events.monthly_event_profile(ve).first()
    assert (prof["maintenance_events"], prof["unique_locations"], prof["avg_time_between_events"]) == (1, 2, 300.0)
    moto = spark.createDataFrame([("m1", D0, dt.date(2022, 5, 1), T0)], S.MOTORCYCLE)
    assert vehicles.warranty_status(moto, "2024-05-01").first()["warranty_status"] == "out of warranty"


def test_trip_and_geometry_layouts(spark):
    pts = spark.createDataFrame([("t1", T0, 41.39, 2.17), ("t1", T0 + dt.timedelta(minutes=9), 41.40, 2.18)], S.ROUTE_POINT)
    trip = spark.createDataFrame([("t1", "scooter", "v1", "p1", "electric", 540, 1200.0, T0, T0, 1.0, 2.2, "x")], S.TRIP)
    fl = trips.trip_summary(pts, trip).first()
    assert (fl["start_gps_lat"], fl["end_gps_lat"], fl["vehicle_id"]) == (41.39, 41.40, "v1")
    raw = spark.createDataFrame([("g1", "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))", "{}")], S.RAW_GEOMETRY)
    assert geo.geometry_groups(geo.geometry_features(raw)).first()["count"] == 1
    sites = spark.createDataFrame([("s1", 0.0, 0.0, 3.0, 4.0, 5.0), ("s2", 0.0, 0.0, 30.0, 40.0, 5.0)], S.SITE)
    assert [r["id"] for r in geo.within_radius(sites).collect()] == ["s1"]
