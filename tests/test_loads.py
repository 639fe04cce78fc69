"""Every load of the reference, end to end, on small tables in its layouts."""

import datetime as dt
import os

from roadloom.plans import loads
from roadloom.sinks import read_current
from roadloom.sources import schemas as S

T0 = dt.datetime(2024, 5, 1, 8, 0)
D0 = dt.date(2020, 5, 1)
AS_OF = "2024-05-02 00:00:00"


def _tables(spark, extra_booking=False, extra_vehicle=False):
    bk = [("b1", "v1", 12.0, T0, T0, False, T0), ("b2", "v1", 8.0, T0, T0, True, T0)]
    if extra_booking:
        bk.append(("b3", "v1", 5.0, T0, T0, False, T0 + dt.timedelta(hours=3)))
    moto = [("m1", D0, dt.date(2022, 5, 1), T0)]
    if extra_vehicle:
        moto.append(("m2", D0, dt.date(2026, 5, 1), T0 + dt.timedelta(hours=2)))
    t = {
        "user": ([("u1", "es", True, True, T0, T0)], S.USER),
        "deleted_user": ([("u2", "en", False, True, T0, T0)], S.USER),
        "profile": ([("u1", "BCN", "x", "08001", "ok", D0, "valid")], S.PROFILE),
        "deleted_profile": ([("u2", "MAD", "y", "28001", "gone", D0, "none")], S.PROFILE),
        "events": ([("u1", T0, "purchase", 10.0), ("u2", T0 + dt.timedelta(days=2), "refund", 3.0)], S.EVENT),
        "bookings": (bk, S.BOOKING),
        "vehicles": ([("v1", "micromobility")], S.VEHICLE_TYPE),
        "raw_data": ([("g1", "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))", "{}")], S.RAW_GEOMETRY),
        "sites": ([("s1", 0.0, 0.0, 3.0, 4.0, 5.0)], S.SITE),
        "vehicle_trip_route_point": ([("t1", T0, 41.39, 2.17), ("t1", T0 + dt.timedelta(minutes=5), 41.40, 2.18)],
                                     S.ROUTE_POINT),
        "vehicle_trip": ([("t1", "scooter", "v1", "p1", "e", 300, 900.0, T0, T0, 1.0, 1.9, "x")], S.TRIP),
        "parking_area": ([("a1", "occupied", T0), ("a2", "available", T0)], S.PARKING_AREA),
        "vehicle_events": ([("v1", T0, "maintenance", "L1", T0), ("v1", T0 + dt.timedelta(minutes=5), "ride", "L2", T0)],
                           S.VEHICLE_EVENT),
        "motorcycles": (moto, S.MOTORCYCLE),
    }
    return lambda name: spark.createDataFrame(*t[name])


def test_all_loads(spark, tmp_dir):
    read = _tables(spark)
    out = tmp_dir
    assert loads.customers_full_load(spark, read, out)["customers"]
    assert {r["user_id"]: r["deleted_user"] for r in read_current(spark, os.path.join(out, "customers")).collect()} \
        == {"u1": False, "u2": True}
    assert loads.customers_delta_load(spark, read, out)["changed"]
    assert not loads.customers_delta_load(spark, read, out)["changed"]
    assert loads.bookings_full_load(spark, read, out, as_of=AS_OF)["year"] == 2024
    assert spark.read.parquet(os.path.join(out, "bookings")).first()["total_bookings"] == 2
    assert loads.bookings_delta_load(spark, read, out)["changed"]
    assert not loads.bookings_delta_load(spark, read, out)["changed"]
    assert loads.bookings_delta_load(spark, _tables(spark, extra_booking=True), out)["changed"]
    assert len(loads.trips_full_load(spark, read, out)) == 4
    assert loads.trips_delta_load(spark, read, out)["changed"]
    assert loads.parking_full_load(spark, read, out)["parking_areas"]
    assert loads.parking_delta_load(spark, read, out, as_of=AS_OF)["changed"]
    assert not loads.parking_delta_load(spark, read, out, as_of=AS_OF)["changed"]
    assert loads.vehicle_events_full_load(spark, read, out)["vehicle_events"]
    assert loads.vehicle_events_delta_load(spark, read, out, as_of=AS_OF)["changed"]
    assert loads.vehicles_full_load(spark, read, out, as_of=AS_OF)["vehicles"]
    assert not loads.vehicles_delta_load(spark, read, out, as_of=AS_OF)["changed"]
    assert loads.vehicles_delta_load(spark, _tables(spark, extra_vehicle=True), out, as_of=AS_OF)["changed"]
    assert read_current(spark, os.path.join(out, "vehicles")).count() == 2
