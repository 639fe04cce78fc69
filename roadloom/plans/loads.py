"""The reference's loads, one function each (full and delta per dataset).

Every load takes ``read(name) -> DataFrame`` for the source tables (bind it to
``read_jdbc`` on the operational database, or to ``read_table`` on Parquet /
catalog tables) and an output base folder.  Table names are the logical ones
of the source queries: user, profile, deleted_user, deleted_profile, events,
bookings, vehicles, raw_data, sites, vehicle_trip_route_point, vehicle_trip,
parking_area, vehicle_events, motorcycles.  ``as_of`` replaces the wall clock.
Each load returns what it published.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators import bookings, customers, events, geo, parking, vehicles
from roadloom.operators.parking import window_filter
from roadloom.plans.pipelines import delta_load, refresh_if_changed, trips_delta
from roadloom.sinks import manifest, write_snapshot, write_versioned

Reader = Callable[[str], DataFrame]


def _path(out: str, name: str, year: int | None = None) -> str:
    """Target of a data set; with ``year`` the one of that year, as the source scripts name theirs by the current year."""
    return f"{out.rstrip('/')}/{name}" + (f"/year={year}" if year is not None else "")


def _day_window(df: DataFrame, ts: str, as_of) -> DataFrame:
    """The delta queries' window: [as_of - 1 day, as_of], closed at both ends."""
    return df.where(window_filter(ts, as_of, dt.timedelta(days=1), "both"))


def customers_full_load(spark: SparkSession, read: Reader, out: str, *, year: int | None = None) -> dict:
    """Live and deleted customers with their profiles, flagged, published."""
    df = customers.customers_full(read("user"), read("profile"), read("deleted_user"), read("deleted_profile"))
    df = df.withColumnRenamed("card_status", "credit_card_status")
    return {"customers": write_versioned(df, _path(out, "customers", year))}


def customers_delta_load(spark: SparkSession, read: Reader, out: str, *, year: int | None = None) -> dict:
    """Event rollup and net purchases per user, flagged deleted; republished where a user's rows changed."""
    ev = read("events")
    activity = customers.customer_activity_union(
        events.event_rollup(ev), events.net_purchases(ev),
        deleted_users=read("deleted_user"), key="user_id", deleted_key="id",
    )
    return delta_load(spark, _path(out, "customer_activity", year), activity, ["user_id"], "user_id",
                      mode="refresh", change_test="rows")


def bookings_full_load(spark: SparkSession, read: Reader, out: str, *, as_of,
                       vehicle_type: str = "micromobility") -> dict:
    """Booking statistics for one vehicle type, in the partition of ``as_of``'s year."""
    year = (dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of).year
    stats = bookings.booking_stats(read("bookings"), read("vehicles"), vehicle_type)
    write_snapshot(stats.withColumn("year", F.lit(year)), _path(out, "bookings"), partition_by=["year"])
    return {"bookings": _path(out, "bookings"), "year": year}


def bookings_delta_load(spark: SparkSession, read: Reader, out: str, *,
                        vehicle_type: str = "micromobility", year: int | None = None) -> dict:
    """Republish the statistics when the newest booking changed."""
    vehicles_df = read("vehicles")
    return refresh_if_changed(spark, _path(out, "booking_stats", year), read("bookings"), "created_on",
                              lambda b: bookings.booking_stats(b, vehicles_df, vehicle_type))


def trips_full_load(spark: SparkSession, read: Reader, out: str, *, year: int | None = None) -> dict:
    """Geometry groups, sites within their radius, first event and day gaps."""
    geometry = geo.geometry_groups(geo.geometry_features(read("raw_data"), decimals=7))
    sites = geo.nearest_per_id(geo.within_radius(read("sites")))
    ev = read("events")
    written = {}
    for name, df in (("trip_geometry", geometry), ("trip_sites", sites),
                     ("trip_first_events", events.event_first(ev)), ("trip_event_gaps", events.event_gaps_days(ev))):
        written[name] = write_versioned(df, _path(out, name, year))
    return written


def trips_delta_load(spark: SparkSession, read: Reader, out: str, *, lateness: dt.timedelta = dt.timedelta(days=1),
                     year: int | None = None) -> dict:
    """First/last point and facts of trips, with the points and facts that arrived since the stored marks.

    Rows count as arrived at ``created_on`` (points) and ``start_time`` (facts), as in the source's queries; rows up to
    ``lateness`` older than the mark are read again, and facts of trips that wait for them always.
    """
    return trips_delta(spark, _path(out, "trips", year), read("vehicle_trip_route_point"), read("vehicle_trip"),
                       points_since="created_on", facts_since="start_time", lateness=lateness,
                       names={"start_created_on": "start_trip_date", "end_created_on": "end_trip_date"})


def parking_full_load(spark: SparkSession, read: Reader, out: str, *, year: int | None = None) -> dict:
    return {"parking_areas": write_versioned(read("parking_area"), _path(out, "parking_areas", year))}


def parking_delta_load(spark: SparkSession, read: Reader, out: str, *, as_of, year: int | None = None) -> dict:
    """Yesterday-to-today occupancy per area, put into the stored areas; only partitions with such an area are written."""
    occ = parking.parking_occupancy(read("parking_area"), as_of, order=False)
    return manifest.merge(spark, _path(out, "parking_occupancy", year), occ, manifest.bucket_of(["area_id"]),
                          lambda stored, delta: delta if stored is None else parking.merge_occupancy(stored, delta))


def vehicle_events_full_load(spark: SparkSession, read: Reader, out: str, *, year: int | None = None) -> dict:
    return {"vehicle_events": write_versioned(events.event_sequence(read("vehicle_events")),
                                              _path(out, "vehicle_events", year))}


def vehicle_events_delta_load(spark: SparkSession, read: Reader, out: str, *, as_of, year: int | None = None) -> dict:
    """Monthly profiles of the vehicles with events in the window, put into the stored ones.

    The window is one day of ``created_on``, the time a row was stored, so an event that arrives late is in the window of the
    day it arrives, whatever its ``event_time``; all months of its vehicle are then worked out again.
    """
    history = read("vehicle_events")
    seen = _day_window(history, "created_on", as_of).select("vehicle_id").distinct()

    def combine(stored: DataFrame | None, window: DataFrame) -> DataFrame:
        if stored is None:
            side = window.select(F.col("vehicle_id").alias("__rl_v"))
            return events.monthly_event_profile(history.join(side, F.col("vehicle_id").eqNullSafe(F.col("__rl_v")), "left_semi"))
        return events.merge_event_profile(stored, history, window)

    return manifest.merge(spark, _path(out, "vehicle_event_profile", year), seen, manifest.bucket_of(["vehicle_id"]), combine)


VEHICLE_DATES = ["motorcycle_id", "purchase_date", "warranty_expiration_date"]


def _warranty_view(rows: DataFrame, *, as_of: str) -> DataFrame:
    return vehicles.warranty_status(rows, as_of, order=False)


manifest.VIEWS["warranty"] = _warranty_view


def _vehicle_dates(rows: DataFrame) -> DataFrame:
    return rows.select("motorcycle_id", F.col("purchase_date").cast("date").alias("purchase_date"),
                       F.col("warranty_expiration_date").cast("date").alias("warranty_expiration_date"))


def vehicles_full_load(spark: SparkSession, read: Reader, out: str, *, as_of, year: int | None = None) -> dict:
    """Dates of all vehicles; readers see the warranty report as of ``as_of`` over them."""
    base = _path(out, "vehicles", year)
    done = manifest.replace(spark, base, _vehicle_dates(read("motorcycles")), manifest.bucket_of(["motorcycle_id"]),
                            parent=manifest.current(spark, base), properties=manifest.view_property("warranty", as_of=str(as_of)[:10]))
    return {"vehicles": base} | done


def vehicles_delta_load(spark: SparkSession, read: Reader, out: str, *, as_of, year: int | None = None) -> dict:
    """Dates of the window's vehicles, put into the stored ones by id.

    Status, age and totals per status depend on the day and on all vehicles, so they are not stored: readers see the report
    as of the last load.  A vehicle added rewrites its partition, not the table.
    """
    def combine(stored: DataFrame | None, delta: DataFrame) -> DataFrame:
        if stored is None:
            return delta
        side = delta.select(F.col("motorcycle_id").alias("__rl_k"))
        return stored.join(side, F.col("motorcycle_id").eqNullSafe(F.col("__rl_k")), "left_anti").unionByName(delta)

    window = _vehicle_dates(_day_window(read("motorcycles"), "created_on", as_of))
    return manifest.merge(spark, _path(out, "vehicles", year), window, manifest.bucket_of(["motorcycle_id"]), combine,
                          properties=manifest.view_property("warranty", as_of=str(as_of)[:10]))
