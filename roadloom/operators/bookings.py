"""Booking statistics per vehicle (join, conditional aggregate, ratio)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions.columns import mean, percent, total


def booking_stats(
    bookings: DataFrame,
    vehicles: DataFrame,
    vehicle_type: str | None = "micromobility",
    *,
    booking_id: str = "booking_id",
    vehicle_id: str = "vehicle_id",
    vehicles_key: str | None = None,
    type_col: str = "vehicle_type",
    duration: str = "duration",
    start_time: str = "start_time",
    end_time: str = "end_time",
    is_cancelled: str | Column = "is_cancelled",
    float_scale: int | None = None,
    order: bool = True,
) -> DataFrame:
    """Per-vehicle booking counts, durations, time span and cancellation rate.

    The dimension filter (``vehicle_type``) is applied before the join so it is
    pushed to the vehicle scan.  No broadcast is forced: AQE broadcasts the
    filtered dimension only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise it is a sort-merge join
    on the key, and the aggregate reuses that partitioning (no second shuffle).
    """
    vkey = vehicles_key or vehicle_id
    dim = vehicles.select(F.col(vkey).alias("__vk"), F.col(type_col).alias(type_col))
    if vehicle_type is not None:
        dim = dim.where(F.col(type_col) == F.lit(vehicle_type))
    cancelled = F.col(is_cancelled) if isinstance(is_cancelled, str) else is_cancelled
    facts = bookings.select(
        F.col(vehicle_id).alias(vehicle_id),
        F.col(booking_id).alias("__bid"),
        F.col(duration).alias("__dur"),
        F.col(start_time).alias("__start"),
        F.col(end_time).alias("__end"),
        cancelled.alias("__cancelled"),
    )
    joined = facts.join(dim, facts[vehicle_id] == dim["__vk"], "inner")
    n_cancel = F.count_if(F.col("__cancelled"))
    out = joined.groupBy(vehicle_id, type_col).agg(
        F.count("__bid").alias("total_bookings"),
        total("__dur", float_scale).alias("total_duration"),
        mean("__dur", float_scale).alias("avg_duration"),
        F.min("__start").alias("earliest_booking"),
        F.max("__end").alias("latest_booking"),
        n_cancel.alias("total_cancelled_bookings"),
        percent(n_cancel, F.count("__bid")).alias("cancellation_rate"),
    )
    if order:
        out = out.orderBy(F.desc("total_bookings"), F.col(vehicle_id))
    return out
