"""Explicit schemas for the JSON inputs (never inferred at scale)."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

ADDRESS = T.StructType([
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
])

PHONE = T.StructType([T.StructField("type", T.StringType()), T.StructField("number", T.StringType())])

RAW_CUSTOMER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.LongType()),
    T.StructField("address", ADDRESS),
    T.StructField("phoneNumbers", T.ArrayType(PHONE)),
    T.StructField("email", T.StringType()),
    T.StructField("isActive", T.BooleanType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("updatedAt", T.StringType()),
])

RAW_METADATA = T.StructType([
    T.StructField("totalCount", T.LongType()),
    T.StructField("page", T.LongType()),
    T.StructField("limit", T.LongType()),
    T.StructField("generatedAt", T.StringType()),
])

CUSTOMER_ENVELOPE = T.StructType([
    T.StructField("data", T.ArrayType(RAW_CUSTOMER)),
    T.StructField("metadata", RAW_METADATA),
    T.StructField(CORRUPT, T.StringType()),
])

FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.StructType([
        T.StructField("vehicleId", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("speed", T.LongType()),
    ])),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
])

FEATURE_COLLECTION = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(FEATURE)),
    T.StructField(CORRUPT, T.StringType()),
])

# Frame expected by the fleet transformation step.
VEHICLE_TRACK = T.StructType([
    T.StructField("gps_coordinates", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("time_stamp", T.StringType()),
    T.StructField("distance_traveled", T.DoubleType()),
])


_TYPES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "bigint": T.LongType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _s(spec: str) -> T.StructType:
    """'name type, ...' with the simple types above -> StructType (no session needed)."""
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Source tables of the SQL loads (names from the queries, types from their use).
USER = _s("id string, locale string, marketing_accepted boolean, privacy_accepted boolean, "
          "created_on timestamp_ntz, updated_on timestamp_ntz")
PROFILE = _s("user_id string, city string, street string, postal_code string, status string, "
             "birth_date date, card_status string")
EVENT = _s("user_id string, event_date timestamp_ntz, event_type string, event_amount double")
BOOKING = _s("booking_id string, vehicle_id string, duration double, start_time timestamp_ntz, "
             "end_time timestamp_ntz, is_cancelled boolean, created_on timestamp_ntz")
VEHICLE_TYPE = _s("vehicle_id string, vehicle_type string")
RAW_GEOMETRY = _s("id string, geometry string, properties string")
SITE = _s("id string, location_x double, location_y double, longitude double, latitude double, radius double")
ROUTE_POINT = _s("vehicle_trip_id string, created_on timestamp_ntz, gps_lat double, gps_lng double")
TRIP = _s("id string, vehicle_type string, vehicle_id string, provider_id string, propulsion_type string, "
          "trip_duration_seconds bigint, trip_distance_meters double, start_time timestamp_ntz, "
          "end_time timestamp_ntz, initial_odometer_km double, current_odometer_km double, trip_id string")
PARKING_AREA = _s("area_id string, status string, created_on timestamp_ntz")
VEHICLE_EVENT = _s("vehicle_id string, event_time timestamp_ntz, event_type string, event_location string, "
                   "created_on timestamp_ntz")
MOTORCYCLE = _s("motorcycle_id string, purchase_date date, warranty_expiration_date date, created_on timestamp_ntz")
