"""Nested JSON reshaping: envelopes, structs, typed arrays, GeoJSON, metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.functions.columns import col, parse_iso_utc
from roadloom.functions.naming import snake_case, snake_case_type

# Fixed value: ISO-8601 UTC timestamps as written in the sample documents.
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"


def unwrap(df: DataFrame, array_col: str = "data") -> DataFrame:
    """One row per element of ``data[]`` with the element's fields as columns."""
    return df.select(F.inline(array_col))


def address_line(address: str | Column) -> Column:
    """struct(street, city, state, zip) -> 'street, city state zip'."""
    a = col(address)
    return F.concat_ws(", ", a["street"], F.concat_ws(" ", a["city"], a["state"], a["zip"]))


def typed_value(array: str | Column, type_value: str, *, type_field: str = "type",
                value_field: str = "number") -> Column:
    """Value of the first element whose ``type_field`` equals ``type_value``."""
    return F.get(F.filter(col(array), lambda e: e[type_field] == F.lit(type_value)), 0)[value_field]


def to_snake_case(df: DataFrame) -> DataFrame:
    """Rename columns and nested struct fields from camelCase to snake_case."""
    out = []
    for f in df.schema.fields:
        new_type = snake_case_type(f.dataType)
        c = F.col(f"`{f.name}`")
        if new_type != f.dataType:
            c = c.cast(new_type)
        out.append(c.alias(snake_case(f.name)))
    return df.select(*out)


def flatten_contacts(
    records: DataFrame,
    *,
    id_col: str = "id",
    address: str = "address",
    phones: str = "phoneNumbers",
    phone_types: tuple[str, ...] = ("home", "work"),
    timestamp_cols: tuple[str, ...] = ("createdAt", "updatedAt"),
    rename_id: str | None = "user_id",
) -> DataFrame:
    """Raw customer records -> flat rows (address line, phone columns,
    snake_case names, parsed timestamps, ``id`` renamed)."""
    cols = []
    for name in records.columns:
        if name == address:
            cols.append(address_line(name).alias(name))
        elif name == phones:
            cols.extend(typed_value(name, t).alias(f"phone_{t}") for t in phone_types)
        elif name in timestamp_cols:
            cols.append(parse_iso_utc(name, ISO_UTC_FORMAT).alias(name))
        else:
            cols.append(F.col(name))
    flat = to_snake_case(records.select(*cols))
    if rename_id and id_col in flat.columns:
        flat = flat.withColumnRenamed(id_col, rename_id)
    return flat


# Schema of one GeoJSON Feature with point geometry (coordinates are [lon, lat]).
FEATURE_SCHEMA = T.StructType([
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


def _feature_columns(f: Column) -> list[Column]:
    return [
        f["properties"]["vehicleId"].alias("vehicle_id"),
        f["properties"]["name"].alias("name"),
        f["properties"]["speed"].alias("speed"),
        f["geometry"]["type"].alias("geometry_type"),
        F.get(f["geometry"]["coordinates"], 0).alias("longitude"),
        F.get(f["geometry"]["coordinates"], 1).alias("latitude"),
    ]


def feature_rows(features: DataFrame, feature_col: str = "feature", keep: list[str] | None = None) -> DataFrame:
    """Feature structs -> (vehicle_id, name, speed, geometry_type, longitude, latitude)."""
    return features.select(*(keep or []), *_feature_columns(F.col(feature_col)))


def geojson_features(df: DataFrame, text_col: str = "feature_json", keep: list[str] | None = None) -> DataFrame:
    """GeoJSON Feature text column -> typed rows (explicit schema, no inference)."""
    parsed = df.select(*(keep or []), F.from_json(F.col(text_col), FEATURE_SCHEMA).alias("feature"))
    return feature_rows(parsed, keep=keep)


def collection_features(collection: DataFrame, features_col: str = "features") -> DataFrame:
    """FeatureCollection rows -> one row per feature."""
    return feature_rows(collection.select(F.explode(features_col).alias("feature")))


def metadata_row(df: DataFrame, generated_at: dt.datetime | str) -> DataFrame:
    """One-row metadata table: total_count and generated_at."""
    ts = generated_at.isoformat(sep=" ") if isinstance(generated_at, dt.datetime) else generated_at
    return df.agg(F.count(F.lit(1)).alias("total_count")).withColumn(
        "generated_at", F.lit(ts).cast("timestamp_ntz")
    )
