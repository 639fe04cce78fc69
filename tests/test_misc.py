"""Small operators not covered elsewhere."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from roadloom.functions.columns import fraction, percent
from roadloom.operators.nested import collection_features, typed_value, unwrap
from roadloom.operators.trips import route_points
from roadloom.sources import read_jdbc, read_snapshot_keys, read_table
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def test_unwrap_envelope_rows(spark):
    df = spark.createDataFrame([([(1, "a"), (2, "b")],), ([(3, "c")],)], "data array<struct<id:int, name:string>>")
    assert sorted(map(tuple, unwrap(df).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_typed_value_missing_type_is_null(spark):
    df = spark.createDataFrame([([("home", "1")],)], "p array<struct<type:string, number:string>>")
    r = df.select(typed_value("p", "home").alias("h"), typed_value("p", "work").alias("w")).first()
    assert (r["h"], r["w"]) == ("1", None)


def test_route_points_are_ordered_rows(spark):
    rows = [("v", T0 + dt.timedelta(minutes=m), float(m), 0.0) for m in (5, 1, 3)]
    df = spark.createDataFrame(rows, "vehicle_id string, time_stamp timestamp_ntz, latitude double, longitude double")
    got = [(r["point_index"], r["latitude"]) for r in route_points(df).orderBy("point_index").collect()]
    assert got == [(1, 1.0), (2, 3.0), (3, 5.0)]


def test_collection_features(spark):
    feat = ("Feature", ("V1", "one", 10), ("Point", [2.1, 41.3]))
    df = spark.createDataFrame(
        [("FeatureCollection", [feat])],
        "type string, features array<struct<type:string, properties:struct<vehicleId:string, name:string, "
        "speed:bigint>, geometry:struct<type:string, coordinates:array<double>>>>")
    r = collection_features(df).first()
    assert (r["vehicle_id"], r["longitude"], r["latitude"]) == ("V1", 2.1, 41.3)


def test_snapshot_keys_are_pruned(spark, tmp_dir):
    from roadloom.plans.checks import scan_details

    path = os.path.join(tmp_dir, "snap")
    read_table(spark, "orders", SF_SMALL).write.parquet(path)
    keys = read_snapshot_keys(spark, path, ["o_orderkey"])
    assert "ReadSchema: struct<o_orderkey:bigint>" in scan_details(keys)


def test_ratio_helpers_handle_zero(spark):
    r = spark.range(1).select(fraction(F.lit(1), F.lit(0)).alias("a"), percent(F.lit(1), F.lit(3)).alias("b"),
                              fraction(F.lit(29), F.lit(200)).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (None, 33.33, 0.15)


def test_jdbc_reader_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t", partition_column="id")
