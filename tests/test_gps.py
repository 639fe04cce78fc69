"""GPS notations -> decimal degrees (FIXTURES.md §4) and the validation rule."""

import pytest
from pyspark.sql import functions as F

from roadloom.functions.gps import component, to_decimal_degrees
from roadloom.operators.gps import normalize_gps, split_rejects, validate_gps

CASES = [
    ("40.785091, -73.968285", 40.785091, -73.968285, "decimal"),
    ("40.785091,-73.968285", 40.785091, -73.968285, "decimal"),
    ("40° 47' 6.32752'' N, 73° 58' 5.82680'' W", 40.785091, -73.968285, "dms"),
    ("40°47'6.32752\"N, 73°58'5.82680\"W", 40.785091, -73.968285, "dms"),
    ("40° 47.10546' N, 73° 58.09788' W", 40.785091, -73.968298, "dm"),
    ("40.785091 N, 73.968285 W", 40.785091, -73.968285, "hemisphere"),
    ("-12.3456 N, 178.1234 W", -12.3456, -178.1234, "hemisphere"),
    ("12.5 S, 1.25 E", -12.5, 1.25, "hemisphere"),
    ("12degrees 34minutes 56seconds N, 78degrees 12minutes 34seconds W", 12.582222, -78.209444, "worded"),
]


@pytest.mark.parametrize("text,lat,lon,fmt", CASES)
def test_notations(spark, text, lat, lon, fmt):
    row = spark.createDataFrame([(text,)], "g string").select(to_decimal_degrees("g").alias("p")).first()["p"]
    assert row["format"] == fmt
    assert row["latitude"] == pytest.approx(lat, abs=1e-6)
    assert row["longitude"] == pytest.approx(lon, abs=1e-6)


def test_component_selection(spark):
    df = spark.createDataFrame([("-12.3456 N, 178.1234 W",)], "g string")
    p = to_decimal_degrees("g")
    r = df.select(component(p, "latitude").alias("a"), component(p, "longitude").alias("b")).first()
    assert (r["a"], r["b"]) == (-12.3456, -178.1234)
    with pytest.raises(ValueError):
        component(p, "altitude")


def test_normalize_rejects_with_reason(spark):
    rows = [(1, "40.785091, -73.968285"), (2, "somewhere"), (3, None), (4, "95.5, 10.0")]
    df = spark.createDataFrame(rows, "id int, g string")
    out = {r["id"]: r for r in normalize_gps(df, "g").collect()}
    assert out[1]["gps_reason"] == "accepted" and out[1]["latitude"] == 40.785091
    assert out[2]["gps_reason"] == "bad_format" and out[2]["latitude"] is None
    assert out[3]["gps_reason"] == "null"
    assert out[4]["gps_reason"] == "out_of_range"
    good, bad = split_rejects(normalize_gps(df, "g"))
    assert good.count() + bad.count() == df.count()


def test_validate_numeric_range_not_text(spark):
    # "2.17" <= "180" is false as text; numerically it is in range
    rows = [("41.38,2.17",), ("41.38 N, 2.17 E",), ("41.38 N, 2.17 E 12.5' 30.25\"",),
            ("41°22'48\"N, 2°10'12\"E",), ("-91.0,2.0",), (None,)]
    df = spark.createDataFrame(rows, "g string")
    reasons = [r["gps_reason"] for r in validate_gps(df, "g").collect()]
    assert reasons == ["accepted", "accepted", "accepted", "bad_format", "out_of_range", "null"]


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([("1.5,2.5",)], "g string")
    plan = normalize_gps(df, "g")._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
