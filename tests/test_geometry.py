"""Hand-computed shapes: area, perimeter, length, centroid."""

import math

import pytest

from roadloom.operators.geo import geometry_features, geometry_groups


def _one(spark, wkt):
    df = spark.createDataFrame([(1, wkt)], "id int, geometry string")
    return geometry_features(df, id_col="id", wkt="geometry", properties=[]).first()


def test_rectangle_with_unit_hole(spark):
    r = _one(spark, "POLYGON((0 0, 4 0, 4 3, 0 3, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))")
    assert r["area"] == 11.0
    assert r["perimeter"] == 18.0
    assert r["length"] == 0.0
    # (12 * (2, 1.5) - 1 * (1.5, 1.5)) / 11
    assert r["centroid_x"] == pytest.approx((24 - 1.5) / 11)
    assert r["centroid_y"] == pytest.approx((18 - 1.5) / 11)


def test_winding_does_not_matter(spark):
    ccw = _one(spark, "POLYGON((0 0, 4 0, 4 3, 0 3, 0 0))")
    cw = _one(spark, "POLYGON((0 0, 0 3, 4 3, 4 0, 0 0))")
    assert (ccw["area"], ccw["centroid_x"], ccw["centroid_y"]) == (12.0, 2.0, 1.5)
    assert (cw["area"], cw["centroid_x"], cw["centroid_y"]) == (12.0, 2.0, 1.5)


def test_triangle(spark):
    r = _one(spark, "POLYGON((0 0, 3 0, 0 4, 0 0))")
    assert r["area"] == 6.0
    assert r["perimeter"] == 12.0
    assert r["centroid_x"] == 1.0 and r["centroid_y"] == pytest.approx(4 / 3)


def test_linestring_and_point(spark):
    line = _one(spark, "LINESTRING(0 0, 3 4, 3 10)")
    assert line["length"] == 11.0 and line["perimeter"] == 11.0 and line["area"] == 0.0
    assert line["centroid_x"] == pytest.approx((5 * 1.5 + 6 * 3) / 11)
    assert line["centroid_y"] == pytest.approx((5 * 2 + 6 * 7) / 11)
    pt = _one(spark, "POINT(2.5 -1)")
    assert (pt["geom_type"], pt["centroid_x"], pt["centroid_y"], pt["area"]) == ("POINT", 2.5, -1.0, 0.0)


def test_groups_count_identical_shapes(spark):
    rows = [(1, "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))"), (2, "POLYGON((0 0, 0 1, 1 1, 1 0, 0 0))"),
            (3, "POLYGON((5 5, 6 5, 6 6, 5 6, 5 5))")]
    f = geometry_features(spark.createDataFrame(rows, "id int, geometry string"), id_col="id", wkt="geometry")
    counts = {r["id"]: r["count"] for r in geometry_groups(f).collect()}
    assert counts == {1: 2, 2: 2, 3: 1}


def test_haversine_known_distance(spark):
    from pyspark.sql import functions as F

    from roadloom.functions.geometry import haversine_m

    # Barcelona -> Madrid, about 505 km
    d = spark.range(1).select(
        haversine_m(F.lit(41.3874), F.lit(2.1686), F.lit(40.4168), F.lit(-3.7038)).alias("d")
    ).first()["d"]
    assert math.isclose(d, 505_000, rel_tol=0.01)
