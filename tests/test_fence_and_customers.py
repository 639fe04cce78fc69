"""Fence invariants and customer joins on small hand-made frames."""

from pyspark.sql import functions as F

from roadloom.operators.customers import customer_activity_union, customers_full, flag_existing
from roadloom.operators.geo import BARCELONA_BOX, fence_zone, geo_fence, nearest_within, within_radius
from roadloom.operators.trips import clean_positions, run_fleet_pipeline


def _points(spark):
    rows = [(1, 41.3, 2.1), (2, 41.5, 2.1), (3, 41.2, 2.1), (4, 41.3, 2.0), (5, 41.3, 2.2),
            (6, 40.0, 2.1), (7, None, 2.1), (8, 41.45, 2.19)]
    return spark.createDataFrame(rows, "id int, latitude double, longitude double")


def test_strict_bounds_and_partition(spark):
    df = _points(spark)
    inside = {r["id"] for r in geo_fence(df, box=BARCELONA_BOX, mode="inside").collect()}
    outside = {r["id"] for r in geo_fence(df, box=BARCELONA_BOX, mode="outside").collect()}
    assert inside == {1, 8}            # points on an edge are outside
    assert outside == {2, 3, 4, 5, 6}
    nulls = df.where(F.col("latitude").isNull() | F.col("longitude").isNull()).count()
    assert len(inside) + len(outside) + nulls == df.count()
    zones = {r["id"]: r["zone"] for r in fence_zone(df).collect()}
    assert {k for k, v in zones.items() if v == "inside"} == inside


def test_within_radius_one_table(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 3.0, 4.0, 5.0), (2, 0.0, 0.0, 3.0, 4.0, 4.9)],
                               "id int, location_x double, location_y double, longitude double, latitude double, radius double")
    got = [(r["id"], r["distance"]) for r in within_radius(df, radius="radius").collect()]
    assert got == [(1, 5.0)]


def test_nearest_within_equals_brute_force(spark):
    pts = spark.range(300).select(F.col("id"), ((F.col("id") * 37) % 101).cast("double").alias("x"),
                                  ((F.col("id") * 53) % 97).cast("double").alias("y"))
    sites = spark.range(40).select(F.col("id").alias("site_id"), ((F.col("id") * 29) % 103).cast("double").alias("site_x"),
                                   ((F.col("id") * 31) % 89).cast("double").alias("site_y"))
    got = {(r["point_id"], r["site_id"], r["distance"]) for r in nearest_within(pts, sites, 12.0).collect()}
    brute = set()
    for p in pts.collect():
        best = None
        for s in sites.collect():
            d = ((s["site_x"] - p["x"]) ** 2 + (s["site_y"] - p["y"]) ** 2) ** 0.5
            if d <= 12.0 and (best is None or (d, s["site_id"]) < best):
                best = (d, s["site_id"])
        if best:
            brute.add((p["id"], best[1], best[0]))
    assert got == brute
    top2 = nearest_within(pts, sites, 12.0, k=2)
    assert top2.groupBy("point_id").count().where("count > 2").count() == 0


def test_flag_existing_and_customers_full(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    gone = spark.createDataFrame([(3, "c")], "id int, name string")
    prof = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "user_id int, city string")
    out = {r["user_id"]: r["deleted_user"] for r in customers_full(users, prof, gone, prof).collect()}
    assert out == {1: False, 2: False, 3: True}
    flagged = flag_existing(spark.createDataFrame([(None,), (3,)], "user_id int"), gone, keys_key="id")
    assert sorted((r["user_id"] is None, r["deleted_user"]) for r in flagged.collect()) == [(False, True), (True, False)]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "user_id int, s double")
    b = spark.createDataFrame([(1, 5)], "user_id int, n int")
    u = customer_activity_union(a, b)
    assert set(u.columns) == {"user_id", "s", "n"} and u.count() == 2


def test_fleet_pipeline(spark):
    rows = [("41.38,2.17", "A", "2022-01-01T12:00:00Z", 10.0), ("41.38 N, 2.17 E", "A", "2022-06-01T12:00:00Z", 5.0),
            ("junk", "A", "2022-01-01T12:00:00Z", 100.0), ("41.38,2.17", "B", "2023-01-01T00:00:00Z", 1.0),
            (None, "B", "2023-01-01T00:00:00Z", 7.0)]
    df = spark.createDataFrame(rows, "gps_coordinates string, vehicle_id string, time_stamp string, distance_traveled double")
    got = {(r["vehicle_id"], r["year"]): r["distance_traveled"] for r in run_fleet_pipeline(df).collect()}
    assert got == {("A", 2022): 15.0 * 0.621371, ("B", 2023): 1.0 * 0.621371}


def test_clean_positions_normalises_then_fences(spark):
    rows = [(1, "41.38 N, 2.17 E"), (2, "41.38,2.25"), (3, "41°22'48.0\"N, 2°10'12.0\"E")]
    df = spark.createDataFrame(rows, "id int, gps_coordinates string")
    assert sorted(r["id"] for r in clean_positions(df).collect()) == [1, 3]


def _brute_nearest(pts, sites, r):
    import numpy as np

    P = np.array([(p["id"], p["x"], p["y"]) for p in pts.collect()])
    S = np.array([(s["site_id"], s["site_x"], s["site_y"]) for s in sites.collect()])
    out = set()
    for pid, x, y in P:
        d = np.sqrt((S[:, 1] - x) ** 2 + (S[:, 2] - y) ** 2)
        ok = d <= r
        if ok.any():
            cand = sorted(zip(d[ok], S[ok, 0]))
            out.add((int(pid), int(cand[0][1]), float(cand[0][0])))
    return out


def test_nearest_within_dense_cell_path_is_exact(spark):
    # a hot spot: 2000 points and 300 sites packed into one corner, plus sparse ones
    pts = spark.range(2600).select(
        F.col("id"),
        F.when(F.col("id") < 2000, (F.col("id") * 7919 % 1000) / 200.0).otherwise((F.col("id") * 37) % 997 * 1.0).alias("x"),
        F.when(F.col("id") < 2000, (F.col("id") * 104729 % 1000) / 200.0).otherwise((F.col("id") * 53) % 991 * 1.0).alias("y"),
    )
    sites = spark.range(400).select(
        F.col("id").alias("site_id"),
        F.when(F.col("id") < 300, (F.col("id") * 3571 % 997) / 199.4).otherwise((F.col("id") * 29) % 1009 * 1.0).alias("site_x"),
        F.when(F.col("id") < 300, (F.col("id") * 7247 % 991) / 198.2).otherwise((F.col("id") * 31) % 983 * 1.0).alias("site_y"),
    )
    # co-located duplicates with larger ids must never win
    sites = sites.unionByName(sites.where("site_id < 50").withColumn("site_id", F.col("site_id") + 10_000))
    fast = {(r["point_id"], r["site_id"], r["distance"]) for r in nearest_within(pts, sites, 25.0, max_candidates=None).collect()}
    hot = nearest_within(pts, sites, 25.0, max_candidates=50, target_sites_per_cell=4)
    got = {(r["point_id"], r["site_id"], r["distance"]) for r in hot.collect()}
    want = _brute_nearest(pts, sites, 25.0)
    assert fast == want
    assert got == want


def _brute_topk(pts, sites, r, k, radius_col=None):
    import numpy as np

    P = [(p["id"], p["x"], p["y"]) for p in pts.collect()]
    S = [(s["site_id"], s["site_x"], s["site_y"], s[radius_col] if radius_col else r) for s in sites.collect()]
    out = set()
    for pid, x, y in P:
        cand = sorted((float(np.sqrt((sx - x) ** 2 + (sy - y) ** 2)), sid) for sid, sx, sy, sr in S
                      if np.sqrt((sx - x) ** 2 + (sy - y) ** 2) <= min(sr, r))
        for rank, (d, sid) in enumerate(cand[:k], start=1):
            out.add((int(pid), int(sid), d, rank))
    return out


def test_nearest_within_top_k_and_site_radius_dense_path(spark):
    pts = spark.range(1500).select(
        F.col("id"),
        F.when(F.col("id") < 1000, (F.col("id") * 7919 % 1000) / 200.0).otherwise((F.col("id") * 37) % 997 * 1.0).alias("x"),
        F.when(F.col("id") < 1000, (F.col("id") * 104729 % 1000) / 200.0).otherwise((F.col("id") * 53) % 991 * 1.0).alias("y"),
    )
    sites = spark.range(300).select(
        F.col("id").alias("site_id"),
        F.when(F.col("id") < 200, (F.col("id") * 3571 % 997) / 199.4).otherwise((F.col("id") * 29) % 1009 * 1.0).alias("site_x"),
        F.when(F.col("id") < 200, (F.col("id") * 7247 % 991) / 198.2).otherwise((F.col("id") * 31) % 983 * 1.0).alias("site_y"),
        (F.lit(10.0) + F.col("id") % 15).alias("reach"),
    )
    sites = sites.unionByName(sites.where("site_id < 30").withColumn("site_id", F.col("site_id") + 10_000))
    for kw in (dict(k=3), dict(k=1, site_radius="reach"), dict(k=2, site_radius="reach")):
        want = _brute_topk(pts, sites, 25.0, kw["k"], kw.get("site_radius"))
        for mc in (None, 40):
            got_df = nearest_within(pts, sites, 25.0, max_candidates=mc, target_sites_per_cell=4, **kw)
            if kw["k"] == 1:
                got = {(r["point_id"], r["site_id"], r["distance"], 1) for r in got_df.collect()}
            else:
                got = {(r["point_id"], r["site_id"], r["distance"], r["rank"]) for r in got_df.collect()}
            assert got == want, (kw, mc)


def test_points_pick_their_sites_inside_the_row(spark):
    """Pairs of points and sites are no rows: a point has one row per list of its cell, with k sites at most."""
    from roadloom.operators import geo

    pts = spark.range(10).select(F.col("id").alias("point_id"), (F.col("id") * 1.0).alias("__px"), F.lit(5.0).alias("__py"))
    sites = spark.range(geo.LISTED + 100).select(
        F.col("id").alias("site_id"), (F.col("id") % 10 * 1.0).alias("site_x"), (F.col("id") % 7 * 1.0).alias("site_y"), F.lit(20.0).alias("__sr"))
    rows = geo._nearest_listed(pts, sites, 20.0, 3).collect()
    assert len(rows) == 2 * 10 and all(len(r["__near"]) == 3 for r in rows)


def test_nearest_within_ranks_all_rows_of_an_id(spark):
    """An id on several rows, in dense cells and elsewhere, has its nearest sites over all of them; a repeated row counts twice."""
    pts = spark.createDataFrame([(1, 0.5, 0.5), (1, 500.0, 500.0), (2, 0.5, 0.5), (2, 0.5, 0.5), (None, 0.5, 0.5), (3, None, 1.0)], "id int, x double, y double")
    sites = spark.range(60).select(F.col("id").alias("site_id"), (F.col("id") / 10.0).alias("site_x"), F.lit(0.0).alias("site_y"))
    sites = sites.unionByName(spark.createDataFrame([(900, 500.0, 500.25)], "site_id long, site_x double, site_y double"))
    for mc in (None, 40):
        kw = dict(max_candidates=mc, target_sites_per_cell=1)
        one = {r["point_id"]: r["site_id"] for r in nearest_within(pts, sites, 25.0, **kw).collect()}
        assert nearest_within(pts, sites, 25.0, **kw).count() == 3 and one == {1: 900, 2: 5, None: 5}
        three = sorted((r["point_id"] or 0, r["rank"], r["site_id"]) for r in nearest_within(pts, sites, 25.0, k=3, **kw).collect())
        assert three == [(0, 1, 5), (0, 2, 4), (0, 3, 6), (1, 1, 900), (1, 2, 5), (1, 3, 4), (2, 1, 5), (2, 2, 5), (2, 3, 4)]
