"""Delta loads against a computation over the full history, reruns, moves between partitions, publishing."""

import os

import pytest
from pyspark.sql import functions as F

from roadloom.operators import geo, gps, incremental, trips
from roadloom.operators.sequence import ordered_sequence
from roadloom.plans import loads
from roadloom.plans.pipelines import delta_load, trips_delta, upsert_partitions
from roadloom.sinks import append_table, has_current, manifest, read_current, write_versioned


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


POINTS = "vehicle_trip_id string, created_on timestamp_ntz, v int"


def points(spark, *items):
    df = spark.createDataFrame(list(items), "vehicle_trip_id string, t string, v int")
    return df.select("vehicle_trip_id", F.col("t").cast("timestamp_ntz").alias("created_on"), "v")


def test_trips_delta_keeps_starts_and_moves_ends(spark, tmp_dir):
    base = os.path.join(tmp_dir, "trips")
    facts = spark.createDataFrame([("A", "x"), ("B", "y"), ("C", "z")], "id string, f string")
    p = points(spark, ("A", "2024-01-01 08:00:00", 1), ("A", "2024-01-01 09:00:00", 2), ("B", "2024-01-01 08:30:00", 3), ("B", "2024-01-01 08:50:00", 4))
    assert trips_delta(spark, base, p, facts)["initial"]
    first = rows(read_current(spark, base))
    for _ in range(2):
        assert not trips_delta(spark, base, p, facts)["changed"]
        assert rows(read_current(spark, base)) == first
    more = p.unionByName(points(spark, ("B", "2024-01-01 10:00:00", 5), ("C", "2024-01-01 11:00:00", 6)))
    assert trips_delta(spark, base, more, facts)["changed"]
    assert rows(read_current(spark, base)) == rows(trips.trip_summary(more, facts))
    assert not trips_delta(spark, base, more, facts)["changed"]


def reader(tables):
    return lambda name: tables[name]


def test_window_loads_keep_history_and_totals(spark, tmp_dir):
    def cars(*items):
        df = spark.createDataFrame(list(items), "motorcycle_id int, p string, w string, c string")
        return df.select("motorcycle_id", F.col("p").cast("date").alias("purchase_date"), F.col("w").cast("date").alias("warranty_expiration_date"),
                         F.col("c").cast("timestamp_ntz").alias("created_on"))

    one = cars((1, "2020-01-01", "2030-01-01", "2024-05-01"), (2, "2020-01-01", "2030-01-01", "2024-05-01"), (3, "2020-01-01", "2030-01-01", "2024-05-01"))
    two = one.unionByName(cars((4, "2021-01-01", "2031-01-01", "2024-05-03")))
    loads.vehicles_delta_load(spark, reader({"motorcycles": one}), tmp_dir, as_of="2024-05-01")
    for expected in (True, False):
        got = loads.vehicles_delta_load(spark, reader({"motorcycles": two}), tmp_dir, as_of="2024-05-03")
        assert got["changed"] is expected
    out = read_current(spark, os.path.join(tmp_dir, "vehicles")).collect()
    assert sorted(r.motorcycle_id for r in out) == [1, 2, 3, 4] and {r.total_by_warranty_status for r in out} == {4}

    def spots(*items):
        return spark.createDataFrame(list(items), "area_id string, status string, t string").select(
            "area_id", "status", F.col("t").cast("timestamp_ntz").alias("created_on"))

    day = spots(("a1", "occupied", "2024-05-01 06:00:00"), ("a2", "available", "2024-05-01 07:00:00"))
    loads.parking_delta_load(spark, reader({"parking_area": day}), tmp_dir, as_of="2024-05-02")
    later = day.unionByName(spots(("a2", "occupied", "2024-05-05 07:00:00")))
    for expected in (True, False):
        got = loads.parking_delta_load(spark, reader({"parking_area": later}), tmp_dir, as_of="2024-05-06")
        assert got["changed"] is expected
    out = {r.area_id: r.occupied_spaces for r in read_current(spark, os.path.join(tmp_dir, "parking_occupancy")).collect()}
    assert out == {"a1": 1, "a2": 1}


def test_upsert_partitions_moves_rows_and_keeps_null_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")

    def frame(*items):
        return spark.createDataFrame(list(items), "id int, t string, v string").select("id", F.col("t").cast("timestamp_ntz").alias("ts"), "v")

    upsert_partitions(spark, path, frame((1, "2022-01-01", "a"), (2, "2021-01-01", "b"), (4, None, "n")), ["id"], "ts")
    upsert_partitions(spark, path, frame((1, "2023-01-01", "c")), ["id"], "ts")  # 2022 becomes empty
    got = read_current(spark, path)
    assert sorted((r.id, r.v, r.year) for r in got.collect() if r.year) == [(1, "c", 2023), (2, "b", 2021)]
    result = upsert_partitions(spark, path, frame((3, None, "m"), (2, "2020-05-05", "old"), (5, "2024-01-01", "e")), ["id"], "ts")
    got = read_current(spark, path)
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "c"), (2, "b"), (3, "m"), (4, "n"), (5, "e")]
    assert None in result["partitions"]


def test_newest_row_wins_and_null_keys_count_once(spark):
    old = spark.createDataFrame([(1, 5, "new"), (2, 1, "x"), (None, 1, "n")], "id int, ts int, v string")
    delta = spark.createDataFrame([(1, 3, "late"), (2, 1, "again"), (None, 2, "m"), (3, 1, "a")], "id int, ts int, v string")
    once = incremental.upsert(old, delta, ["id"], ts_col="ts")
    assert rows(once) == rows(incremental.upsert(once, delta, ["id"], ts_col="ts"))
    assert {(r.id, r.v) for r in once.collect()} == {(1, "new"), (2, "again"), (None, "m"), (3, "a")}


def test_first_batch_has_one_row_per_key(spark, tmp_dir):
    base = os.path.join(tmp_dir, "f")
    delta_load(spark, base, spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "id int, ts int, v string"), ["id"], "ts")
    assert rows(read_current(spark, base)) == [(1, 2, "b")]


def test_an_unfinished_pointer_does_not_count(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    assert not has_current(spark, base)
    write_versioned(spark.range(3), base)
    os.makedirs(os.path.join(base, "_pointers", "000000002-dead"))
    assert read_current(spark, base).count() == 3
    write_versioned(spark.range(5), base)
    assert read_current(spark, base).count() == 5



def test_required_columns_need_a_rejects_path(spark, tmp_dir):
    with pytest.raises(ValueError):
        append_table([spark.range(2)], os.path.join(tmp_dir, "t"), required=["id"])


def measures(spark, *wkt):
    df = spark.createDataFrame([(w,) for w in wkt], "geometry string")
    out = geo.geometry_features(df.withColumn("id", F.monotonically_increasing_id()), id_col="id", wkt="geometry", properties=[])
    return [r.asDict() for r in out.orderBy("id").collect()]


def test_small_shapes_on_longitude_and_latitude(spark):
    d = 1e-5
    ring = lambda x, y, e: f"({x} {y}, {x + e} {y}, {x + e} {y + e}, {x} {y + e}, {x} {y})"
    square, hole, srid, multi = measures(
        spark, f"POLYGON({ring(2.17, 41.38, d)})", f"POLYGON({ring(2.17, 41.38, d)}, {ring(2.17 + d / 4, 41.38 + d / 4, d / 2)})",
        "SRID=4326;POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))", "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)))")
    for got in (square, hole):
        assert abs(got["centroid_x"] - (2.17 + d / 2)) < 1e-9 and abs(got["centroid_y"] - (41.38 + d / 2)) < 1e-9
    assert abs(square["area"] / d**2 - 1) < 1e-6 and abs(hole["area"] / d**2 - 0.75) < 1e-6
    assert (srid["area"], srid["centroid_x"], srid["centroid_y"]) == (4.0, 1.0, 1.0)
    assert multi["area"] is None and multi["centroid_x"] is None


def test_positions_below_zero_and_minutes_from_60(spark):
    df = spark.createDataFrame([("-12°30'00\"N, 10°15'00\"E",), ("2°99'99\"N, 10°15'00\"E",)], "gps_coordinates string")
    one, two = gps.normalize_gps(df).collect()
    assert one.latitude == -12.5 and one.longitude == 10.25
    assert two.gps_reason == gps.REASON_FORMAT


def test_grid_join_at_a_cell_edge_and_site_radius_check(spark):
    p = spark.createDataFrame([(1, 0.9999999999999999, 0.0)], "id int, x double, y double")
    s = spark.createDataFrame([(1, 2.0, 0.0, 10.0)], "site_id int, site_x double, site_y double, r double")
    assert geo.nearest_within(p, s, 1.0).count() == 1
    with pytest.raises(Exception, match="radius"):
        geo.nearest_within(p, s, 1.0, site_radius="r").collect()


def test_rank_one_per_id(spark):
    df = spark.createDataFrame([(1, 2.0, "b"), (1, 1.0, "c"), (2, 5.0, "d")], "id int, distance double, name string")
    assert rows(geo.nearest_per_id(df)) == [(1, 1.0, "c"), (2, 5.0, "d")]


def test_sequence_with_text_order_in_a_hot_key(spark):
    df = spark.createDataFrame([("k", f"{i:05d}") for i in range(300)], "k string, o string")
    got = ordered_sequence(df, ["k"], ["o"], max_group_rows=50, split=4)
    assert {(r.o, r.row_number) for r in got.collect()} == {(f"{i:05d}", i + 1) for i in range(300)}


def test_late_points_and_facts_reach_the_summary(spark, tmp_dir):
    """A late point before the stored start, a trip older than the newest point, late and changed facts, a rerun."""
    base = os.path.join(tmp_dir, "late")
    p1 = points(spark, ("A", "2024-01-01 08:00:00", 1), ("A", "2024-01-01 09:00:00", 2), ("B", "2024-01-01 08:30:00", 3))
    f1 = spark.createDataFrame([("A", "old")], "id string, f string")
    assert trips_delta(spark, base, p1, f1)["initial"]
    assert [r.vehicle_trip_id for r in read_current(spark, base).collect()] == ["A"]
    p2 = points(spark, ("A", "2024-01-01 07:00:00", 9), ("C", "2024-01-01 08:45:00", 5))
    f2 = spark.createDataFrame([("A", "new"), ("B", "late"), ("C", "c"), ("D", "no points yet")], "id string, f string")
    assert trips_delta(spark, base, p2, f2)["changed"]
    everything = rows(trips.trip_summary(p1.unionByName(p2), f2))
    assert rows(read_current(spark, base)) == everything and len(everything) == 3
    for again in ((p2, f2), (p1, f2)):
        assert not trips_delta(spark, base, *again)["changed"]
    p3 = points(spark, ("D", "2024-01-01 06:00:00", 7))
    assert trips_delta(spark, base, p3, f2.limit(0))["changed"]
    assert rows(read_current(spark, base)) == rows(trips.trip_summary(p1.unionByName(p2).unionByName(p3), f2))


def test_states_merge_in_any_order(spark):
    p = points(spark, *[(f"T{i % 3}", f"2024-01-01 0{i}:00:00", i) for i in range(9)])
    facts = spark.createDataFrame([("T0", 1, "a"), ("T0", 3, "b"), ("T0", 2, "c"), ("T1", 1, "d")], "id string, v long, f string")
    batches = [trips.trip_state(p.where(f"v % 4 = {k}"), facts.where(f"v = {k}"), version="v") for k in range(4)]
    want = rows(trips.trip_state(p, facts, version="v"))
    for order in ((0, 1, 2, 3), (3, 1, 0, 2), (2, 2, 0, 3, 1, 0)):
        assert rows(trips.merge_states(*[batches[i] for i in order])) == want
    assert [r.vehicle_trip_id for r in trips.trips_pending(trips.trip_state(p, facts, version="v")).collect()] == ["T2"]


def test_marks_tell_what_arrived_and_pending_facts_come_whatever_their_time(spark, tmp_dir):
    base = os.path.join(tmp_dir, "marks")

    def facts(*items):
        df = spark.createDataFrame(list(items), "id string, t string, f string")
        return df.select("id", F.col("t").cast("timestamp_ntz").alias("start_time"), "f")

    options = {"points_since": "created_on", "facts_since": "start_time"}
    p1 = points(spark, ("A", "2024-01-01 08:00:00", 1), ("B", "2024-01-05 08:00:00", 2))
    f1 = facts(("B", "2024-01-05 08:00:00", "b"))
    trips_delta(spark, base, p1, f1, **options)
    # A's facts are stored four days late: older than the mark, read because A waits for them
    f2 = f1.unionByName(facts(("A", "2024-01-01 08:00:00", "a"), ("Z", "2023-01-01 08:00:00", "before the mark")))
    p2 = p1.unionByName(points(spark, ("B", "2024-01-06 08:00:00", 3)))
    assert trips_delta(spark, base, p2, f2, **options)["changed"]
    assert rows(read_current(spark, base)) == rows(trips.trip_summary(p2, f2))
    assert not trips_delta(spark, base, p2, f2, **options)["changed"]


def test_one_trip_leaves_other_folders(spark, tmp_dir):
    base = os.path.join(tmp_dir, "folders")
    p = points(spark, *[(f"T{i}", "2024-01-01 08:00:00", i) for i in range(60)])
    f = spark.createDataFrame([(f"T{i}", "x") for i in range(60)], "id string, f string")
    trips_delta(spark, base, p, f)
    before = manifest.current(spark, base).parts
    done = trips_delta(spark, base, points(spark, ("T7", "2024-01-01 10:00:00", 0)), f.where("id = 'T7'"))
    after = manifest.current(spark, base).parts
    assert len(done["written"]) == 1 and [q for q in after if after[q] != before[q]] == done["written"]
