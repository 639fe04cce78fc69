"""Plan properties: no Python rows, no nested loops, pushdown and pruning."""

import re

import pytest

import __spark_entry__ as entry
from roadloom.plans.checks import NESTED_LOOP_NODES, PYTHON_NODES, executed_plan, has_any, scan_details
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_and_no_nested_loop(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert has_any(df, PYTHON_NODES) == []
    assert has_any(df, NESTED_LOOP_NODES) == []


def test_nearest_site_is_an_equi_join(spark):
    plan = executed_plan(entry.queries()["nearest_site"](spark, SF_SMALL))
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_parking_window_reaches_the_scan(spark):
    details = scan_details(entry.queries()["parking_occupancy"](spark, SF_SMALL))
    pushed = [d for d in details if d.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThanOrEqual(l_shipdate" in pushed
    schema = [d for d in details if d.startswith("ReadSchema")][0]
    assert schema == "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>"


def test_dimension_filter_pushed_and_columns_pruned(spark):
    details = scan_details(entry.queries()["booking_stats"](spark, SF_SMALL))
    assert any("EqualTo(c_mktsegment,AUTOMOBILE)" in d for d in details)
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in details


def test_watermark_is_a_pushed_literal(spark):
    details = scan_details(entry.queries()["delta_new_rows"](spark, SF_SMALL))
    assert any(d.startswith("PushedFilters") and "GreaterThan(o_orderdate" in d for d in details)


def test_first_last_are_aggregates_not_windows(spark):
    for name in ("event_first", "trip_first_last", "dedupe_latest", "vehicle_routes"):
        plan = executed_plan(entry.queries()[name](spark, SF_SMALL))
        assert "Window" not in plan, name
        assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan, name


def test_warranty_counts_broadcast_not_window(spark):
    plan = executed_plan(entry.queries()["warranty_status"](spark, SF_SMALL))
    assert "Window" not in plan


@pytest.mark.parametrize(("name", "tables"), [("warranty_status", 2), ("geometry_groups", 1), ("warranty_delta_upsert", 2)])
def test_every_table_is_scanned_once(spark, name, tables):
    """The kept rows are one plan, and the tables are read in it alone."""
    df = entry.queries()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "InMemoryTableScan" in plan
    inside = set(re.findall(r"FileScan parquet [^\n]*?file:(\S+?)\.parquet", plan))
    assert len(inside) == tables
    relation = plan.split("InMemoryRelation")[0]
    assert "FileScan" not in relation


def test_positions_are_parsed_once_per_row(spark):
    df = entry.queries()["fleet_pipeline_rejects"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    node = [line for line in plan.split("\n") if "Filter" in line]
    assert all("RLIKE" not in line and "regexp" not in line for line in node if "gps_reason" in line)


@pytest.mark.parametrize("name", ["event_sequence", "event_gaps_days", "route_points", "trips_late_merge", "geometry_groups", "warranty_status"])
def test_building_a_frame_starts_no_job(spark, name):
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, "none expected")
    try:
        entry.queries()[name](spark, SF_SMALL)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a Parquet schema is a job of one task
    assert all(spark.sparkContext.statusTracker().getJobInfo(j) is None or
               len(spark.sparkContext.statusTracker().getJobInfo(j).stageIds) == 1 for j in jobs)


def test_a_small_delta_leaves_the_stored_side_unshuffled(spark, tmp_dir):
    import os

    from roadloom.operators import incremental

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.write.parquet(os.path.join(tmp_dir, "stored"))
    stored = spark.read.parquet(os.path.join(tmp_dir, "stored"))
    delta = orders.where("o_orderkey % 50 = 0")
    assert incremental.is_small(delta, ["o_orderkey"]) and not incremental.is_small(orders, ["o_orderkey"], 5)
    df = incremental.upsert(stored, delta, ["o_orderkey"], ts_col="o_orderdate", small=True)
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    reads = [i for i, line in enumerate(lines) if "FileScan" in line and "stored" in line]
    assert reads
    for i in reads:
        above = []
        for j in range(i, -1, -1):
            if not above or depth[j] < depth[above[-1]]:
                above.append(j)
        path = [lines[j] for j in above]
        first_join = next(n for n, line in enumerate(path) if "Join" in line)
        assert "BroadcastHashJoin" in path[first_join]
        assert not any("Exchange" in line or "ShuffleQueryStage" in line for line in path[:first_join])
