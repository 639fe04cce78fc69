"""Writers round-trip through files in a scratch folder."""

import tempfile
import os

from pyspark.sql import functions as F

from roadloom.sinks import (
    append_table,
    read_current,
    write_envelope,
    write_json_lines,
    write_snapshot,
    write_versioned,
    write_yearly,
)
from roadloom.sinks.writers import audit_load
from roadloom.sources import read_json_lines, read_table
from tests.conftest import SF_SMALL


def test_snapshot_gzip_round_trip(spark, tmp_dir):
    orders = read_table(spark, "orders", SF_SMALL)
    out = os.path.join(tmp_dir, "orders")
    write_snapshot(orders, out)
    assert any(f.endswith(".gz.parquet") for f in os.listdir(out))
    assert spark.read.parquet(out).count() == orders.count()


def test_yearly_partitions_and_dynamic_overwrite(spark, tmp_dir):
    orders = read_table(spark, "orders", SF_SMALL)
    out = os.path.join(tmp_dir, "yearly")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # the writer must not rely on it
    try:
        write_yearly(orders, out, "o_orderdate")
        years = sorted(d for d in os.listdir(out) if d.startswith("year="))
        assert len(years) > 1
        # re-writing one year leaves the other years in place
        one = orders.where(F.year("o_orderdate") == 1997)
        write_yearly(one, out, "o_orderdate")
        assert spark.read.parquet(out).count() == orders.count()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_json_lines_round_trip(spark, tmp_dir):
    df = read_table(spark, "nation", SF_SMALL)
    out = os.path.join(tmp_dir, "jl")
    write_json_lines(df, out)
    back = read_json_lines(spark, out, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_versioned_pointer(spark, tmp_dir):
    base = os.path.join(tmp_dir, "snap")
    write_versioned(spark.range(3), base)
    write_versioned(spark.range(5), base)
    assert read_current(spark, base).count() == 5


def test_append_with_rejects_and_audit(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    b = spark.createDataFrame([(3, "z")], "id int, name string")
    target, rejects = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "rej")
    stats = append_table([a, b], target, required=["name"], rejects=rejects)
    assert stats == {"rows_written": 2, "rows_rejected": 1}
    assert audit_load(spark, target, 2)
    assert spark.read.parquet(rejects).first()["reject_reason"] == "missing:name"


def test_envelope_is_two_tables(spark, tmp_dir):
    out = os.path.join(tmp_dir, "env")
    write_envelope(spark.range(4), out, "2024-01-01 00:00:00")
    assert spark.read.json(os.path.join(out, "data")).count() == 4
    assert spark.read.json(os.path.join(out, "metadata")).first()["total_count"] == 4


def test_bucketed_tables_join_without_shuffle(spark):
    from roadloom.plans.checks import executed_plan
    from roadloom.sinks import write_bucketed_table

    orders = read_table(spark, "orders", SF_SMALL)
    items = read_table(spark, "lineitem", SF_SMALL)
    write_bucketed_table(orders, "orders_b", ["o_orderkey"], 8)
    write_bucketed_table(items.withColumnRenamed("l_orderkey", "o_orderkey"), "lineitem_b", ["o_orderkey"], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("lineitem_b").join(spark.table("orders_b"), "o_orderkey")
        plan = executed_plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == items.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_append_to_catalog_table_and_audit(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, "y"), (3, None)], "id int, name string")
    stats = append_table([a, b], "loads_t", required=["id"], rejects=tempfile.mkdtemp() + "/rejects", as_table=True)
    stats2 = append_table([a], "loads_t", as_table=True)
    assert stats == {"rows_written": 3, "rows_rejected": 0} and stats2["rows_written"] == 1
    assert audit_load(spark, "loads_t", 4, as_table=True)
