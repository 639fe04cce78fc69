"""Delta loads: watermark, key-set changes, upsert (idempotent), refresh."""

import datetime as dt

from roadloom.operators.incremental import (
    apply_delta,
    high_watermark,
    key_count_changed,
    key_set_changes,
    key_sets_equal,
    rows_after,
    upsert,
    watermark_changed,
)

SCHEMA = "id int, status string, ts timestamp_ntz"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


T0 = dt.datetime(2024, 1, 1)


def test_watermark_and_rows_after(spark):
    df = _df(spark, [(1, "a", T0), (2, "b", T0 + dt.timedelta(hours=5)), (3, "c", T0 + dt.timedelta(hours=2))])
    wm = high_watermark(df, "ts")
    assert wm == T0 + dt.timedelta(hours=5)
    assert rows_after(df, "ts", T0 + dt.timedelta(hours=1)).count() == 2
    assert rows_after(df, "ts", None).count() == 3


def test_key_set_changes(spark):
    old = _df(spark, [(1, "a", T0), (2, "b", T0)])
    new = _df(spark, [(2, "b", T0), (3, "c", T0)])
    got = {(r["id"], r["change"]) for r in key_set_changes(old, new, ["id"]).collect()}
    assert got == {(3, "added"), (1, "removed")}
    assert not key_sets_equal(old, new, ["id"])
    assert key_sets_equal(old, old, ["id"])
    assert not key_count_changed(old, new, "id")
    assert watermark_changed(old, _df(spark, [(1, "a", T0 + dt.timedelta(days=1))]), "ts")


def test_upsert_newest_wins_and_is_idempotent(spark):
    existing = _df(spark, [(1, "old", T0), (2, "old", T0)])
    delta = _df(spark, [(2, "v1", T0 + dt.timedelta(hours=1)), (2, "v2", T0 + dt.timedelta(hours=2)),
                        (3, "new", T0 + dt.timedelta(hours=1))])
    once = upsert(existing, delta, ["id"], ts_col="ts")
    twice = upsert(once, delta, ["id"], ts_col="ts")
    expect = {(1, "old"), (2, "v2"), (3, "new")}
    assert {(r["id"], r["status"]) for r in once.collect()} == expect
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_refresh_replaces(spark):
    existing = _df(spark, [(1, "old", T0)])
    source = _df(spark, [(2, "x", T0)])
    assert [r["id"] for r in apply_delta(existing, source, ["id"], "ts", mode="refresh").collect()] == [2]
