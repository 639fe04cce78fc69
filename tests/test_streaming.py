"""Streams run with availableNow over Parquet files in a scratch folder."""

import os

from pyspark.sql import functions as F

from roadloom.operators.events import dedupe_latest
from roadloom.operators.trips import trip_first_last
from roadloom.streaming import (
    daily_occupancy,
    dedupe_within_watermark,
    run_available_now,
    stream_files,
    trip_sessions,
)
from tests.conftest import SF_SMALL


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_new_files_processed_once(spark, tmp_dir):
    ev = _events(spark)
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "ck"))
    first = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    rest = ev.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    first.write.parquet(os.path.join(src, "batch=1"))
    stream = stream_files(spark, os.path.join(src, "*"), ev.schema)
    run_available_now(stream, checkpoint=ck, sink=out)
    assert spark.read.parquet(out).count() == first.count()
    rest.write.parquet(os.path.join(src, "batch=2"))
    run_available_now(stream_files(spark, os.path.join(src, "*"), ev.schema), checkpoint=ck, sink=out)
    assert spark.read.parquet(out).count() == ev.count()


def test_daily_occupancy_matches_batch_for_closed_windows(spark, tmp_dir):
    ev = _events(spark)
    src = os.path.join(tmp_dir, "src")
    ev.write.parquet(src)
    stream = daily_occupancy(stream_files(spark, src, ev.schema), ts="ts", area="event_type", status="event_type",
                             occupied="purchase", available="view", reserved="click")
    run_available_now(stream, checkpoint=os.path.join(tmp_dir, "ck"), fmt="memory", query_name="occ_stream")
    got = spark.table("occ_stream")
    batch = daily_occupancy(ev, ts="ts", area="event_type", status="event_type",
                            occupied="purchase", available="view", reserved="click")
    # streaming emits only windows the watermark has closed: a subset of the batch result
    closed = batch.join(got.select("window_start", "event_type"), ["window_start", "event_type"], "left_semi")
    assert got.count() > 0
    assert sorted(map(tuple, got.select(*batch.columns).collect())) == sorted(
        map(tuple, closed.select(*batch.columns).collect()))


def test_trip_sessions_first_last(spark, tmp_dir):
    ev = _events(spark)
    src = os.path.join(tmp_dir, "src")
    ev.write.parquet(src)
    kw = dict(trip="user_id", ts="ts", tiebreak="event_id", columns=["value"], gap="6 hours", watermark="1 hour")
    stream = trip_sessions(stream_files(spark, src, ev.schema), **kw)
    run_available_now(stream, checkpoint=os.path.join(tmp_dir, "ck"), fmt="memory", query_name="sess_stream")
    got = spark.table("sess_stream")
    batch = trip_sessions(ev, **kw)
    # sessions closed by the final watermark come out, exactly as in batch
    closed = batch.join(got.select("user_id", "session_start"), ["user_id", "session_start"], "left_semi")
    assert got.count() > 0
    assert sorted(map(tuple, got.select(*batch.columns).collect())) == sorted(
        map(tuple, closed.select(*batch.columns).collect()))
    # every user's first event starts its first session
    firsts = trip_first_last(ev, trip="user_id", ts="ts", tiebreak="event_id", columns=["value"])
    first_sessions = batch.groupBy("user_id").agg(F.min("start_event_id").alias("e"))
    assert first_sessions.join(firsts, (first_sessions.user_id == firsts.user_id) & (
        first_sessions.e == firsts.start_event_id)).count() == firsts.count()


def test_dedupe_within_watermark(spark, tmp_dir):
    ev = _events(spark)
    src = os.path.join(tmp_dir, "src")
    ev.unionByName(ev).write.parquet(src)
    stream = dedupe_within_watermark(stream_files(spark, src, ev.schema), ["event_id"], ts="ts", watermark="1 hour")
    run_available_now(stream, checkpoint=os.path.join(tmp_dir, "ck"), fmt="memory", query_name="dedupe_stream")
    assert spark.table("dedupe_stream").count() == ev.count()
    assert dedupe_latest(ev.unionByName(ev), ["event_id"], ts="ts").count() == ev.count()


def test_stream_upsert_into_snapshot(spark, tmp_dir):
    from roadloom.sinks import read_current
    from roadloom.streaming import stream_upsert

    ev = _events(spark)
    src, base, ck = (os.path.join(tmp_dir, d) for d in ("src", "snap", "ck"))
    first = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    first.write.parquet(os.path.join(src, "batch=1"))
    stream_upsert(stream_files(spark, os.path.join(src, "*"), ev.schema), base, ["event_id"], "ts", checkpoint=ck)
    assert read_current(spark, base).count() == first.count()
    # the second file re-sends some rows (changed values) and adds the rest
    resend = ev.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).withColumn("value", F.lit(-1.0))
    resend.write.parquet(os.path.join(src, "batch=2"))
    stream_upsert(stream_files(spark, os.path.join(src, "*"), ev.schema), base, ["event_id"], "ts", checkpoint=ck)
    snap = read_current(spark, base)
    assert snap.count() == ev.count()
    assert snap.where(F.col("value") == -1.0).count() == resend.count()


def test_stream_trips_equals_the_batch_summary_after_every_file(spark, tmp_dir):
    """Files in an order that is not that of their times; one arrives twice."""
    from roadloom.operators.trips import trip_summary
    from roadloom.sinks import read_current
    from roadloom.streaming import stream_trips

    ev = _events(spark).select("user_id", "ts", "event_id", "value")
    facts = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select(F.col("c_custkey").alias("id"), "c_name")
    options = {"trip": "user_id", "ts": "ts", "tiebreak": "event_id", "columns": ["value"]}
    src, base, ck = (os.path.join(tmp_dir, d) for d in ("src", "snap", "ck"))
    parts = [ev.where(F.col("event_id") % 4 == k) for k in range(4)]
    arrived = None
    for n, k in enumerate([2, 0, 3, 0, 1]):
        parts[k].coalesce(1).write.parquet(os.path.join(src, f"batch={n}"))
        arrived = parts[k] if arrived is None else arrived.unionByName(parts[k])
        stream_trips(stream_files(spark, os.path.join(src, "*"), ev.schema), facts, base, checkpoint=ck, **options)
        want = trip_summary(arrived.distinct(), facts, trip="user_id", ts="ts", tiebreak="event_id", columns=["value"])
        assert sorted(map(tuple, read_current(spark, base).collect())) == sorted(map(tuple, want.collect()))
