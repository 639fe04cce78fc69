"""Streams.

The reference polls a database, compares the newest timestamp with the one
stored in the last snapshot, and re-writes.  A file stream with a checkpoint
does that bookkeeping: each run (``trigger(availableNow=True)``) processes the
files that arrived since the previous run, exactly once, and survives lost
executors and restarts.  Event-time operators bound their state with a
watermark; rows later than the watermark are dropped and counted in the
query progress (``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.functions.columns import utc_ntz_to_instant


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """New files under ``path`` as a stream."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    # watermarks need TIMESTAMP; the tables hold TIMESTAMP_NTZ (UTC wall time),
    # converted through epoch microseconds so the session zone plays no part
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, utc_ntz_to_instant(ts))
    return df


def daily_occupancy(
    events: DataFrame,
    *,
    ts: str = "created_on",
    area: str = "area_id",
    status: str = "status",
    occupied: str = "occupied",
    available: str = "available",
    reserved: str = "reserved",
    watermark: str = "1 hour",
    window: str = "1 day",
) -> DataFrame:
    """Tumbling-window occupancy per area (X2); a window is emitted once the
    watermark passes its end (append mode)."""
    s = F.col(status)
    return (
        _event_time(events, ts)
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, window).alias("window"), F.col(area))
        .agg(
            F.count_if(s == F.lit(occupied)).alias("occupied_spaces"),
            F.count_if(s == F.lit(available)).alias("available_spaces"),
            F.count_if(s == F.lit(reserved)).alias("reserved_spaces"),
            F.count(F.lit(1)).alias("total_spaces"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*")
        .drop("window")
    )


def trip_sessions(
    points: DataFrame,
    *,
    trip: str = "vehicle_trip_id",
    ts: str = "created_on",
    tiebreak: str | None = None,
    columns: list[str] | None = None,
    gap: str = "30 minutes",
    watermark: str = "1 hour",
) -> DataFrame:
    """First and last point per trip session (X3): a session closes after
    ``gap`` without points; state is bounded by the watermark."""
    columns = columns or []
    order = [ts] + ([tiebreak] if tiebreak else [])
    s = F.struct(*[F.col(c) for c in order + columns])
    agg = (
        _event_time(points, ts)
        .withWatermark(ts, watermark)
        .groupBy(F.col(trip), F.session_window(ts, gap).alias("session"))
        .agg(F.min(s).alias("__s"), F.max(s).alias("__e"), F.count(F.lit(1)).alias("points"))
    )
    return agg.select(
        trip,
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        "points",
        *[F.col("__s").getField(c).alias(f"start_{c}") for c in order + columns],
        *[F.col("__e").getField(c).alias(f"end_{c}") for c in order + columns],
    )


def dedupe_within_watermark(df: DataFrame, keys: list[str], *, ts: str, watermark: str = "1 hour") -> DataFrame:
    """Drop repeated keys seen within the watermark delay."""
    return _event_time(df, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def run_available_now(df: DataFrame, *, checkpoint: str, sink: str | None = None, fmt: str = "parquet",
                      query_name: str | None = None, output_mode: str = "append", foreach_batch=None):
    """Process everything available now, then stop; returns the finished query.

    With ``query_name`` and ``fmt="memory"`` the result is the table of that
    name (tests); otherwise rows go to ``sink`` or ``foreach_batch``.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif fmt == "memory":
        w = w.format("memory").queryName(query_name or "roadloom_stream")
    else:
        w = w.format(fmt).option("path", sink)
    q = w.start()
    q.awaitTermination()
    return q


def stream_upsert(stream: DataFrame, snapshot_base: str, keys: list[str], ts_col: str, *, checkpoint: str):
    """Merge every micro-batch into a snapshot (the delta loads as a stream);
    only the partitions that hold a key of the batch are read and written.  A
    batch replayed after a failure is merged again with the same result: the
    upsert is idempotent.  Returns the finished query."""
    from roadloom.plans.pipelines import delta_load

    def merge(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            delta_load(batch.sparkSession, snapshot_base, batch, keys, ts_col, mode="upsert", change_test="always")

    return run_available_now(stream, checkpoint=checkpoint, foreach_batch=merge)


def stream_trips(points: DataFrame, facts: DataFrame, snapshot_base: str, *, checkpoint: str, **options):
    """Trip summaries kept current by the files of route points as they arrive, whatever the times in them.

    Every micro-batch is merged into the trips' states (`plans.pipelines.trips_delta`, which ``options`` go to): an open
    trip is there at once, a late point moves its trip's start or end, and a batch that is replayed after a failure
    changes nothing.  Nothing is kept in streaming state, so no watermark drops a point.  ``facts`` is read again for each
    batch.  Returns the finished query.
    """
    from roadloom.plans.pipelines import trips_delta

    def merge(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            trips_delta(batch.sparkSession, snapshot_base, batch, facts, **options)

    return run_available_now(points, checkpoint=checkpoint, foreach_batch=merge)
