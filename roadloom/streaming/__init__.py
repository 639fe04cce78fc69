"""Structured Streaming versions of the polling delta loads."""

from roadloom.streaming.streams import (  # noqa: F401
    daily_occupancy,
    dedupe_within_watermark,
    run_available_now,
    stream_files,
    stream_trips,
    stream_upsert,
    trip_sessions,
)
