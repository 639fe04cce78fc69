"""Incremental loads: high-water mark, change detection, upsert (D-1 .. D-7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.operators.events import dedupe_latest


def high_watermark(df: DataFrame, ts_col: str):
    """MAX(ts_col) as a Python value: one aggregated row, not a sort.

    The value is small and bounded (one scalar); it is used as a literal so
    the next filter is pushed to the Parquet scan (row-group pruning).
    """
    return df.agg(F.max(ts_col).alias("wm")).first()["wm"]


def typed_literal(df: DataFrame, column: str, value):
    """``value`` as a literal of ``column``'s type.

    A TIMESTAMP_NTZ value comes back to Python as a naive datetime; a plain
    ``lit`` would make it a session-zone TIMESTAMP and shift the comparison
    in a non-UTC session.  Going through text keeps it zone-free.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value).cast(dtype)


def rows_after(df: DataFrame, ts_col: str, watermark) -> DataFrame:
    """Rows strictly after the mark (all rows when the mark is None).  The
    mark is a literal of the column's type, so it is pushed to the scan."""
    if watermark is None:
        return df
    return df.where(F.col(ts_col) > typed_literal(df, ts_col, watermark))


def key_set_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys added in ``new`` and removed from ``old`` with a ``change`` label.

    One aggregation over the tagged union of both key sets: a single shuffle
    of key columns (map-side combined), instead of two distincts and two anti
    joins.  A key present on both sides drops out.
    """
    tagged = old.select(*keys, F.lit(1).alias("__rl_old"), F.lit(0).alias("__rl_new")).unionByName(
        new.select(*keys, F.lit(0).alias("__rl_old"), F.lit(1).alias("__rl_new"))
    )
    sides = tagged.groupBy(*keys).agg(F.max("__rl_old").alias("__rl_o"), F.max("__rl_new").alias("__rl_n"))
    return sides.where(F.col("__rl_o") != F.col("__rl_n")).select(
        *keys, F.when(F.col("__rl_n") == 1, F.lit("added")).otherwise(F.lit("removed")).alias("change")
    )


def key_sets_equal(old: DataFrame, new: DataFrame, keys: list[str]) -> bool:
    """True when both sides hold the same key set (the reference's set compare)."""
    return key_set_changes(old, new, keys).isEmpty()


def key_count_changed(old: DataFrame, new: DataFrame, key: str) -> bool:
    """True when the number of distinct keys differs (the parking-area test)."""
    a = old.agg(F.count_distinct(key).alias("n")).first()["n"]
    b = new.agg(F.count_distinct(key).alias("n")).first()["n"]
    return a != b


def watermark_changed(old: DataFrame, new: DataFrame, ts_col: str) -> bool:
    """True when the newest timestamp differs (bookings, events, trips)."""
    return high_watermark(old, ts_col) != high_watermark(new, ts_col)


#: Rows of a delta whose keys may be broadcast.
BROADCAST_ROWS = 200_000


def is_small(delta: DataFrame, keys: list[str], most: int = BROADCAST_ROWS) -> bool:
    """Whether a delta's keys are few enough to be broadcast; counts ``most`` + 1 rows at most."""
    return delta.select(*keys).limit(most + 1).count() <= most


def upsert(existing: DataFrame, delta: DataFrame, keys: list[str], *, ts_col: str,
           tiebreak: str | None = None, small: bool = False) -> DataFrame:
    """One row per key: the newest of the existing row and the delta's rows.

    The delta is reduced to one row per key with a partial aggregation.  The
    existing rows are never aggregated; with ``small`` (see `is_small`) the
    delta's keys are broadcast and the existing rows are not shuffled either,
    else Spark joins by its own measure of the sides.  A stored row that is newer
    than the delta's stays; at equal times the delta wins.  NULL keys are a key
    like any other.
    """
    latest = dedupe_latest(delta, keys, ts=ts_col, tiebreak=tiebreak, columns=existing.columns)
    latest = latest.select(*existing.columns)

    def others(df: DataFrame) -> tuple[DataFrame, Column]:
        side = df.select(*[F.col(k).alias(f"__rl_k{i}") for i, k in enumerate(keys)], F.col(ts_col).alias("__rl_ts"))
        side = F.broadcast(side) if small else side
        cond = None
        for i, k in enumerate(keys):
            c = F.col(k).eqNullSafe(F.col(f"__rl_k{i}"))
            cond = c if cond is None else cond & c
        return side, cond

    side, same = others(latest)
    kept = existing.join(side, same & F.coalesce(F.col("__rl_ts") >= F.col(ts_col), F.lit(True)), "left_anti")
    # delta rows that a stored row is newer than: found from the stored side, so that it streams past the delta
    newer = existing.join(side, same & (F.col("__rl_ts") < F.col(ts_col)), "left_semi").select(*keys)
    older = None
    for i, k in enumerate(keys):
        newer = newer.withColumnRenamed(k, f"__rl_n{i}")
        c = F.col(k).eqNullSafe(F.col(f"__rl_n{i}"))
        older = c if older is None else older & c
    # with a unique stored key there are at most as many as the delta has
    return kept.unionByName(latest.join(newer, older, "left_anti"))


def apply_delta(existing: DataFrame, source: DataFrame, keys: list[str], ts_col: str,
                mode: str = "upsert") -> DataFrame:
    """``refresh``: the source replaces the snapshot (its query is unfiltered);
    ``upsert``: the source is a window of changes merged into the snapshot."""
    if mode == "refresh":
        return source.select(*existing.columns)
    if mode == "upsert":
        return upsert(existing, source, keys, ts_col=ts_col)
    raise ValueError("mode must be 'refresh' or 'upsert'")
