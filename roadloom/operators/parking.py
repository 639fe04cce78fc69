"""Parking-area occupancy over a date window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions.columns import fraction, lit_ts


def window_filter(ts: str, as_of: str | dt.datetime, lookback: dt.timedelta, closed: str = "both"):
    """Predicate for ``[as_of - lookback, as_of]``; ``closed`` picks the ends.

    The reference closes the window at both midnights, so a row stamped
    exactly at midnight belongs to two consecutive daily runs; ``closed="left"``
    gives half-open windows that tile time.  The bounds are literals, so the
    predicate is pushed to the Parquet scan.
    """
    hi = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    lo = hi - lookback
    c = F.col(ts)
    lower = c >= lit_ts(lo) if closed in ("both", "left") else c > lit_ts(lo)
    upper = c <= lit_ts(hi) if closed in ("both", "right") else c < lit_ts(hi)
    return lower & upper


def merge_occupancy(stored: DataFrame, delta: DataFrame, area: str = "area_id") -> DataFrame:
    """``stored`` occupancy with the areas of ``delta`` replaced; areas without new rows keep their last figures."""
    side = delta.select(F.col(area).alias("__rl_k"))
    kept = stored.join(side, F.col(area).eqNullSafe(F.col("__rl_k")), "left_anti")
    return kept.unionByName(delta.select(*stored.columns))


def parking_occupancy(
    df: DataFrame,
    as_of: str | dt.datetime,
    *,
    lookback: dt.timedelta = dt.timedelta(days=1),
    closed: str = "both",
    area: str = "area_id",
    status: str = "status",
    ts: str = "created_on",
    occupied: str = "occupied",
    available: str = "available",
    reserved: str = "reserved",
    order: bool = True,
) -> DataFrame:
    """Spaces per area by status, with occupancy and availability rates."""
    s = F.col(status)
    n_occ = F.count_if(s == F.lit(occupied))
    n_av = F.count_if(s == F.lit(available))
    n_res = F.count_if(s == F.lit(reserved))
    n_all = F.count(F.lit(1))
    out = (
        df.where(window_filter(ts, as_of, lookback, closed))
        .groupBy(area)
        .agg(
            n_occ.alias("occupied_spaces"),
            n_av.alias("available_spaces"),
            n_res.alias("reserved_spaces"),
            n_all.alias("total_spaces"),
        )
        .withColumns(
            {
                "occupancy_rate": fraction(F.col("occupied_spaces"), F.col("total_spaces")),
                "availability_rate": fraction(
                    F.col("available_spaces") + F.col("reserved_spaces"), F.col("total_spaces")
                ),
            }
        )
    )
    if order:
        out = out.orderBy(F.desc("occupancy_rate"), F.col(area))
    return out
