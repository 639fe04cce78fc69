"""Event tables: rollups, conditional sums, sequences, gaps, first/latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.functions.columns import (
    order_columns,
    days_between,
    epoch_micros_ntz,
    mean,
    micros_between,
    month_start,
    total,
    year_start,
)
from roadloom.operators.sequence import DEFAULT_MAX_GROUP_ROWS, ordered_sequence


def event_rollup(
    df: DataFrame,
    *,
    user: str = "user_id",
    ts: str = "event_date",
    event_type: str = "event_type",
    amount: str = "event_amount",
    float_scale: int | None = None,
    strategy: str = "staged",
) -> DataFrame:
    """ROLLUP(user, month, year, type): sum, distinct event times, average.

    ``grouping_id`` tells subtotal rows from real NULL keys (first key is the
    most significant bit: 0, 1, 3, 7, 15 from the finest level up).

    ``strategy="expand"`` is Spark's own plan: Expand copies every row five
    times (one per grouping set) before the distinct aggregation's shuffle.
    ``strategy="staged"`` (default) uses that month and year are functions of
    the event time, so distinct event times add up across months:

    * (user, type, time) rows -> the finest level;
    * (user, time) rows -> (user, month, year); (user, month) and (user) are
      sums of those (a month lies in one year; months hold disjoint times);
    * the grand total counts distinct times once.

    That is about three shuffles of input size instead of five copies, and
    the same result.
    """
    if strategy == "expand":
        base = df.select(
            F.col(user).alias(user),
            month_start(ts).alias("month"),
            year_start(ts).alias("year"),
            F.col(event_type).alias(event_type),
            F.col(amount).alias("__amount"),
            F.col(ts).alias("__ts"),
        )
        return base.rollup(user, "month", "year", event_type).agg(
            total("__amount", float_scale).alias("event_amount_sum"),
            F.count_distinct("__ts").alias("distinct_event_dates"),
            mean("__amount", float_scale).alias("event_amount_avg"),
            F.grouping_id().alias("grouping_id"),
        )
    if strategy != "staged":
        raise ValueError("strategy must be 'staged' or 'expand'")

    s_, c_, d_ = "__rl_s", "__rl_c", "__rl_d"
    d1 = df.groupBy(F.col(user).alias(user), F.col(event_type).alias(event_type), F.col(ts).alias("__ts")).agg(
        F.sum(amount).alias(s_), F.count(amount).alias(c_)
    )
    when_ts = {"month": month_start("__ts"), "year": year_start("__ts")}
    l4 = d1.groupBy(user, when_ts["month"].alias("month"), when_ts["year"].alias("year"), event_type).agg(
        F.sum(s_).alias(s_), F.sum(c_).alias(c_), F.count("__ts").alias(d_)
    )
    d2 = d1.groupBy(user, "__ts").agg(F.sum(s_).alias(s_), F.sum(c_).alias(c_))
    l3 = d2.groupBy(user, when_ts["month"].alias("month"), when_ts["year"].alias("year")).agg(
        F.sum(s_).alias(s_), F.sum(c_).alias(c_), F.count("__ts").alias(d_)
    )
    roll = lambda frame, keys: frame.groupBy(*keys).agg(
        F.sum(s_).alias(s_), F.sum(c_).alias(c_), F.sum(d_).alias(d_)
    )
    l2 = roll(l3, [user, "month"])
    l1 = roll(l3, [user])
    l0 = d2.agg(F.sum(s_).alias(s_), F.sum(c_).alias(c_), F.count_distinct("__ts").alias(d_))

    null_ts = F.lit(None).cast("timestamp_ntz")
    null_type = F.lit(None).cast(df.schema[event_type].dataType)
    null_user = F.lit(None).cast(df.schema[user].dataType)

    def level(frame: DataFrame, gid: int, u, m, y, t) -> DataFrame:
        return frame.select(
            u.alias(user), m.alias("month"), y.alias("year"), t.alias(event_type),
            F.col(s_), F.col(c_), F.col(d_), F.lit(gid).cast("long").alias("grouping_id"),
        )

    levels = (
        level(l4, 0, F.col(user), F.col("month"), F.col("year"), F.col(event_type))
        .unionByName(level(l3, 1, F.col(user), F.col("month"), F.col("year"), null_type))
        .unionByName(level(l2, 3, F.col(user), F.col("month"), null_ts, null_type))
        .unionByName(level(l1, 7, F.col(user), null_ts, null_ts, null_type))
        .unionByName(level(l0, 15, null_user, null_ts, null_ts, null_type))
    )
    rounded = F.round(F.col(s_), float_scale) if float_scale is not None else F.col(s_)
    return levels.select(
        user, "month", "year", event_type,
        rounded.alias("event_amount_sum"),
        F.col(d_).alias("distinct_event_dates"),
        F.try_divide(rounded, F.col(c_).cast("double")).alias("event_amount_avg"),
        "grouping_id",
    )


#: Grains of a rollup's state: what adds up over months, each with its own distinct times.
GRAINS = ("type", "user", "all")
#: Bits of the sketches' register numbers: a relative standard error of about 1.04 / sqrt(2 ** 12), 1.6 %.
SKETCH_BITS = 12


def _micros(df: DataFrame, ts: str) -> Column:
    return epoch_micros_ntz(ts) if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else F.unix_micros(F.col(ts).cast("timestamp"))


def rollup_state(df: DataFrame, *, user: str = "user_id", ts: str = "event_date", event_type: str = "event_type",
                 amount: str = "event_amount") -> DataFrame:
    """What `event_rollup` needs of some events, per month: (grain, user, month, type, amount, amounts, times, sketch).

    ``times`` is the exact number of distinct event times of a user, month and type (grain ``type``), of a user and
    month (``user``) and of a month (``all``); months hold disjoint times, so coarser levels are sums.  ``sketch`` is an
    HLL sketch of the same times, which states of any events can be merged by, whether or not they overlap.
    """
    u, kind = df.schema[user].dataType, df.schema[event_type].dataType
    base = df.select(F.col(user).alias("user"), F.col(event_type).alias("type"), F.col(ts).alias("time"), F.col(amount).alias("v"),
                     _micros(df, ts).alias("micros"))
    d1 = base.groupBy("user", "type", "time", "micros").agg(F.sum("v").alias("s"), F.count("v").alias("c"))
    d2 = d1.groupBy("user", "time", "micros").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    d3 = d2.groupBy("time", "micros").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    null_user, null_type = F.lit(None).cast(u).alias("user"), F.lit(None).cast(kind).alias("type")
    out = None
    for grain, rows, cols in (("type", d1, [F.col("user"), F.col("type")]), ("user", d2, [F.col("user"), null_type]), ("all", d3, [null_user, null_type])):
        rows = rows.select(*cols, month_start("time").alias("month"), "s", "c", "time", "micros").groupBy("user", "type", "month").agg(
            F.sum("s").alias("amount"), F.sum("c").alias("amounts"), F.count("time").alias("times"),
            F.hll_sketch_agg("micros", SKETCH_BITS).alias("sketch"))
        rows = rows.select(F.lit(grain).alias("grain"), "user", "month", "type", "amount", "amounts", "times", "sketch")
        out = rows if out is None else out.unionByName(rows)
    return out


def rollup_extended(state: DataFrame, history: DataFrame, delta: DataFrame, *, user: str = "user_id", ts: str = "event_date",
                    event_type: str = "event_type", amount: str = "event_amount") -> DataFrame:
    """``state`` with the new events ``delta``, exact: only the months of users that the delta has are worked out again.

    ``history`` holds all events, the delta's too.  Rows of other users and months stay as they are.
    """
    names = {"user": user, "ts": ts, "event_type": event_type, "amount": amount}
    pairs = delta.select(F.col(user).alias("u"), month_start(ts).alias("m")).distinct()
    months = pairs.select("m").distinct()
    month = month_start(history[ts])
    of_pairs = history.join(pairs, history[user].eqNullSafe(F.col("u")) & month.eqNullSafe(F.col("m")), "left_semi")
    of_months = history.join(months, month.eqNullSafe(F.col("m")), "left_semi")
    fresh = rollup_state(of_pairs, **names).where("grain <> 'all'").unionByName(rollup_state(of_months, **names).where("grain = 'all'"))
    kept_users = state.where("grain <> 'all'").join(pairs, F.col("user").eqNullSafe(F.col("u")) & F.col("month").eqNullSafe(F.col("m")), "left_anti")
    kept_months = state.where("grain = 'all'").join(months, F.col("month").eqNullSafe(F.col("m")), "left_anti")
    return kept_users.unionByName(kept_months).unionByName(fresh)


def rollup_merged(*states: DataFrame) -> DataFrame:
    """States of different events put together without any event: amounts add up, distinct times are the sketches' estimates."""
    rows = states[0]
    for state in states[1:]:
        rows = rows.unionByName(state)
    merged = rows.groupBy("grain", "user", "month", "type").agg(
        F.sum("amount").alias("amount"), F.sum("amounts").alias("amounts"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("grain", "user", "month", "type", "amount", "amounts", F.hll_sketch_estimate("sketch").alias("times"), "sketch")


def rollup_rows(state: DataFrame, *, user: str = "user_id", event_type: str = "event_type", float_scale: int | None = None) -> DataFrame:
    """The rows of `event_rollup` from a state."""
    def summed(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("amount", "amounts", "times")])

    by_user = state.where("grain = 'user'")
    null_ts = F.lit(None).cast("timestamp_ntz")
    null_user, null_type = (F.lit(None).cast(state.schema[c].dataType) for c in ("user", "type"))
    year = year_start("month")
    levels = None
    for gid, frame, u, m, y, t in (
            (0, state.where("grain = 'type'"), F.col("user"), F.col("month"), year, F.col("type")),
            (1, by_user, F.col("user"), F.col("month"), year, null_type), (3, by_user, F.col("user"), F.col("month"), null_ts, null_type),
            (7, summed(by_user, "user"), F.col("user"), null_ts, null_ts, null_type),
            (15, summed(state.where("grain = 'all'")), null_user, null_ts, null_ts, null_type)):
        total_ = F.round("amount", float_scale) if float_scale is not None else F.col("amount")
        rows = frame.select(u.alias(user), m.alias("month"), y.alias("year"), t.alias(event_type), total_.alias("event_amount_sum"),
                            F.col("times").alias("distinct_event_dates"), F.try_divide(total_, F.col("amounts").cast("double")).alias("event_amount_avg"),
                            F.lit(gid).cast("long").alias("grouping_id"))
        levels = rows if levels is None else levels.unionByName(rows)
    return levels


def net_purchases(
    df: DataFrame,
    *,
    user: str = "user_id",
    event_type: str = "event_type",
    amount: str = "event_amount",
    purchase: str = "purchase",
    refund: str = "refund",
    float_scale: int | None = None,
) -> DataFrame:
    """Per user: purchase amount minus refund amount, and both counts."""
    t = F.col(event_type)
    bought = F.when(t == F.lit(purchase), F.col(amount)).otherwise(F.lit(0.0))
    refunded = F.when(t == F.lit(refund), F.col(amount)).otherwise(F.lit(0.0))
    return df.groupBy(user).agg(
        (total(bought, float_scale) - total(refunded, float_scale)).alias("net_purchases"),
        F.count_if(t == F.lit(purchase)).alias("total_purchases"),
        F.count_if(t == F.lit(refund)).alias("total_refunds"),
    )


def event_sequence(
    df: DataFrame,
    *,
    key: str = "vehicle_id",
    ts: str = "event_time",
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
    max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """Each event with its month, year and 1-based number within ``key``."""
    order = order_columns(ts, tiebreak)
    cols = columns if columns is not None else [c for c in df.columns if c != key and c not in order]
    keep = list(dict.fromkeys([key, *order, *cols]))
    base = df.select(*keep).withColumns(
        {"event_month": F.month(ts), "event_year": F.year(ts)}
    )
    return ordered_sequence(base, [key], order, row_number="event_num", max_group_rows=max_group_rows)


def _extreme_per_group(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], latest: bool
) -> DataFrame:
    """First (or last) row per group by a total order, as an aggregate.

    ``min``/``max`` of a struct compare field by field, so the struct
    (order..., payload...) picks the row with the smallest (largest) order
    value.  This is a partial aggregation: each task keeps one row per key
    before the shuffle, so a hot key costs one row per task, not one task.
    A row without a time is the first one only where no row has a time: NULLs
    sort last, as in the source databases.
    """
    payload = [c for c in columns if c not in keys and c not in order]
    s = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])
    first = F.coalesce(F.min(F.when(F.col(order[0]).isNotNull(), s)), F.min(s))
    pick = (F.max(s) if latest else first).alias("__rl_pick")
    return df.groupBy(*keys).agg(pick).select(
        *keys, *[F.col("__rl_pick").getField(c).alias(c) for c in order + payload]
    )


def event_first(
    df: DataFrame,
    *,
    keys: list[str] | None = None,
    ts: str = "event_date",
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """First event per (user, type): ROW_NUMBER() ... = 1 without a window."""
    keys = keys or ["user_id", "event_type"]
    order = order_columns(ts, tiebreak)
    cols = columns if columns is not None else df.columns
    return _extreme_per_group(df, keys, order, cols, latest=False)


def dedupe_latest(
    df: DataFrame,
    keys: list[str],
    *,
    ts: str,
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Drop duplicates keeping the latest row per key (total order, no window)."""
    order = order_columns(ts, tiebreak)
    cols = columns if columns is not None else df.columns
    return _extreme_per_group(df, keys, order, cols, latest=True)


def event_gaps_days(
    df: DataFrame,
    *,
    keys: list[str] | None = None,
    ts: str = "event_date",
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
    max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """Previous event time and calendar days since it, within (user, type)."""
    keys = keys or ["user_id", "event_type"]
    order = order_columns(ts, tiebreak)
    cols = columns or []
    keep = list(dict.fromkeys([*keys, *order, *cols]))
    seq = ordered_sequence(
        df.select(*keep), keys, order, row_number=None,
        lags={"prev_event_date": ts}, max_group_rows=max_group_rows,
    )
    return seq.withColumn("days_since_prev_event", days_between("prev_event_date", ts))


def merge_event_profile(stored: DataFrame, history: DataFrame, window: DataFrame, *, vehicle: str = "vehicle_id", **options) -> DataFrame:
    """``stored`` monthly profiles with those of the vehicles that occur in ``window`` worked out again.

    A month's figures need all its events and the gap before the first one, so vehicles with new events are
    profiled from ``history``; all others keep their rows.  ``options`` as for `monthly_event_profile`.
    """
    touched = window.select(F.col(vehicle).alias("__rl_k")).distinct()
    again = history.join(touched, F.col(vehicle).eqNullSafe(F.col("__rl_k")), "left_semi")
    kept = stored.join(touched, F.col(vehicle).eqNullSafe(F.col("__rl_k")), "left_anti")
    return kept.unionByName(monthly_event_profile(again, vehicle=vehicle, **options).select(*stored.columns))


def monthly_event_profile(
    df: DataFrame,
    *,
    vehicle: str = "vehicle_id",
    ts: str = "event_time",
    tiebreak: str | list[str] | None = None,
    event_type: str = "event_type",
    location: str | Column = "event_location",
    maintenance: str = "maintenance",
    max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """Per vehicle and calendar month: events, distinct locations,
    maintenance events and mean seconds between consecutive events.

    The gap is taken over the vehicle's whole history (previous event may be
    in an earlier month) and belongs to the later event.  The mean is the
    exact sum of microsecond gaps divided by their count.
    """
    loc = F.col(location) if isinstance(location, str) else location
    order = order_columns(ts, tiebreak)
    base = df.select(
        F.col(vehicle).alias(vehicle),
        *[F.col(c) for c in order],
        F.col(event_type).alias("__type"),
        loc.alias("__loc"),
    )
    seq = ordered_sequence(
        base, [vehicle], order, row_number=None, lags={"__prev": ts}, max_group_rows=max_group_rows
    )
    gap = micros_between("__prev", ts, ntz=isinstance(df.schema[ts].dataType, T.TimestampNTZType))
    seq = seq.withColumns(
        {"event_month": F.month(ts), "event_year": F.year(ts), "__gap": gap}
    )
    return seq.groupBy(vehicle, "event_month", "event_year").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("__loc").alias("unique_locations"),
        F.count_if(F.col("__type") == F.lit(maintenance)).alias("maintenance_events"),
        (
            F.try_divide(F.sum("__gap").cast("double"), F.count("__gap").cast("double"))
            / F.lit(1_000_000.0)
        ).alias("avg_time_between_events"),
    )
