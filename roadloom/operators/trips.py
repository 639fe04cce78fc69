"""Trips: first/last point, trip summary, distance per vehicle and year, routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions.columns import instant_to_utc_ntz, lit_ts, mean, order_columns, parse_iso_utc
from roadloom.operators.sequence import DEFAULT_MAX_GROUP_ROWS, ordered_sequence

# Fixed value: kilometres to miles, as used by the reference.
KM_TO_MILE = 0.621371
UNIT_FACTORS = {"km": 1.0, "mile": KM_TO_MILE}


def trip_first_last(
    points: DataFrame,
    *,
    trip: str = "vehicle_trip_id",
    ts: str = "created_on",
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
    start_prefix: str = "start_",
    end_prefix: str = "end_",
) -> DataFrame:
    """First and last point of every trip in one aggregation (DISTINCT ON).

    ``min``/``max`` of (ts, tiebreak, payload) structs are partial aggregates:
    one scan, one shuffle of at most one row per trip per task, whatever the
    trip sizes.
    """
    order = order_columns(ts, tiebreak)
    columns = columns if columns is not None else [c for c in points.columns if c != trip and c not in order]
    s = F.struct(*[F.col(c) for c in order + columns])
    # a point without a time is the first one only where no point has a time
    first = F.coalesce(F.min(F.when(F.col(ts).isNotNull(), s)), F.min(s))
    agg = points.groupBy(trip).agg(first.alias("__rl_s"), F.max(s).alias("__rl_e"))
    fields = order + columns
    return agg.select(
        trip,
        *[F.col("__rl_s").getField(c).alias(start_prefix + c) for c in fields],
        *[F.col("__rl_e").getField(c).alias(end_prefix + c) for c in fields],
    )


def trip_summary(
    points: DataFrame,
    trips: DataFrame,
    *,
    since=None,
    trip: str = "vehicle_trip_id",
    trips_key: str = "id",
    ts: str = "created_on",
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
    trips_since_col: str | None = None,
) -> DataFrame:
    """First point, last point and trip facts for trips with points after ``since``.

    The reference aligned three result sets by index; here first and last come
    from one aggregation and one join adds the facts.  ``since`` is a literal
    (typically the high-water mark), pushed to both scans.
    """
    if since is not None:
        points = points.where(F.col(ts) > lit_ts(since))
        if trips_since_col:
            trips = trips.where(F.col(trips_since_col) > lit_ts(since))
    fl = trip_first_last(points, trip=trip, ts=ts, tiebreak=tiebreak, columns=columns)
    facts = trips.withColumnRenamed(trips_key, trip) if trips_key != trip else trips
    return fl.join(facts, trip, "inner")


def merge_trips(
    stored: DataFrame,
    points: DataFrame,
    facts: DataFrame,
    since,
    *,
    trip: str = "vehicle_trip_id",
    trips_key: str = "id",
    ts: str = "created_on",
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
    trips_since_col: str | None = None,
) -> DataFrame:
    """``stored`` trip summaries brought up to date with the points after ``since``.

    ``since`` is the newest point that ``stored`` has taken in.  A trip that is stored keeps its start and gets
    the end of its new points; its facts follow the facts table where that still has the trip.  A new trip is
    added with both ends.  The result is what `trip_summary` gives over all points as long as points and facts
    arrive in the order of their times; a point at or before the mark is not seen, which `trip_state` mends.
    ``trips_since_col`` limits the facts that are read to rows after the mark (stored trips then keep their facts).
    """
    if trips_since_col and since is not None:
        facts = facts.where(F.col(trips_since_col) > lit_ts(since))
    if since is not None:
        points = points.where(F.col(ts) > lit_ts(since))
    window = trip_first_last(points, trip=trip, ts=ts, tiebreak=tiebreak, columns=columns)
    fact_cols = [c for c in facts.columns if c != trips_key]
    facts = facts.select(F.col(trips_key).alias("__rl_t"), F.struct(*fact_cols).alias("__rl_facts"))
    new = window.withColumnRenamed(trip, "__rl_w")
    ends = [c for c in window.columns if c.startswith("end_")]
    ends_of = new.select("__rl_w", F.struct(*ends).alias("__rl_ends"))
    out = (stored.join(ends_of, F.col(trip) == F.col("__rl_w"), "left")
           .join(facts, F.col("__rl_w") == F.col("__rl_t"), "left"))

    def current(c: str) -> Column:
        if c in ends:
            return F.when(F.col("__rl_ends").isNotNull(), F.col("__rl_ends").getField(c)).otherwise(F.col(c))
        if c in fact_cols:
            return F.when(F.col("__rl_facts").isNotNull(), F.col("__rl_facts").getField(c)).otherwise(F.col(c))
        return F.col(c)

    known = out.select(*[current(c).alias(c) for c in stored.columns])
    fresh = (window.join(stored.select(F.col(trip).alias("__rl_s")), F.col(trip) == F.col("__rl_s"), "left_anti")
             .join(facts, F.col(trip) == F.col("__rl_t")))
    fresh = fresh.select(*[F.col("__rl_facts").getField(c).alias(c) if c in fact_cols else F.col(c) for c in stored.columns])
    return known.unionByName(fresh)


def trip_state(
    points: DataFrame | None,
    facts: DataFrame | None,
    *,
    trip: str = "vehicle_trip_id",
    trips_key: str = "id",
    ts: str = "created_on",
    tiebreak: str | list[str] | None = None,
    columns: list[str] | None = None,
    version: str | None = None,
) -> DataFrame:
    """What a batch of points and facts tells about each trip: (trip, first_point, last_point, facts).

    A part that the batch does not have is NULL: a trip whose facts are still missing is kept, and so are facts that
    came before the points.  ``facts`` holds ``version`` (the column of that name, larger is newer; NULL without one) and the
    values.  One aggregation with partial sums; a batch may hold points of any time.  Of facts that repeat a trip in a
    batch the newest counts, the largest values at equal versions.
    """
    frames = []
    if points is not None:
        order = order_columns(ts, tiebreak)
        columns = columns if columns is not None else [c for c in points.columns if c != trip and c not in order]
        s = F.struct(*[F.col(c) for c in order + columns])
        first = F.coalesce(F.min(F.when(F.col(ts).isNotNull(), s)), F.min(s))
        frames.append(points.groupBy(trip).agg(first.alias("first_point"), F.max(s).alias("last_point")))
    if facts is not None:
        values = F.struct(*[F.col(c) for c in facts.columns if c not in (trips_key, version)]).alias("values")
        number = (F.col(version) if version else F.lit(None)).cast("long").alias("version")
        frames.append(facts.select(F.col(trips_key).alias(trip), F.struct(number, values).alias("facts"))
                      .groupBy(trip).agg(F.max("facts").alias("facts")))
    return merge_states(*frames, trip=trip)


STATE = ("first_point", "last_point", "facts")


def merge_states(*states: DataFrame, trip: str = "vehicle_trip_id") -> DataFrame:
    """States of any batches put together: smallest first point, largest last point, newest facts of each trip.

    Taking a batch in twice changes nothing and points may come in any order of batches.  So may facts with versions; at equal
    versions those of the later argument count.
    """
    kinds = {c: df.schema[c].dataType for df in states for c in STATE if c in df.columns}
    rows = None
    for rank, df in enumerate(states):
        cols = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in STATE if c in kinds]
        df = df.select(trip, *cols, F.lit(rank).alias("__rl_rank"))
        rows = df if rows is None else rows.unionByName(df)
    out = []
    if "first_point" in kinds:
        p = F.col("first_point")
        timed = F.min(F.when(p[kinds["first_point"].names[0]].isNotNull(), p))
        out = [F.coalesce(timed, F.min(p)).alias("first_point"), F.max("last_point").alias("last_point")]
    if "facts" in kinds:
        newest = F.max(F.when(F.col("facts").isNotNull(), F.struct(F.col("facts.version"), "__rl_rank", F.col("facts.values"))))
        out.append(newest.alias("__rl_f"))
    merged = rows.groupBy(trip).agg(*out)
    if "facts" not in kinds:
        return merged
    f = F.col("__rl_f")
    return merged.withColumn("facts", F.when(f.isNotNull(), F.struct(f["version"].alias("version"), f["values"].alias("values")))).drop("__rl_f")


def trips_pending(state: DataFrame, trip: str = "vehicle_trip_id") -> DataFrame:
    """Trips that have points and still miss their facts."""
    return state.where(F.col("first_point").isNotNull() & F.col("facts").isNull()).select(trip)


def state_rows(state: DataFrame, *, trip: str = "vehicle_trip_id", start_prefix: str = "start_", end_prefix: str = "end_") -> DataFrame:
    """The trips of a state that have points and facts, as `trip_summary` gives them."""
    done = state.where(F.col("first_point").isNotNull() & F.col("facts").isNotNull())
    fields = state.schema["first_point"].dataType.names
    values = state.schema["facts"].dataType["values"].dataType.names
    return done.select(
        trip,
        *[F.col("first_point").getField(c).alias(start_prefix + c) for c in fields],
        *[F.col("last_point").getField(c).alias(end_prefix + c) for c in fields],
        *[F.col("facts.values").getField(c).alias(c) for c in values],
    )


def distance_by_year(
    df: DataFrame,
    *,
    vehicle: str = "vehicle_id",
    year: str = "year",
    distance: str = "distance_traveled",
    unit: str = "mile",
) -> DataFrame:
    """Total distance per (vehicle, year), converted after summing.

    Rows with a NULL vehicle or year are dropped, as pandas ``groupby`` does.
    """
    factor = UNIT_FACTORS[unit]
    out = (
        df.where(F.col(vehicle).isNotNull() & F.col(year).isNotNull())
        .groupBy(vehicle, year)
        .agg(F.sum(distance).alias(distance))
    )
    if factor != 1.0:
        out = out.withColumn(distance, F.col(distance) * F.lit(factor))
    return out


def vehicle_routes(
    points: DataFrame,
    *,
    vehicle: str = "vehicle_id",
    ts: str = "time_stamp",
    tiebreak: str | list[str] | None = None,
    latitude: str = "latitude",
    longitude: str = "longitude",
    speed: str = "speed",
    float_scale: int | None = None,
) -> DataFrame:
    """Route summary per vehicle: points, first and last position, mean speed.

    The ordered route itself is ``route_points`` (one row per point with its
    position in the route).  It is not folded into one array per vehicle:
    a vehicle with a third of all points would make one row of that size.
    """
    order = order_columns(ts, tiebreak)
    s = F.struct(*[F.col(c) for c in order], F.col(latitude).alias("lat"), F.col(longitude).alias("lon"))
    agg = points.groupBy(vehicle).agg(
        F.count(F.lit(1)).alias("route_points"),
        F.min(s).alias("__rl_f"),
        F.max(s).alias("__rl_l"),
        mean(speed, float_scale).alias("average_speed"),
    )
    return agg.select(
        vehicle,
        "route_points",
        F.col("__rl_f.lat").alias("first_latitude"),
        F.col("__rl_f.lon").alias("first_longitude"),
        F.col("__rl_l.lat").alias("last_latitude"),
        F.col("__rl_l.lon").alias("last_longitude"),
        "average_speed",
    )


def route_points(
    points: DataFrame,
    *,
    vehicle: str = "vehicle_id",
    ts: str = "time_stamp",
    tiebreak: str | list[str] | None = None,
    latitude: str = "latitude",
    longitude: str = "longitude",
    max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """The ordered route as rows: (vehicle, point_index, ts, latitude, longitude)."""
    order = order_columns(ts, tiebreak)
    base = points.select(vehicle, *order, latitude, longitude)
    return ordered_sequence(base, [vehicle], order, row_number="point_index", max_group_rows=max_group_rows)


def run_fleet_pipeline(
    tracks: DataFrame,
    *,
    gps_col: str = "gps_coordinates",
    vehicle: str = "vehicle_id",
    ts: str = "time_stamp",
    distance: str = "distance_traveled",
    unit: str = "mile",
) -> DataFrame:
    """The JSON pipeline's transformation chain as one lazy plan:
    validate positions -> distance per vehicle and year -> unit conversion.

    ``year`` comes from the timestamp (ISO text or a timestamp column).
    """
    from roadloom.operators.gps import accepted_positions, split_rejects

    good, _ = split_rejects(accepted_positions(tracks, gps_col))
    kind = tracks.schema[ts].dataType.simpleString()
    if kind == "string":
        ts_col = parse_iso_utc(ts)
    elif kind == "timestamp":
        ts_col = instant_to_utc_ntz(ts)
    else:
        ts_col = F.col(ts)
    with_year = good.withColumn("year", F.year(ts_col))
    return distance_by_year(with_year, vehicle=vehicle, year="year", distance=distance, unit=unit)


def fleet_rejects(tracks: DataFrame, *, gps_col: str = "gps_coordinates") -> DataFrame:
    """The tracks that `run_fleet_pipeline` leaves out for their position, with ``gps_reason``."""
    from roadloom.operators.gps import accepted_positions, split_rejects

    return split_rejects(accepted_positions(tracks, gps_col))[1]


def clean_positions(
    df: DataFrame,
    *,
    gps_col: str = "gps_coordinates",
    box: dict[str, float] | None = None,
    mode: str = "inside",
) -> DataFrame:
    """The ingestion cleaning step: drop rows with NULLs, convert positions to
    decimal degrees, then fence (conversion first, so the fence compares
    numbers, not text)."""
    from roadloom.operators.geo import geo_fence
    from roadloom.operators.gps import ACCEPTED, normalize_gps

    pos = normalize_gps(df.na.drop("any"), gps_col)
    pos = pos.where(F.col("gps_reason") == F.lit(ACCEPTED)).drop("gps_reason")
    return geo_fence(pos, latitude="latitude", longitude="longitude", box=box, mode=mode, drop_nulls=None)
