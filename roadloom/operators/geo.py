"""Geometry features and groups, radius filter, nearest site, geo-fence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions.columns import col
from roadloom.functions.geometry import (
    distance,
    geometry_type,
    haversine_m,
    measures_from,
    normal_form,
    parse_wkt,
    path_moments,
    ring_stats,
    ring_totals,
)
from roadloom.session import holding, worked_out_once

# The reference's city bounding box (strict bounds), degrees.
BARCELONA_BOX = {"north": 41.5, "south": 41.2, "west": 2.0, "east": 2.2}


def geometry_features(
    df: DataFrame, *, id_col: str = "id", wkt: str = "geometry", properties: list[str] | None = None, decimals: int | None = None
) -> DataFrame:
    """WKT text -> type, centroid, area, perimeter and length per row.

    Measures are taken from a normal form of the shape, so equal shapes have equal measures, bit for bit, whichever
    vertex their text begins with, whichever way it runs and in whatever order it names holes.  ``decimals`` makes
    coordinates fixed-point numbers first, so that rounding noise in the text does not tell shapes apart.
    Staged projections (rings -> per-ring sums -> totals -> measures) so each
    array expression is evaluated once per row, not once per output field.
    """
    props = properties if properties is not None else [c for c in df.columns if c not in (id_col, wkt)]
    g = df.select(id_col, *props, geometry_type(wkt).alias("geom_type"), parse_wkt(wkt).alias("__rl_text"))
    g = g.withColumn("__rl_rings", normal_form("__rl_text", "geom_type", decimals)).drop("__rl_text")
    g = g.withColumn("__rl_stats", ring_stats("__rl_rings"))
    g = g.withColumns({"__rl_tot": ring_totals("__rl_stats"), "__rl_mom": path_moments("__rl_rings")})
    g = g.withColumn("__rl_m", measures_from("__rl_tot", "__rl_mom", "geom_type"))
    m = F.col("__rl_m")
    return g.select(
        id_col, "geom_type",
        m["centroid_x"].alias("centroid_x"), m["centroid_y"].alias("centroid_y"),
        m["area"].alias("area"), m["perimeter"].alias("perimeter"), m["length"].alias("length"),
        *props,
    )


GROUP_KEYS = ["centroid_x", "centroid_y", "area", "perimeter"]


def geometry_groups(features: DataFrame, *, keys: list[str] | None = None) -> DataFrame:
    """Rows per identical (centroid, area, perimeter), joined back to each feature.

    Grouped count then equi-join on the group key (not a window): the count is
    a partial aggregation and the join is split by AQE if one shape is hot.  The
    features are worked out once, for the rows and for their counts.
    """
    keys = keys or GROUP_KEYS
    features = worked_out_once(features)
    counts = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    counts = counts.select(*[F.col(k).alias(f"__rl_g_{k}") for k in keys], "count")
    cond = None
    for k in keys:
        c = features[k].eqNullSafe(counts[f"__rl_g_{k}"])
        cond = c if cond is None else cond & c
    return holding(features.join(counts, cond, "inner").drop(*[f"__rl_g_{k}" for k in keys]), features)


def within_radius(
    df: DataFrame,
    *,
    location_x: str = "location_x",
    location_y: str = "location_y",
    point_x: str = "longitude",
    point_y: str = "latitude",
    radius: str | float = "radius",
    keep: list[str] | None = None,
    metres: bool = False,
) -> DataFrame:
    """Rows whose location lies within ``radius`` of their own (x, y) point,
    with the distance (ST_DWithin + ST_Distance on one table).

    Distances are planar in the units of the coordinates; with ``metres`` x and y are longitude and latitude in degrees,
    and distance and radius are great-circle metres (planar degrees are a quarter shorter east-west than
    north-south at 41 degrees).
    """
    if metres:
        d = haversine_m(F.col(location_y), F.col(location_x), F.col(point_y), F.col(point_x))
    else:
        d = distance(F.col(location_x), F.col(location_y), F.col(point_x), F.col(point_y))
    r = F.col(radius) if isinstance(radius, str) else F.lit(float(radius))
    keep = keep if keep is not None else df.columns
    return df.select(*keep, d.alias("distance")).where(F.col("distance") <= r)


def nearest_per_id(df: DataFrame, id_col: str = "id", distance_col: str = "distance") -> DataFrame:
    """The row of smallest distance per id (rank 1), as an aggregate."""
    rest = [c for c in df.columns if c not in (id_col, distance_col)]
    best = df.groupBy(id_col).agg(F.min(F.struct(distance_col, *rest)).alias("__rl_b"))
    return best.select(*[F.col(c) if c == id_col else F.col("__rl_b").getField(c).alias(c) for c in df.columns])


_OFFSETS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]

DEFAULT_MAX_CANDIDATES = 4096


def _offsets() -> Column:
    return F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _OFFSETS])


def _cells(df: DataFrame, x: str, y: str, size: float, cx: str = "__cx", cy: str = "__cy") -> DataFrame:
    # a little larger than the reach, so that rounding of x / size can't put a pair two cells apart
    size = F.lit(size * (1 + 1e-9))
    return df.withColumns({cx: F.floor(F.col(x) / size), cy: F.floor(F.col(y) / size)})


def _spread(sites: DataFrame, size: float) -> DataFrame:
    """Every site copied to the 3 x 3 cells around its own cell."""
    s = _cells(sites, "site_x", "site_y", size, "__sx0", "__sy0").select("*", F.explode(_offsets()).alias("__o"))
    return s.withColumns(
        {"__cx": F.col("__sx0") + F.col("__o.dx"), "__cy": F.col("__sy0") + F.col("__o.dy")}
    ).drop("__sx0", "__sy0", "__o")


#: Sites of one cell list; denser cells have several lists.
LISTED = 512


def _cell_lists(sites: DataFrame, size: float) -> DataFrame:
    """(__cx, __cy, __sites): the sites of every 3 x 3 neighbourhood, in lists of at most LISTED."""
    from pyspark.sql import Window

    w = Window.partitionBy("__cx", "__cy").orderBy("site_id")
    numbered = _spread(sites, size).withColumn("__list", F.floor((F.row_number().over(w) - 1) / LISTED))
    lists = numbered.groupBy("__cx", "__cy", "__list").agg(F.collect_list(F.struct("site_id", "site_x", "site_y", "__sr")).alias("__sites"))
    return lists.drop("__list")


def _first_k(near: Column, k: int) -> Column:
    return F.slice(F.sort_array(near), 1, k)


def _nearest_listed(points: DataFrame, sites: DataFrame, size: float, k: int, how: str = "inner") -> DataFrame:
    """``points`` with ``__near``: the k nearest qualifying sites within ``size``, one row per list of the point's cell.

    They are picked inside the row, so pairs of points and sites are never rows that a task must sort.
    """
    joined = _cells(points, "__px", "__py", size).join(_cell_lists(sites, size), ["__cx", "__cy"], how)

    def measured(site: Column) -> Column:
        d = distance(F.col("__px"), F.col("__py"), site["site_x"], site["site_y"])
        return F.struct(d.alias("distance"), site["site_id"].alias("site_id"), site["site_x"].alias("site_x"),
                        site["site_y"].alias("site_y"), site["__sr"].alias("__sr"))

    near = F.filter(F.transform("__sites", measured), lambda c: (c["distance"] <= c["__sr"]) & (c["distance"] <= F.lit(size)))
    return joined.withColumn("__near", _first_k(near, k)).drop("__cx", "__cy", "__sites")


def _top_k(found: DataFrame, k: int) -> DataFrame:
    """The k nearest per point id (rank 1..k, no rank for k = 1) from rows of up to k near sites each."""
    rows = found.select("point_id", F.explode("__near").alias("__b"))
    if k == 1:
        rows = rows.groupBy("point_id").agg(F.min("__b").alias("__b"))
        return rows.select("point_id", "__b.site_id", "__b.site_x", "__b.site_y", "__b.distance")
    from pyspark.sql import Window

    w = Window.partitionBy("point_id").orderBy("distance", "site_id")
    return (
        rows.select("point_id", "__b.site_id", "__b.site_x", "__b.site_y", "__b.distance")
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
    )


def nearest_within(
    points: DataFrame,
    sites: DataFrame,
    radius: float,
    *,
    point_id: str = "id",
    point_x: str = "x",
    point_y: str = "y",
    site_id: str = "site_id",
    site_x: str = "site_x",
    site_y: str = "site_y",
    site_radius: str | None = None,
    k: int = 1,
    max_candidates: int | None = DEFAULT_MAX_CANDIDATES,
    target_sites_per_cell: int = 64,
) -> DataFrame:
    """For every point, the ``k`` nearest sites within the radius.

    Grid join instead of a theta join: both sides get the cell
    ``floor(coord / radius)``; every site is copied to its 3 x 3 neighbour
    cells; an equi-join on the cell then the exact distance filter give the
    same pairs as the cross join, with no nested loop.  ``radius`` is the cell
    size and must be >= every per-site radius when ``site_radius`` names a
    column (a site then counts only within its own radius).  Ties are broken
    by site id.  The sites of a cell are lists of bounded length, and a point
    picks its k nearest of a list inside its row, so no task holds or sorts
    the pairs: what is shuffled is k sites per point and list.  k = 1 then
    ends in an aggregation (min of (distance, site)), k > 1 in a
    ``rank <= k`` filter.  Output: point_id, site_id, site_x, site_y, distance
    (+ rank when k > 1).

    Dense cells: one small job over the sites only counts the sites of every
    3 x 3 neighbourhood, i.e. the candidates a point of that cell would meet.
    While no neighbourhood holds more than ``max_candidates`` sites the plain
    grid join is used.  Points of denser cells are resolved on finer grids
    first (cell c = r / 2^L, finest first): every site outside the point's
    3 x 3 fine cells is farther than c, so once k qualifying sites lie within
    c of the point they are exactly its k nearest.  Dense points therefore
    meet only the few sites of their fine neighbourhood; points left
    unresolved move to the next coarser grid, and the coarse grid handles the
    rest.  Each level's points are checkpointed with what they found (lineage
    cut, survives lost executors).
    """
    cell = float(radius)
    p = points.select(
        F.col(point_id).alias("point_id"),
        F.col(point_x).cast("double").alias("__px"),
        F.col(point_y).cast("double").alias("__py"),
    )
    s = sites.select(
        F.col(site_id).alias("site_id"),
        F.col(site_x).cast("double").alias("site_x"),
        F.col(site_y).cast("double").alias("site_y"),
        (F.col(site_radius).cast("double") if site_radius else F.lit(cell)).alias("__sr"),
    )
    if site_radius:
        s = s.withColumn("__sr", F.when(F.col("__sr") > F.lit(cell), F.raise_error(F.lit(
            f"a site's radius is larger than radius={cell:g}"))).otherwise(F.col("__sr")))
    raw_sites = s
    # Sites at the same position (and radius): only the k smallest ids can
    # win, so at most k per position are kept (a pile of co-located sites
    # cannot multiply the candidate pairs).
    if k == 1:
        s = s.groupBy("site_x", "site_y", "__sr").agg(F.min("site_id").alias("site_id"))
    else:
        from pyspark.sql import Window

        wl = Window.partitionBy("site_x", "site_y", "__sr").orderBy("site_id")
        s = s.withColumn("__n", F.row_number().over(wl)).where(F.col("__n") <= k).drop("__n")
    s = s.select("site_id", "site_x", "site_y", "__sr")

    def coarse(pts: DataFrame) -> DataFrame:
        return _nearest_listed(pts, s, cell, k).select("point_id", "__copies", "__near")

    def result(found: DataFrame) -> DataFrame:
        if k > 1:  # a repeated row counts as often as it is there
            found = found.select("point_id", F.explode(F.array_repeat("__near", F.least("__copies", F.lit(k)).cast("int"))).alias("__near"))
        return _top_k(found, k)

    # Alike points are worked out once; the grouping also deals points to all
    # tasks, however few files hold them.
    p = p.groupBy("point_id", "__px", "__py").agg(F.count(F.lit(1)).alias("__copies"))

    if not max_candidates:
        return result(coarse(p))

    # Candidates per point <= sites (before the co-location cut) in the 3 x 3
    # cells around its cell: one small job over the sites decides the plan.
    n_nb = _spread(raw_sites, cell).groupBy("__cx", "__cy").agg(F.count(F.lit(1)).alias("__ns"))
    densest = n_nb.agg(F.max("__ns")).first()[0]
    if densest is None or densest <= max_candidates:
        return result(coarse(p))
    hot = n_nb.where(F.col("__ns") > F.lit(max_candidates)).select("__cx", "__cy", "__ns")

    from roadloom.session import checkpoint_dir

    checkpoint_dir(points.sparkSession)
    located = _cells(p, "__px", "__py", cell)
    in_hot = located.join(hot.select("__cx", "__cy"), ["__cx", "__cy"], "left_semi").drop("__cx", "__cy")
    cold = located.join(hot.select("__cx", "__cy"), ["__cx", "__cy"], "left_anti").drop("__cx", "__cy")
    # Depth from the data: halve the cell until no fine 3 x 3 neighbourhood of
    # the sites near hot cells holds more than ~9 x target sites (small jobs
    # over those sites only; a packed corner needs more levels than the
    # coarse count suggests).
    near_hot = _spread(s, cell).join(hot.select("__cx", "__cy"), ["__cx", "__cy"], "left_semi") \
        .select("site_id", "site_x", "site_y", "__sr").distinct()
    levels = 1
    while levels < 40:
        fine = _spread(near_hot, cell / (2 ** levels)).groupBy("__cx", "__cy").agg(F.count(F.lit(1)).alias("__n"))
        if (fine.agg(F.max("__n")).first()[0] or 0) <= 9 * target_sites_per_cell:
            break
        levels += 1
    unresolved = in_hot
    out = coarse(cold)
    for level in range(levels, 0, -1):
        near = _nearest_listed(unresolved, s, cell / (2 ** level), k, "left")
        near = near.groupBy("point_id", "__px", "__py", "__copies").agg(F.flatten(F.collect_list("__near")).alias("__near"))
        # resolved only with k qualifying sites within one fine cell
        near = near.withColumn("__near", _first_k(F.col("__near"), k)).checkpoint(eager=True)
        out = out.unionByName(near.where(F.size("__near") >= k).select("point_id", "__copies", "__near"))
        unresolved = near.where(F.size("__near") < k).drop("__near")
        if unresolved.isEmpty():
            break
    return result(out.unionByName(coarse(unresolved)))


def fence_predicate(lat: str | Column, lon: str | Column, box: dict[str, float]) -> Column:
    """Strictly inside the box (points on an edge are outside)."""
    la, lo = col(lat), col(lon)
    return (
        (la < F.lit(float(box["north"])))
        & (la > F.lit(float(box["south"])))
        & (lo > F.lit(float(box["west"])))
        & (lo < F.lit(float(box["east"])))
    )


def geo_fence(
    df: DataFrame,
    *,
    latitude: str = "latitude",
    longitude: str = "longitude",
    box: dict[str, float] | None = None,
    mode: str = "inside",
    drop_nulls: str | None = "any",
) -> DataFrame:
    """Keep points inside (``mode="inside"``) or outside the box.

    ``drop_nulls="any"`` first drops rows with any NULL (the reference's
    ``dropna``); ``"coords"`` only rows without coordinates; ``None`` keeps
    them (they then match neither mode).
    """
    box = box or BARCELONA_BOX
    if drop_nulls == "any":
        df = df.na.drop("any")
    elif drop_nulls == "coords":
        df = df.na.drop("any", subset=[latitude, longitude])
    inside = fence_predicate(latitude, longitude, box)
    if mode == "inside":
        return df.where(inside)
    if mode == "outside":
        return df.where(~inside)
    raise ValueError("mode must be 'inside' or 'outside'")


def fence_zone(
    df: DataFrame,
    *,
    latitude: str = "latitude",
    longitude: str = "longitude",
    box: dict[str, float] | None = None,
    zone_col: str = "zone",
) -> DataFrame:
    """Both modes in one pass: rows with coordinates get ``inside``/``outside``."""
    box = box or BARCELONA_BOX
    has = F.col(latitude).isNotNull() & F.col(longitude).isNotNull()
    return df.where(has).withColumn(
        zone_col, F.when(fence_predicate(latitude, longitude, box), F.lit("inside")).otherwise(F.lit("outside"))
    )
