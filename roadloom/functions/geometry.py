"""Planar geometry as column expressions (WKT text -> rings -> measures).

A geometry is ``array<array<struct<x: double, y: double>>>``: a list of rings
(polygon: outer ring then holes; linestring: one path; point: one vertex).
Measures use higher-order array functions (``transform``, ``zip_with``,
``aggregate``) so they run in the JVM.  They are written as Spark SQL
expressions: one parse per expression instead of hundreds of client calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _expr(sql: str) -> Column:
    return F.expr(" ".join(sql.split()))


MEASURED = ("POINT", "LINESTRING", "POLYGON")


def _no_srid(wkt: str) -> str:
    """SQL of the text without the ``SRID=n;`` prefix of EWKT."""
    return rf"regexp_replace({_q(wkt)}, r'^\s*SRID\s*=\s*\d+\s*;', '')"


def geometry_type(wkt: str) -> Column:
    """Upper-case WKT type name (POINT, LINESTRING, POLYGON; others have no measures)."""
    return _expr(rf"upper(regexp_extract({_no_srid(wkt)}, r'^\s*([A-Za-z]+)', 1))")


def parse_wkt(wkt: str) -> Column:
    """WKT POINT / LINESTRING / POLYGON (with holes) to rings of (x, y)."""
    w = _no_srid(wkt)
    body = rf"regexp_extract({w}, r'\((.*)\)', 1)"
    return _expr(rf"""
        transform(
          CASE WHEN upper(regexp_extract({w}, r'^\s*([A-Za-z]+)', 1)) = 'POLYGON'
               THEN regexp_extract_all({body}, r'\(([^()]*)\)', 1)
               ELSE array({body}) END,
          r -> transform(split(trim(r), r'\s*,\s*'),
                         p -> named_struct('x', try_cast(get(split(trim(p), r'\s+'), 0) AS DOUBLE),
                                           'y', try_cast(get(split(trim(p), r'\s+'), 1) AS DOUBLE))))""")


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``value`` worked out once under ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _normal_ring(ring: str) -> str:
    """SQL of a closed ring that starts at its smallest vertex and runs counter-clockwise.

    Of all ways to write the ring from a smallest vertex the smallest is taken first, so what follows sees the same
    vertices in the same order, whichever of them the text began with and whichever way it ran.
    """
    def turns(path: str) -> str:
        return _let("m", f"array_min({path})", f"""transform(filter(sequence(0, size({path}) - 1), i -> get({path}, i) <=> m),
            i -> concat(slice({path}, i + 1, size({path})), slice({path}, 1, i)))""")

    area = f"""{_let('o', 'get(w, 0)', f"{_sum(_segments('w', '((p.x - o.x) * (q.y - o.y) - (q.x - o.x) * (p.y - o.y))'))}")}"""
    least = f"array_min(concat({turns('v')}, {_let('b', 'reverse(v)', turns('b'))}))"
    chosen = _let("w", least, f"if({area} < 0, concat(slice(w, 1, 1), reverse(slice(w, 2, size(w)))), w)")
    normal = _let("v", f"slice({ring}, 1, size({ring}) - 1)", _let("c", chosen, "concat(c, slice(c, 1, 1))"))
    return f"CASE WHEN size({ring}) < 3 OR NOT (get({ring}, 0) <=> get({ring}, size({ring}) - 1)) THEN {ring} ELSE {normal} END"


def normal_form(rings: str, gtype: str, decimals: int | None = None) -> Column:
    """Rings in a form that is the same for equal shapes: winding, first vertex, order of holes, direction of a path.

    With ``decimals`` coordinates are fixed-point numbers of that many digits, so that texts which differ by rounding
    noise are equal too.  Measures of the normal form are bit for bit equal for equal shapes.
    """
    r, g = _q(rings), _q(gtype)
    if decimals is not None:
        r = f"transform({r}, r -> transform(r, v -> named_struct('x', round(v.x, {decimals}), 'y', round(v.y, {decimals}))))"
    holes = f"sort_array(transform(slice(a, 2, size(a)), h -> {_normal_ring('h')}))"
    polygon = f"concat(transform(slice(a, 1, 1), h -> {_normal_ring('h')}), {holes})"
    path = "transform(a, p -> array_min(array(p, reverse(p))))"
    return _expr(_let("a", r, f"CASE WHEN {g} = 'POLYGON' THEN {polygon} WHEN {g} = 'LINESTRING' THEN {path} ELSE a END"))


def _segments(ring: str, body: str) -> str:
    """zip_with over consecutive vertex pairs (p, q) of ``ring``."""
    return f"zip_with(slice({ring}, 1, size({ring}) - 1), slice({ring}, 2, size({ring}) - 1), (p, q) -> {body})"


def _sum(arr: str) -> str:
    return f"aggregate({arr}, 0D, (acc, v) -> acc + v)"


_CROSS = "(p.x * q.y - q.x * p.y)"
_SEG_LEN = "sqrt((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y))"


def ring_stats(rings: str) -> Column:
    """Per ring, oriented so the outer ring counts positive and holes negative
    whatever their winding: twice the area, six times the first moments, length.

    Sums run from the geometry's first vertex as the origin: on small shapes far from (0, 0), such as
    longitudes and latitudes, products of raw coordinates would cancel to noise.
    """
    origin = f"get(get({_q(rings)}, 0), 0)"
    local = f"transform({_q(rings)}, r -> transform(r, v -> named_struct('x', v.x - {origin}.x, 'y', v.y - {origin}.y)))"
    near = f"""transform({local}, ring -> named_struct(
        'a2', {_sum(_segments('ring', _CROSS))},
        'mx6', {_sum(_segments('ring', f'(p.x + q.x) * {_CROSS}'))},
        'my6', {_sum(_segments('ring', f'(p.y + q.y) * {_CROSS}'))},
        'len', {_sum(_segments('ring', _SEG_LEN))}))"""
    raw = f"""transform({near}, s -> named_struct(
        'a2', s.a2, 'mx6', s.mx6 + 3 * s.a2 * {origin}.x, 'my6', s.my6 + 3 * s.a2 * {origin}.y, 'len', s.len))"""
    sign = "CASE WHEN i = 0 THEN signum(s.a2) ELSE -signum(s.a2) END"
    return _expr(f"""transform({raw}, (s, i) -> named_struct(
        'a2', s.a2 * {sign}, 'mx6', s.mx6 * {sign}, 'my6', s.my6 * {sign}, 'len', s.len))""")


def ring_totals(stats: str) -> Column:
    """Sums over the rings of ``ring_stats``: struct(a2, mx6, my6, len)."""
    s = _q(stats)
    parts = ", ".join(f"'{f}', {_sum(f'transform({s}, r -> r.{f})')}" for f in ("a2", "mx6", "my6", "len"))
    return _expr(f"named_struct({parts})")


def path_moments(rings: str) -> Column:
    """For the first ring read as a path: length-weighted midpoint sums."""
    path = f"get({_q(rings)}, 0)"
    return _expr(f"""named_struct(
        'lx', {_sum(_segments(path, f'{_SEG_LEN} * (p.x + q.x) / 2'))},
        'ly', {_sum(_segments(path, f'{_SEG_LEN} * (p.y + q.y) / 2'))},
        'first', get({path}, 0))""")


def measures_from(totals: str, moments: str, gtype: str) -> Column:
    """struct(area, perimeter, length, centroid_x, centroid_y).

    Polygon: area = sum / 2, centroid = moment sum / (3 * twice-area sum),
    perimeter = all ring lengths; ``length`` is 0 as for ST_Length.
    Linestring: length, centroid = length-weighted segment midpoints.
    Point: the point itself.  Any other type: NULL measures.  With integer vertices every sum is exact and the
    centroid is one division, so the result is the correctly rounded value.
    """
    t, m, g = _q(totals), _q(moments), _q(gtype)
    known = ", ".join(f"'{k}'" for k in MEASURED)
    return _expr(f"""CASE WHEN {g} IN ({known}) THEN named_struct(
        'area', CASE WHEN {g} = 'POLYGON' THEN abs({t}.a2) / 2 ELSE 0D END,
        'perimeter', CASE WHEN {g} IN ('POLYGON', 'LINESTRING') THEN {t}.len ELSE 0D END,
        'length', CASE WHEN {g} = 'LINESTRING' THEN {t}.len ELSE 0D END,
        'centroid_x', CASE WHEN {g} = 'POLYGON' THEN try_divide({t}.mx6, {t}.a2 * 3)
                           WHEN {g} = 'LINESTRING' THEN try_divide({m}.lx, {t}.len)
                           ELSE {m}.first.x END,
        'centroid_y', CASE WHEN {g} = 'POLYGON' THEN try_divide({t}.my6, {t}.a2 * 3)
                           WHEN {g} = 'LINESTRING' THEN try_divide({m}.ly, {t}.len)
                           ELSE {m}.first.y END) END""")


def point(x: str | Column, y: str | Column) -> Column:
    """ST_MakePoint(x, y) as struct(x, y)."""
    cx = F.col(x) if isinstance(x, str) else x
    cy = F.col(y) if isinstance(y, str) else y
    return F.struct(cx.cast("double").alias("x"), cy.cast("double").alias("y"))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Planar distance sqrt(dx^2 + dy^2)."""
    dx = bx - ax
    dy = by - ay
    return F.sqrt(dx * dx + dy * dy)


# Fixed value: mean Earth radius in metres (IUGG), for the haversine option.
EARTH_RADIUS_M = 6_371_008.8


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between two (lat, lon) in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp = p2 - p1
    dl = F.radians(lon2) - F.radians(lon1)
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))
