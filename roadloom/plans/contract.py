"""Bindings of every operator to the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  The
mobility tables of the reference do not exist here, so operators are bound by
column names to TPC-H-like tables.  Float aggregates use ``FLOAT_SCALE`` so the
value is independent of the order of additions (same value in every engine).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators import (
    bookings,
    customers,
    events,
    geo,
    gps,
    incremental,
    nested,
    parking,
    quality,
    trips,
    vehicles,
)
from roadloom.session import apply_sql_defaults, holding, worked_out_once
from roadloom.sources import read_table

FLOAT_SCALE = 6

# Output name -> user ("u") or profile ("p") column, for the customer joins.
CUSTOMER_COLUMNS = {
    "user_id": "u.c_custkey",
    "name": "u.c_name",
    "segment": "u.c_mktsegment",
    "balance": "u.c_acctbal",
    "nation": "p.n_name",
    "region_key": "p.n_regionkey",
}



def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, name, sf_dir)


def booking_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are bookings, customers are vehicles."""
    return bookings.booking_stats(
        _t(spark, sf_dir, "orders"),
        _t(spark, sf_dir, "customer"),
        vehicle_type="AUTOMOBILE",
        booking_id="o_orderkey",
        vehicle_id="o_custkey",
        vehicles_key="c_custkey",
        type_col="c_mktsegment",
        duration="o_totalprice",
        start_time="o_orderdate",
        end_time="o_orderdate",
        is_cancelled=F.col("o_orderstatus") == F.lit("F"),
        float_scale=FLOAT_SCALE,
    ).withColumnsRenamed({"o_custkey": "vehicle_id", "c_mktsegment": "vehicle_type"})


def user_profiles_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are users, nations their profiles."""
    return customers.user_profiles_join(
        _t(spark, sf_dir, "customer"),
        _t(spark, sf_dir, "nation"),
        user_key="c_nationkey",
        profile_key="n_nationkey",
        columns=CUSTOMER_COLUMNS,
    )


def customers_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live users (balance >= 0) and deleted users (< 0)."""
    cust = _t(spark, sf_dir, "customer")
    nation = _t(spark, sf_dir, "nation")
    live = cust.where(F.col("c_acctbal") >= 0)
    gone = cust.where(F.col("c_acctbal") < 0)
    return customers.customers_full(
        live, nation, gone, nation,
        user_key="c_nationkey", profile_key="n_nationkey",
        identity_key="c_custkey", out_key="user_id", columns=CUSTOMER_COLUMNS,
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events")


def event_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 A4 F1."""
    return events.event_rollup(
        _events(spark, sf_dir), user="user_id", ts="ts", event_type="event_type",
        amount="value", float_scale=FLOAT_SCALE,
    )


def event_rollup_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 A5 D-1: the state of the events up to the mark, extended by those after it."""
    ev = _events(spark, sf_dir)
    late = F.col("ts") > F.lit("2024-01-20").cast("timestamp_ntz")
    names = {"user": "user_id", "ts": "ts", "event_type": "event_type", "amount": "value"}
    state = events.rollup_state(ev.where(~late | late.isNull()), **names)
    return events.rollup_rows(events.rollup_extended(state, ev, ev.where(late), **names), float_scale=FLOAT_SCALE)


def net_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 F9 A2 (the data has no 'refund' type; 'error' plays it)."""
    return events.net_purchases(
        _events(spark, sf_dir), user="user_id", event_type="event_type", amount="value",
        purchase="purchase", refund="error", float_scale=FLOAT_SCALE,
    )


def customer_activity_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollup rows and net rows, null-filled, flagged deleted."""
    gone = _t(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    return customers.customer_activity_union(
        event_rollup(spark, sf_dir), net_purchases(spark, sf_dir),
        deleted_users=gone, key="user_id", deleted_key="c_custkey",
    )


def parking_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are areas, return flags A/N/R the statuses."""
    return parking.parking_occupancy(
        _t(spark, sf_dir, "lineitem"), "1999-01-01 00:00:00",
        lookback=dt.timedelta(days=365), closed="both",
        area="l_suppkey", status="l_returnflag", ts="l_shipdate",
        occupied="A", available="N", reserved="R",
    ).withColumnRenamed("l_suppkey", "area_id")


def event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 F2."""
    return events.event_sequence(
        _events(spark, sf_dir), key="user_id", ts="ts", tiebreak="event_id",
        columns=["event_type", "value", "props"],
    )


def event_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 P7."""
    return events.event_first(
        _events(spark, sf_dir), keys=["user_id", "event_type"], ts="ts", tiebreak="event_id",
        columns=["value"],
    ).withColumnRenamed("ts", "event_date")


def event_gaps_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 W5 F3."""
    return events.event_gaps_days(
        _events(spark, sf_dir), keys=["user_id", "event_type"], ts="ts", tiebreak="event_id",
    ).withColumnRenamed("ts", "event_date")


def monthly_event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users are vehicles, 'error' is maintenance, props.k the location."""
    ev = _events(spark, sf_dir)
    return events.monthly_event_profile(
        ev, vehicle="user_id", ts="ts", tiebreak="event_id", event_type="event_type",
        location=F.from_json("props", "k INT").getField("k"), maintenance="error",
    )


def warranty_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order date is the purchase, ship date the expiry."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    return vehicles.warranty_status(
        items, "1999-01-01", ids=["l_orderkey", "l_linenumber"],
        purchase_date="o_orderdate", expiry_date="l_shipdate",
    )


def trip_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events are the points of one trip."""
    return trips.trip_first_last(
        _events(spark, sf_dir), trip="user_id", ts="ts", tiebreak="event_id",
        columns=["value", "event_type"],
    )


def trip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points after the mark, first/last joined to trip facts (customers)."""
    facts = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return trips.trip_summary(
        _events(spark, sf_dir), facts, since="2024-01-10 00:00:00",
        trip="user_id", trips_key="c_custkey", ts="ts", tiebreak="event_id", columns=["value"],
    )


def distance_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier x ship year, quantity as kilometres."""
    li = _t(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("vehicle_id"),
        F.year("l_shipdate").alias("year"),
        F.col("l_quantity").alias("distance_traveled"),
    )
    return trips.distance_by_year(li, vehicle="vehicle_id", year="year", distance="distance_traveled")


def customer_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifetime value and last purchase per customer."""
    cust = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")
    )
    return customers.customer_enrichment(
        cust, _t(spark, sf_dir, "orders"), customer_key="user_id", purchase_key="o_custkey",
        amount="o_totalprice", purchased_at="o_orderdate", float_scale=FLOAT_SCALE,
    )


def vehicle_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are vehicles, their line items the route points."""
    return trips.vehicle_routes(
        _t(spark, sf_dir, "lineitem"), vehicle="l_suppkey", ts="l_shipdate",
        tiebreak=["l_orderkey", "l_linenumber"], latitude="l_quantity", longitude="l_discount",
        speed="l_extendedprice", float_scale=FLOAT_SCALE,
    ).withColumnRenamed("l_suppkey", "vehicle_id")


def route_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered route as rows, one per line item of a supplier."""
    return trips.route_points(
        _t(spark, sf_dir, "lineitem"), vehicle="l_suppkey", ts="l_shipdate", tiebreak=["l_orderkey", "l_linenumber"],
        latitude="l_quantity", longitude="l_discount",
    ).withColumnRenamed("l_suppkey", "vehicle_id")


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per (user, type)."""
    return events.dedupe_latest(
        _events(spark, sf_dir), ["user_id", "event_type"], ts="ts", tiebreak="event_id",
    )


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as planar shapes: a right triangle for every third key, else a
    rectangle; corner (key % 100, size), width size % 7 + 1, height key % 5 + 1."""
    part = _t(spark, sf_dir, "part")
    k, sz = F.col("p_partkey"), F.col("p_size")
    x0, y0 = (k % 100).cast("string"), sz.cast("string")
    x1, y1 = (k % 100 + sz % 7 + 1).cast("string"), (sz + k % 5 + 1).cast("string")
    pt = lambda x, y: F.concat_ws(" ", x, y)
    rect = F.concat(F.lit("POLYGON(("), F.concat_ws(", ", pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0)), F.lit("))"))
    tri = F.concat(F.lit("POLYGON(("), F.concat_ws(", ", pt(x0, y0), pt(x1, y0), pt(x0, y1), pt(x0, y0)), F.lit("))"))
    return part.select(
        F.col("p_partkey").alias("id"),
        F.when(k % 3 == 0, tri).otherwise(rect).alias("geometry"),
        F.col("p_name"),
    )


def geometry_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F22 F23."""
    return geo.geometry_features(_shapes(spark, sf_dir), id_col="id", wkt="geometry", properties=["p_name"])


def geometry_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 J4."""
    return geo.geometry_groups(geometry_features(spark, sf_dir))


#: Classes of the shapes of `_lonlat_shapes`.
LONLAT_CLASSES = 60


def _lonlat_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as shapes on longitude and latitude: a rectangle per class, some with a hole, written from any of its
    vertices, either way round, with or without noise beyond the seventh digit."""
    k = F.col("p_partkey")
    c, start, back, noise = k % LONLAT_CLASSES, (k % 7) % 4, (k % 11) % 2 == 0, (k % 13) % 2 == 0

    def degrees(micro):
        text = F.concat((micro / 1_000_000).cast("int").cast("string"), F.lit("."), F.lpad((micro % 1_000_000).cast("string"), 6, "0"))
        return F.concat(text, F.when(noise, F.lit("0004")).otherwise(F.lit("")))

    def ring(x0, y0, w, h):
        corners = F.array(*[F.concat_ws(" ", degrees(x), degrees(y)) for x, y in ((x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0, y0 + h))])
        turned = F.concat(F.slice(corners, start + 1, 4), F.slice(corners, 1, start))
        turned = F.when(back, F.reverse(turned)).otherwise(turned)
        return F.concat(F.lit("("), F.concat_ws(", ", F.concat(turned, F.slice(turned, 1, 1))), F.lit(")"))

    x0, y0, w, h = F.lit(2_100_000) + c * 1_117, F.lit(41_380_000) + (c * 7) % 13 * 1_003, (c % 9 + 3) * 30, (c % 5 + 2) * 40
    outer, hole = ring(x0, y0, w, h), ring(x0 + 10, y0 + 10, (c % 4 + 1) * 5, F.lit(15))
    rings = F.when(c % 3 == 0, F.concat_ws(", ", outer, hole)).otherwise(outer)
    return _t(spark, sf_dir, "part").select(k.alias("id"), F.concat(F.lit("POLYGON("), rings, F.lit(")")).alias("geometry"))


def geometry_groups_lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal shapes on longitude and latitude group, however they are written."""
    features = geo.geometry_features(_lonlat_shapes(spark, sf_dir), id_col="id", wkt="geometry", properties=[], decimals=7)
    groups = geo.geometry_groups(features)
    return holding(groups.select("id", "geom_type", "count"), groups)


def within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer has a location, its own reference point and radius."""
    c = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    plane = c.select(
        k.alias("id"),
        (k % 100).cast("double").alias("location_x"),
        ((k * 7) % 100).cast("double").alias("location_y"),
        (F.col("c_nationkey") * 4).cast("double").alias("longitude"),
        ((k % 13) * 7).cast("double").alias("latitude"),
        (F.lit(20) + (k % 5) * 10).cast("double").alias("radius"),
    )
    return geo.within_radius(plane, radius="radius", keep=["id", "location_x", "location_y"])


def nearest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest supplier within 60 units of each customer."""
    k = F.col("c_custkey")
    s = F.col("s_suppkey")
    points = _t(spark, sf_dir, "customer").select(
        k.alias("id"), ((k * 7919) % 1000).cast("double").alias("x"), ((k * 104729) % 1000).cast("double").alias("y")
    )
    sites = _t(spark, sf_dir, "supplier").select(
        s.alias("site_id"), ((s * 3571) % 1000).cast("double").alias("site_x"),
        ((s * 7247) % 1000).cast("double").alias("site_y"),
    )
    return geo.nearest_within(points, sites, 60.0)


def nearest_sites_own_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest suppliers of each customer, each within the supplier's own radius."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    points = _t(spark, sf_dir, "customer").select(
        k.alias("id"), ((k * 7919) % 1000).cast("double").alias("x"), ((k * 104729) % 1000).cast("double").alias("y"))
    sites = _t(spark, sf_dir, "supplier").select(
        s.alias("site_id"), ((s * 3571) % 1000).cast("double").alias("site_x"), ((s * 7247) % 1000).cast("double").alias("site_y"),
        (F.lit(90) + (s % 4) * 20).cast("double").alias("site_radius"))
    return geo.nearest_within(points, sites, 150.0, site_radius="site_radius", k=3)


def within_radius_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers on longitude and latitude, within metres of their own reference point."""
    k = F.col("c_custkey")
    places = _t(spark, sf_dir, "customer").select(
        k.alias("id"),
        ((F.lit(2_000_000) + (k * 7919) % 200_000) / 1_000_000.0).alias("location_x"),
        ((F.lit(41_300_000) + (k * 104729) % 150_000) / 1_000_000.0).alias("location_y"),
        F.lit(2.1).alias("longitude"), F.lit(41.38).alias("latitude"), (F.lit(4000) + (k % 5) * 1500).cast("double").alias("radius"))
    near = geo.within_radius(places, radius="radius", keep=["id"], metres=True)
    return near.withColumn("distance", F.round("distance", 3))


def _gps_parts(k):
    """Integer parts of a synthetic position derived from key ``k``."""
    lpad3 = lambda c: F.lpad(c.cast("string"), 3, "0")
    return {
        "latd": ((k * 37) % 90).cast("string"), "latm": ((k * 11) % 60).cast("string"),
        "lats": ((k * 13) % 60).cast("string"), "latf": lpad3((k * 17) % 1000),
        "lond": ((k * 53) % 180).cast("string"), "lonm": ((k * 7) % 60).cast("string"),
        "lons": ((k * 19) % 60).cast("string"), "lonf": lpad3((k * 23) % 1000),
        "hlat": F.when(k % 2 == 0, F.lit("N")).otherwise(F.lit("S")),
        "hlon": F.when(k % 4 < 2, F.lit("E")).otherwise(F.lit("W")),
    }


def _gps_text(k, fmt):
    p = _gps_parts(k)
    cat = F.concat
    latdec = cat(p["latd"], F.lit("."), p["latf"])
    londec = cat(p["lond"], F.lit("."), p["lonf"])
    sgn = lambda h, neg: F.when(h == F.lit(neg), F.lit("-")).otherwise(F.lit(""))
    texts = {
        0: cat(sgn(p["hlat"], "S"), latdec, F.lit(","), sgn(p["hlon"], "W"), londec),
        1: cat(latdec, F.lit(" "), p["hlat"], F.lit(", "), londec, F.lit(" "), p["hlon"]),
        2: cat(p["latd"], F.lit("°"), p["latm"], F.lit("'"), p["lats"], F.lit("."), p["latf"], F.lit('"'), p["hlat"],
               F.lit(", "), p["lond"], F.lit("°"), p["lonm"], F.lit("'"), p["lons"], F.lit("."), p["lonf"], F.lit('"'), p["hlon"]),
        3: cat(p["latd"], F.lit("° "), p["latm"], F.lit("' "), p["lats"], F.lit("."), p["latf"], F.lit("'' "), p["hlat"],
               F.lit(", "), p["lond"], F.lit("° "), p["lonm"], F.lit("' "), p["lons"], F.lit("."), p["lonf"], F.lit("'' "), p["hlon"]),
        4: cat(p["latd"], F.lit("° "), p["latm"], F.lit("."), p["latf"], F.lit("' "), p["hlat"],
               F.lit(", "), p["lond"], F.lit("° "), p["lonm"], F.lit("."), p["lonf"], F.lit("' "), p["hlon"]),
        5: cat(p["latd"], F.lit("degrees "), p["latm"], F.lit("minutes "), p["lats"], F.lit("seconds "), p["hlat"],
               F.lit(", "), p["lond"], F.lit("degrees "), p["lonm"], F.lit("minutes "), p["lons"], F.lit("seconds "), p["hlon"]),
        # decimal with hemispheres and a trailing minutes/seconds suffix
        6: cat(latdec, F.lit(" "), p["hlat"], F.lit(", "), londec, F.lit(" "), p["hlon"], F.lit(" "),
               p["latm"], F.lit(".5' "), p["lats"], F.lit('.25"')),
    }
    out = F.lit(None).cast("string")
    for i in sorted(texts, reverse=True):
        out = F.when(fmt == i, texts[i]).otherwise(out)
    return out


def gps_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six notations built from the customer key."""
    k = F.col("c_custkey")
    raw = _t(spark, sf_dir, "customer").select(k.alias("id"), _gps_text(k, k % 6).alias("gps_coordinates"))
    return gps.normalize_gps(raw, "gps_coordinates").drop("gps_reason")


def gps_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted / rejected rows per reason, with junk rows."""
    k = F.col("c_custkey")
    fmt = F.when(k % 4 == 3, F.lit(2)).when(k % 4 == 2, F.lit(6)).otherwise(k % 4)
    text = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit("not a position"))
        .when(k % 17 == 0, F.concat(F.lit("95."), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(",10.250")))
        .otherwise(_gps_text(k, fmt))
    )
    raw = _t(spark, sf_dir, "customer").select(k.alias("id"), text.alias("gps_coordinates"))
    checked = gps.validate_gps(raw, "gps_coordinates")
    return checked.groupBy("gps_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def fleet_pipeline_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks in all accepted notations, with the ones left out for their position."""
    k = F.col("c_custkey")
    text = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit("not a position"))
        .when(k % 17 == 0, F.lit("95.125,10.250"))
        .otherwise(_gps_text(k, k % 7))
    )
    tracks = _t(spark, sf_dir, "customer").select(k.alias("vehicle_id"), text.alias("gps_coordinates"))
    return trips.fleet_rejects(tracks)


def geo_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers placed around the city box, NULL positions dropped."""
    k = F.col("c_custkey")
    pts = _t(spark, sf_dir, "customer").select(
        k.alias("id"),
        F.when(k % 23 == 0, F.lit(None).cast("double"))
        .otherwise((F.lit(4110) + k % 50).cast("double") / F.lit(100.0)).alias("latitude"),
        ((F.lit(190) + (k * 7) % 40).cast("double") / F.lit(100.0)).alias("longitude"),
    )
    return geo.fence_zone(pts.na.drop("any"))


def _raw_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw nested contact records (struct address, typed phone array)."""
    c = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    phone = lambda t, n: F.struct(F.lit(t).alias("type"), F.concat(F.lit("555-"), F.lpad(n.cast("string"), 4, "0")).alias("number"))
    phones = F.when(k % 4 == 0, F.array(phone("home", k % 10000))).otherwise(
        F.array(phone("home", k % 10000), phone("work", (k * 7) % 10000)))
    two = lambda c_: F.lpad(c_.cast("string"), 2, "0")
    return c.select(
        k.alias("id"),
        F.col("c_name").alias("name"),
        (k % 60 + 18).alias("age"),
        F.struct(
            F.concat((k % 999 + 1).cast("string"), F.lit(" Main St")).alias("street"),
            F.initcap(F.col("c_mktsegment")).alias("city"),
            F.lit("CA").alias("state"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip"),
        ).alias("address"),
        phones.alias("phoneNumbers"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        (F.col("c_acctbal") >= 0).alias("isActive"),
        F.concat(F.lit("2022-"), two(k % 12 + 1), F.lit("-"), two(k % 28 + 1), F.lit("T12:00:00Z")).alias("createdAt"),
    )


def flatten_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records built then flattened back."""
    return nested.flatten_contacts(_raw_contacts(spark, sf_dir))


def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON Feature text per customer, parsed with an explicit schema."""
    c = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lon = ((k % 1440).cast("double") / F.lit(4.0) - F.lit(180.0)).cast("string")
    lat = ((k % 720).cast("double") / F.lit(8.0) - F.lit(45.0)).cast("string")
    text = F.concat(
        F.lit('{"type": "Feature", "properties": {"vehicleId": "C'), k.cast("string"),
        F.lit('", "name": "'), F.col("c_name"), F.lit('", "speed": '), (k % 120).cast("string"),
        F.lit('}, "geometry": {"type": "Point", "coordinates": ['), lon, F.lit(", "), lat, F.lit("]}}"),
    )
    return nested.geojson_features(c.select(k.alias("id"), text.alias("feature_json")), "feature_json", keep=["id"])


def metadata_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated character counts vs the texts, per language and source."""
    docs = _t(spark, sf_dir, "documents")
    return quality.metadata_reconcile(
        docs, group_cols=["lang", "source"], stated="n_chars", actual=F.length("text").cast("long"),
        count_name="n_docs",
    )


def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents left join labels."""
    docs = _t(spark, sf_dir, "documents")
    labels = _t(spark, sf_dir, "labels")
    return quality.null_report_of_join(docs, labels, ["doc_id"], "left")


SNAPSHOT_CUT = "1999-01-01 00:00:00"


def delta_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-6 P6 A10: orders before the cut are the snapshot; rows past its mark."""
    orders = _t(spark, sf_dir, "orders")
    snapshot = orders.where(F.col("o_orderdate") < F.lit(SNAPSHOT_CUT).cast("timestamp_ntz"))
    mark = incremental.high_watermark(snapshot, "o_orderdate")
    return incremental.rows_after(orders, "o_orderdate", mark)


def _order_changes(orders: DataFrame) -> DataFrame:
    """A change feed: every order from 1998-07 re-sent closed a day later; orders
    of the overlap also re-sent open two days later (the newest must win)."""
    recent = orders.where(F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp_ntz"))
    v1 = recent.withColumns({"o_orderstatus": F.lit("F"), "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")})
    v2 = recent.where(F.col("o_orderdate") < F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")).withColumns(
        {"o_orderstatus": F.lit("O"), "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")})
    return v1.unionByName(v2)


def delta_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-1..D-6: snapshot upserted with the change feed, newest version wins."""
    orders = _t(spark, sf_dir, "orders")
    snapshot = orders.where(F.col("o_orderdate") < F.lit(SNAPSHOT_CUT).cast("timestamp_ntz"))
    return incremental.apply_delta(snapshot, _order_changes(orders), ["o_orderkey"], "o_orderdate", mode="upsert")


def trips_delta_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-6: summaries of the points up to the mark, brought up to date with those after it."""
    ev = _events(spark, sf_dir)
    facts = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    options = {"trip": "user_id", "trips_key": "c_custkey", "ts": "ts", "tiebreak": "event_id", "columns": ["value"]}
    stored = trips.trip_summary(ev.where(F.col("ts") <= F.lit("2024-01-10").cast("timestamp_ntz")), facts, **options)
    return trips.merge_trips(stored, ev, facts, "2024-01-10 00:00:00", **options)


def trips_late_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-6: batches of points and facts in an order that is not that of their times, one taken in twice.

    The last batch has the earliest points, a third of the trips get their facts late, and half of the facts come in an
    older version first.
    """
    ev = _events(spark, sf_dir)
    facts = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    options = {"trip": "user_id", "trips_key": "c_custkey", "ts": "ts", "tiebreak": "event_id", "columns": ["value"], "version": "version"}
    cut = lambda day: F.lit(day).cast("timestamp_ntz")
    newest = facts.withColumn("version", F.lit(2))
    older = facts.where("c_custkey % 2 = 0").withColumns({"c_acctbal": F.col("c_acctbal") - 1, "version": F.lit(1)})
    batches = [
        trips.trip_state(ev.where(F.col("ts") >= cut("2024-01-20")), older, **options),
        trips.trip_state(ev.where((F.col("ts") >= cut("2024-01-10")) & (F.col("ts") < cut("2024-01-20"))), newest.where("c_custkey % 3 > 0"), **options),
        trips.trip_state(ev.where((F.col("ts") < cut("2024-01-10")) | F.col("ts").isNull()), newest.where("c_custkey % 3 = 0"), **options),
    ]
    stored = trips.merge_states(batches[1], batches[0], trip="user_id")
    return trips.state_rows(trips.merge_states(stored, batches[2], batches[0], trip="user_id"), trip="user_id")


def event_first_null_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of a user and type where some events have no time; those sort last."""
    ev = _events(spark, sf_dir).withColumn("ts", F.when(F.col("event_id") % 3 > 0, F.col("ts")))
    return events.event_first(ev, keys=["user_id", "event_type"], ts="ts", tiebreak="event_id", columns=["value"])


def parking_delta_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-3: one year's occupancy, with the areas of the next quarter replaced."""
    def occupancy(as_of: str, days: int) -> DataFrame:
        return parking.parking_occupancy(
            _t(spark, sf_dir, "lineitem"), as_of, lookback=dt.timedelta(days=days), area="l_suppkey", status="l_returnflag",
            ts="l_shipdate", occupied="A", available="N", reserved="R", order=False).withColumnRenamed("l_suppkey", "area_id")

    return parking.merge_occupancy(occupancy("1999-01-01 00:00:00", 365), occupancy("1999-01-03 00:00:00", 1))


def event_profile_delta_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-4: profiles of the events up to the mark, with the vehicles of later events profiled again."""
    ev = _events(spark, sf_dir)
    options = {"vehicle": "user_id", "ts": "ts", "tiebreak": "event_id", "event_type": "event_type",
               "location": F.from_json("props", "k INT").getField("k"), "maintenance": "error"}
    mark = F.lit("2024-01-10").cast("timestamp_ntz")
    stored = events.monthly_event_profile(ev.where(F.col("ts") <= mark), **options)
    return events.merge_event_profile(stored, ev, ev.where(F.col("ts") > mark), **options)


def warranty_delta_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-2: dates of early orders, with those of later orders put in, as the report of the later day."""
    ids = ["l_orderkey", "l_linenumber"]
    li = _t(spark, sf_dir, "lineitem").select(*ids, "l_shipdate")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    items = worked_out_once(items.select(*ids, F.col("o_orderdate").cast("date").alias("purchase_date"),
                                         F.col("l_shipdate").cast("date").alias("warranty_expiration_date"), "o_orderdate"))
    late = F.col("o_orderdate") >= F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")
    merged = vehicles.merge_warranty(items.where(~late | late.isNull()), items.where(late), "1999-01-01", ids=ids)
    return holding(merged, items)


def key_set_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys added and removed between two overlapping slices."""
    orders = _t(spark, sf_dir, "orders")
    old = orders.where(F.col("o_orderdate") < F.lit(SNAPSHOT_CUT).cast("timestamp_ntz"))
    new = orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    return incremental.key_set_changes(old, new, ["o_orderkey"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "booking_stats": booking_stats,
    "user_profiles_join": user_profiles_join,
    "customers_full": customers_full,
    "event_rollup": event_rollup,
    "event_rollup_delta": event_rollup_delta,
    "net_purchases": net_purchases,
    "customer_activity_union": customer_activity_union,
    "parking_occupancy": parking_occupancy,
    "event_sequence": event_sequence,
    "event_first": event_first,
    "event_gaps_days": event_gaps_days,
    "monthly_event_profile": monthly_event_profile,
    "warranty_status": warranty_status,
    "trip_first_last": trip_first_last,
    "trip_summary": trip_summary,
    "distance_by_year": distance_by_year,
    "customer_enrichment": customer_enrichment,
    "vehicle_routes": vehicle_routes,
    "dedupe_latest": dedupe_latest,
    "geometry_features": geometry_features,
    "geometry_groups": geometry_groups,
    "geometry_groups_lonlat": geometry_groups_lonlat,
    "within_radius": within_radius,
    "nearest_site": nearest_site,
    "nearest_sites_own_radius": nearest_sites_own_radius,
    "within_radius_metres": within_radius_metres,
    "gps_normalize": gps_normalize,
    "gps_validate": gps_validate,
    "geo_fence": geo_fence,
    "flatten_contacts": flatten_contacts,
    "geojson_features": geojson_features,
    "metadata_reconcile": metadata_reconcile,
    "null_report": null_report,
    "delta_new_rows": delta_new_rows,
    "delta_upsert": delta_upsert,
    "route_points": route_points,
    "fleet_pipeline_rejects": fleet_pipeline_rejects,
    "trips_delta_merge": trips_delta_merge,
    "trips_late_merge": trips_late_merge,
    "event_first_null_times": event_first_null_times,
    "parking_delta_upsert": parking_delta_upsert,
    "event_profile_delta_upsert": event_profile_delta_upsert,
    "warranty_delta_upsert": warranty_delta_upsert,
    "key_set_changes": key_set_changes,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_sql_defaults(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {name: wrap(fn) for name, fn in QUERIES.items()}
