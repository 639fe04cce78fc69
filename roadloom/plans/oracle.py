"""DuckDB SQL equal in meaning to each contract query (correctness oracle).

Written independently of the Spark code: plain joins, GROUP BY and window
functions over the pre-registered views.  Casts pin the result types to the
Spark ones (DuckDB widens SUM of integers and EXTRACT to BIGINT/HUGEINT).
"""

ORACLE_SQL: dict[str, str] = {}



def _frac(n: str, m: str, digits: int = 2) -> str:
    """Exact half-up ROUND(n / m, digits) for non-negative integer counts."""
    scale = 10 ** digits
    return (f"CAST(((({n}) * {2 * scale} + ({m})) // (2 * ({m}))) AS DOUBLE) "
            f"/ CAST({scale} AS DOUBLE)")


ORACLE_SQL["booking_stats"] = f"""
SELECT o.o_custkey AS vehicle_id, c.c_mktsegment AS vehicle_type,
       COUNT(o.o_orderkey) AS total_bookings,
       ROUND(SUM(o.o_totalprice), 6) AS total_duration,
       ROUND(SUM(o.o_totalprice), 6) / CAST(COUNT(o.o_totalprice) AS DOUBLE) AS avg_duration,
       MIN(o.o_orderdate) AS earliest_booking,
       MAX(o.o_orderdate) AS latest_booking,
       COUNT(*) FILTER (WHERE o.o_orderstatus = 'F') AS total_cancelled_bookings,
       {_frac("COUNT(*) FILTER (WHERE o.o_orderstatus = 'F') * 100", "COUNT(o.o_orderkey)")} AS cancellation_rate
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'AUTOMOBILE'
GROUP BY o.o_custkey, c.c_mktsegment
"""

_CUSTOMER_SELECT = """
SELECT c.c_custkey AS user_id, c.c_name AS name, c.c_mktsegment AS segment,
       c.c_acctbal AS balance, n.n_name AS nation, n.n_regionkey AS region_key
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

ORACLE_SQL["user_profiles_join"] = _CUSTOMER_SELECT

ORACLE_SQL["customers_full"] = f"""
WITH live AS ({_CUSTOMER_SELECT} WHERE c.c_acctbal >= 0),
     gone AS ({_CUSTOMER_SELECT} WHERE c.c_acctbal < 0),
     allc AS (SELECT * FROM live UNION ALL SELECT * FROM gone)
SELECT allc.*,
       COALESCE(allc.user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0), false) AS deleted_user
FROM allc
"""

_ROLLUP = """
SELECT user_id, month, year, event_type,
       ROUND(SUM(value), 6) AS event_amount_sum,
       COUNT(DISTINCT ts) AS distinct_event_dates,
       ROUND(SUM(value), 6) / CAST(COUNT(value) AS DOUBLE) AS event_amount_avg,
       CAST(GROUPING(user_id, month, year, event_type) AS BIGINT) AS grouping_id
FROM (SELECT user_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month,
             CAST(date_trunc('year', ts) AS TIMESTAMP) AS year, event_type, value, ts
      FROM events) e
GROUP BY ROLLUP (user_id, month, year, event_type)
"""
ORACLE_SQL["event_rollup"] = _ROLLUP

_NET = """
SELECT user_id,
       ROUND(SUM(CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END), 6)
         - ROUND(SUM(CASE WHEN event_type = 'error' THEN value ELSE CAST(0 AS DOUBLE) END), 6) AS net_purchases,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
       COUNT(*) FILTER (WHERE event_type = 'error') AS total_refunds
FROM events GROUP BY user_id
"""
ORACLE_SQL["net_purchases"] = _NET

ORACLE_SQL["customer_activity_union"] = f"""
WITH u AS (SELECT * FROM ({_ROLLUP}) UNION ALL BY NAME SELECT * FROM ({_NET}))
SELECT u.*,
       COALESCE(u.user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0), false) AS deleted_user
FROM u
"""

ORACLE_SQL["parking_occupancy"] = f"""
WITH g AS (
  SELECT l_suppkey AS area_id,
         COUNT(*) FILTER (WHERE l_returnflag = 'A') AS occupied_spaces,
         COUNT(*) FILTER (WHERE l_returnflag = 'N') AS available_spaces,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS reserved_spaces,
         COUNT(*) AS total_spaces
  FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_shipdate <= TIMESTAMP '1999-01-01 00:00:00'
  GROUP BY l_suppkey)
SELECT *, {_frac("occupied_spaces", "total_spaces")} AS occupancy_rate,
          {_frac("available_spaces + reserved_spaces", "total_spaces")} AS availability_rate
FROM g
"""

ORACLE_SQL["event_sequence"] = """
SELECT user_id, ts, event_id, event_type, value, props,
       CAST(month(ts) AS INTEGER) AS event_month, CAST(year(ts) AS INTEGER) AS event_year,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_num
FROM events
"""

ORACLE_SQL["event_first"] = """
SELECT user_id, event_type, ts AS event_date, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1
"""

ORACLE_SQL["event_gaps_days"] = """
SELECT user_id, event_type, ts AS event_date, event_id,
       lag(ts) OVER w AS prev_event_date,
       CAST(date_diff('day', lag(ts) OVER w, ts) AS INTEGER) AS days_since_prev_event
FROM events
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
"""

ORACLE_SQL["monthly_event_profile"] = r"""
WITH s AS (
  SELECT user_id, ts, event_type,
         CAST(NULLIF(regexp_extract(props, '"k"\s*:\s*(-?[0-9]+)', 1), '') AS INTEGER) AS loc,
         epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap
  FROM events)
SELECT user_id, CAST(month(ts) AS INTEGER) AS event_month, CAST(year(ts) AS INTEGER) AS event_year,
       COUNT(*) AS total_events,
       COUNT(DISTINCT loc) AS unique_locations,
       COUNT(*) FILTER (WHERE event_type = 'error') AS maintenance_events,
       CAST(SUM(gap) AS DOUBLE) / CAST(COUNT(gap) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS avg_time_between_events
FROM s
GROUP BY user_id, CAST(month(ts) AS INTEGER), CAST(year(ts) AS INTEGER)
"""

ORACLE_SQL["warranty_status"] = """
WITH b AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CAST(o.o_orderdate AS DATE) AS purchase_date,
         CAST(l.l_shipdate AS DATE) AS warranty_expiration_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
c AS (
  SELECT *,
         CAST(date_diff('day', purchase_date, warranty_expiration_date) AS INTEGER) AS warranty_duration,
         ROUND(CAST(date_diff('day', purchase_date, DATE '1999-01-01') AS DOUBLE) / CAST(365.25 AS DOUBLE), 2)
           + CAST(0 AS DOUBLE) AS age_in_years,
         CASE WHEN purchase_date IS NULL OR warranty_expiration_date IS NULL THEN 'N/A'
              WHEN DATE '1999-01-01' > warranty_expiration_date THEN 'out of warranty'
              ELSE 'in warranty' END AS warranty_status
  FROM b)
SELECT *, COUNT(*) OVER (PARTITION BY warranty_status) AS total_by_warranty_status FROM c
"""

_FIRST_LAST = """
WITH r AS (
  SELECT user_id, ts, event_id, value, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn_a,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn_d
  FROM events {where})
SELECT s.user_id,
       s.ts AS start_ts, s.event_id AS start_event_id, s.value AS start_value{start_extra},
       e.ts AS end_ts, e.event_id AS end_event_id, e.value AS end_value{end_extra}
FROM (SELECT * FROM r WHERE rn_a = 1) s JOIN (SELECT * FROM r WHERE rn_d = 1) e ON s.user_id = e.user_id
"""

ORACLE_SQL["trip_first_last"] = _FIRST_LAST.format(
    where="", start_extra=", s.event_type AS start_event_type", end_extra=", e.event_type AS end_event_type")

ORACLE_SQL["trip_summary"] = f"""
SELECT fl.*, c.c_name, c.c_mktsegment, c.c_acctbal
FROM ({_FIRST_LAST.format(where="WHERE ts > TIMESTAMP '2024-01-10 00:00:00'", start_extra="", end_extra="")}) fl
JOIN customer c ON fl.user_id = c.c_custkey
"""

ORACLE_SQL["distance_by_year"] = """
SELECT l_suppkey AS vehicle_id, CAST(year(l_shipdate) AS INTEGER) AS year,
       SUM(l_quantity) * CAST(0.621371 AS DOUBLE) AS distance_traveled
FROM lineitem
WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL
GROUP BY l_suppkey, CAST(year(l_shipdate) AS INTEGER)
"""

ORACLE_SQL["customer_enrichment"] = """
SELECT c.c_custkey AS user_id, c.c_name AS name,
       ROUND(SUM(o.o_totalprice), 6) AS lifetime_value,
       MAX(o.o_orderdate) AS last_purchase_date,
       COUNT(o.o_orderkey) AS purchase_count
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_name
"""

ORACLE_SQL["vehicle_routes"] = """
WITH r AS (
  SELECT l_suppkey, l_quantity, l_discount, l_extendedprice,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn_a,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn_d
  FROM lineitem)
SELECT l_suppkey AS vehicle_id,
       COUNT(*) AS route_points,
       MAX(CASE WHEN rn_a = 1 THEN l_quantity END) AS first_latitude,
       MAX(CASE WHEN rn_a = 1 THEN l_discount END) AS first_longitude,
       MAX(CASE WHEN rn_d = 1 THEN l_quantity END) AS last_latitude,
       MAX(CASE WHEN rn_d = 1 THEN l_discount END) AS last_longitude,
       ROUND(SUM(l_extendedprice), 6) / CAST(COUNT(l_extendedprice) AS DOUBLE) AS average_speed
FROM r GROUP BY l_suppkey
"""

ORACLE_SQL["dedupe_latest"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1
"""


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


_SHAPES = """
SELECT p_partkey AS id, p_name, p_partkey % 3 = 0 AS tri,
       CAST(p_partkey % 100 AS BIGINT) AS x0, CAST(p_size AS BIGINT) AS y0,
       CAST(p_size % 7 + 1 AS BIGINT) AS w, CAST(p_partkey % 5 + 1 AS BIGINT) AS h
FROM part
"""

_FEATURES = f"""
SELECT id, 'POLYGON' AS geom_type,
       CASE WHEN tri THEN {_d('3 * x0 + w')} / {_d(3)} ELSE {_d('2 * x0 + w')} / {_d(2)} END AS centroid_x,
       CASE WHEN tri THEN {_d('3 * y0 + h')} / {_d(3)} ELSE {_d('2 * y0 + h')} / {_d(2)} END AS centroid_y,
       CASE WHEN tri THEN {_d('w * h')} / {_d(2)} ELSE {_d('w * h')} END AS area,
       CASE WHEN tri THEN ({_d('w')} + sqrt({_d('w * w + h * h')})) + {_d('h')} ELSE {_d('2 * (w + h)')} END AS perimeter,
       {_d(0)} AS length, p_name
FROM ({_SHAPES}) s
"""
ORACLE_SQL["geometry_features"] = _FEATURES

ORACLE_SQL["geometry_groups"] = f"""
SELECT f.*, COUNT(*) OVER (PARTITION BY centroid_x, centroid_y, area, perimeter) AS count
FROM ({_FEATURES}) f
"""

ORACLE_SQL["within_radius"] = f"""
SELECT id, location_x, location_y, distance FROM (
  SELECT id, location_x, location_y, radius,
         sqrt((px - location_x) * (px - location_x) + (py - location_y) * (py - location_y)) AS distance
  FROM (SELECT c_custkey AS id, {_d('c_custkey % 100')} AS location_x, {_d('(c_custkey * 7) % 100')} AS location_y,
               {_d('c_nationkey * 4')} AS px, {_d('(c_custkey % 13) * 7')} AS py,
               {_d('20 + (c_custkey % 5) * 10')} AS radius FROM customer) t) u
WHERE distance <= radius
"""

ORACLE_SQL["nearest_site"] = f"""
WITH p AS (SELECT c_custkey AS point_id, {_d('(c_custkey * 7919) % 1000')} AS px,
                  {_d('(c_custkey * 104729) % 1000')} AS py FROM customer),
     s AS (SELECT s_suppkey AS site_id, {_d('(s_suppkey * 3571) % 1000')} AS site_x,
                  {_d('(s_suppkey * 7247) % 1000')} AS site_y FROM supplier),
     d AS (SELECT point_id, site_id, site_x, site_y,
                  sqrt((site_x - px) * (site_x - px) + (site_y - py) * (site_y - py)) AS distance
           FROM p CROSS JOIN s),
     r AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY distance, site_id) AS rn
           FROM d WHERE distance <= {_d(60)})
SELECT point_id, site_id, site_x, site_y, distance FROM r WHERE rn = 1
"""

_GPS_PARTS = """
SELECT c_custkey AS id,
       CAST((c_custkey * 37) % 90 AS VARCHAR) AS latd, CAST((c_custkey * 11) % 60 AS VARCHAR) AS latm,
       CAST((c_custkey * 13) % 60 AS VARCHAR) AS lats, lpad(CAST((c_custkey * 17) % 1000 AS VARCHAR), 3, '0') AS latf,
       CAST((c_custkey * 53) % 180 AS VARCHAR) AS lond, CAST((c_custkey * 7) % 60 AS VARCHAR) AS lonm,
       CAST((c_custkey * 19) % 60 AS VARCHAR) AS lons, lpad(CAST((c_custkey * 23) % 1000 AS VARCHAR), 3, '0') AS lonf,
       CASE WHEN c_custkey % 2 = 0 THEN 'N' ELSE 'S' END AS hlat,
       CASE WHEN c_custkey % 4 < 2 THEN 'E' ELSE 'W' END AS hlon
FROM customer
"""

ORACLE_SQL["gps_normalize"] = f"""
WITH b AS (SELECT *, id % 6 AS fmt FROM ({_GPS_PARTS}) g),
t AS (
  SELECT id, fmt, hlat, hlon,
    CASE fmt
      WHEN 0 THEN (CASE WHEN hlat = 'S' THEN '-' ELSE '' END) || latd || '.' || latf || ','
                  || (CASE WHEN hlon = 'W' THEN '-' ELSE '' END) || lond || '.' || lonf
      WHEN 1 THEN latd || '.' || latf || ' ' || hlat || ', ' || lond || '.' || lonf || ' ' || hlon
      WHEN 2 THEN latd || '°' || latm || '''' || lats || '.' || latf || '"' || hlat || ', '
                  || lond || '°' || lonm || '''' || lons || '.' || lonf || '"' || hlon
      WHEN 3 THEN latd || '° ' || latm || ''' ' || lats || '.' || latf || ''''' ' || hlat || ', '
                  || lond || '° ' || lonm || ''' ' || lons || '.' || lonf || ''''' ' || hlon
      WHEN 4 THEN latd || '° ' || latm || '.' || latf || ''' ' || hlat || ', '
                  || lond || '° ' || lonm || '.' || lonf || ''' ' || hlon
      ELSE latd || 'degrees ' || latm || 'minutes ' || lats || 'seconds ' || hlat || ', '
           || lond || 'degrees ' || lonm || 'minutes ' || lons || 'seconds ' || hlon
    END AS gps_coordinates,
    CASE WHEN fmt IN (0, 1) THEN {_d("latd || '.' || latf")}
         WHEN fmt IN (2, 3) THEN ({_d('latd')} + {_d('latm')} / {_d(60)}) + {_d("lats || '.' || latf")} / {_d(3600)}
         WHEN fmt = 4 THEN {_d('latd')} + {_d("latm || '.' || latf")} / {_d(60)}
         ELSE ({_d('latd')} + {_d('latm')} / {_d(60)}) + {_d('lats')} / {_d(3600)} END AS lat_abs,
    CASE WHEN fmt IN (0, 1) THEN {_d("lond || '.' || lonf")}
         WHEN fmt IN (2, 3) THEN ({_d('lond')} + {_d('lonm')} / {_d(60)}) + {_d("lons || '.' || lonf")} / {_d(3600)}
         WHEN fmt = 4 THEN {_d('lond')} + {_d("lonm || '.' || lonf")} / {_d(60)}
         ELSE ({_d('lond')} + {_d('lonm')} / {_d(60)}) + {_d('lons')} / {_d(3600)} END AS lon_abs
  FROM b)
SELECT id, gps_coordinates,
       CASE WHEN hlat = 'S' THEN -lat_abs ELSE lat_abs END AS latitude,
       CASE WHEN hlon = 'W' THEN -lon_abs ELSE lon_abs END AS longitude,
       CASE fmt WHEN 0 THEN 'decimal' WHEN 1 THEN 'hemisphere' WHEN 2 THEN 'dms' WHEN 3 THEN 'dms'
                WHEN 4 THEN 'dm' ELSE 'worded' END AS gps_format
FROM t
"""

ORACLE_SQL["gps_validate"] = """
SELECT gps_reason, COUNT(*) AS n_rows FROM (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN 'null'
              WHEN c_custkey % 13 = 0 THEN 'bad_format'
              WHEN c_custkey % 17 = 0 THEN 'out_of_range'
              WHEN c_custkey % 4 = 3 THEN 'bad_format'
              ELSE 'accepted' END AS gps_reason
  FROM customer) r
GROUP BY gps_reason
"""

ORACLE_SQL["geo_fence"] = f"""
SELECT id, latitude, longitude,
       CASE WHEN latitude < {_d(41.5)} AND latitude > {_d(41.2)} AND longitude > {_d(2.0)} AND longitude < {_d(2.2)}
            THEN 'inside' ELSE 'outside' END AS zone
FROM (SELECT c_custkey AS id,
             CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE {_d('4110 + c_custkey % 50')} / {_d(100)} END AS latitude,
             {_d('190 + (c_custkey * 7) % 40')} / {_d(100)} AS longitude
      FROM customer) p
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
"""

ORACLE_SQL["flatten_contacts"] = """
SELECT c_custkey AS user_id, c_name AS name, c_custkey % 60 + 18 AS age,
       CAST(c_custkey % 999 + 1 AS VARCHAR) || ' Main St, '
         || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' CA '
         || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS address,
       '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone_home,
       CASE WHEN c_custkey % 4 = 0 THEN NULL
            ELSE '555-' || lpad(CAST((c_custkey * 7) % 10000 AS VARCHAR), 4, '0') END AS phone_work,
       lower(replace(c_name, '#', '.')) || '@example.com' AS email,
       c_acctbal >= 0 AS is_active,
       CAST('2022-' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '-'
            || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 12:00:00' AS TIMESTAMP) AS created_at
FROM customer
"""

ORACLE_SQL["geojson_features"] = f"""
SELECT c_custkey AS id, 'C' || CAST(c_custkey AS VARCHAR) AS vehicle_id, c_name AS name,
       c_custkey % 120 AS speed, 'Point' AS geometry_type,
       {_d('c_custkey % 1440')} / {_d(4)} - {_d(180)} AS longitude,
       {_d('c_custkey % 720')} / {_d(8)} - {_d(45)} AS latitude
FROM customer
"""

ORACLE_SQL["metadata_reconcile"] = """
SELECT lang, source, COUNT(*) AS n_docs,
       CAST(SUM(n_chars) AS BIGINT) AS stated_n_chars,
       CAST(SUM(length(text)) AS BIGINT) AS actual_n_chars,
       SUM(n_chars) = SUM(length(text)) AS consistent
FROM documents GROUP BY lang, source
"""

ORACLE_SQL["null_report"] = """
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE d.doc_id IS NOT NULL AND d.text IS NOT NULL AND d.lang IS NOT NULL
                        AND d.source IS NOT NULL AND d.n_chars IS NOT NULL
                        AND l.quality IS NOT NULL AND l.toxic IS NOT NULL) AS clean_rows,
       COUNT(*) FILTER (WHERE d.doc_id IS NULL) AS null_doc_id,
       COUNT(*) FILTER (WHERE d.text IS NULL) AS null_text,
       COUNT(*) FILTER (WHERE d.lang IS NULL) AS null_lang,
       COUNT(*) FILTER (WHERE d.source IS NULL) AS null_source,
       COUNT(*) FILTER (WHERE d.n_chars IS NULL) AS null_n_chars,
       COUNT(*) FILTER (WHERE l.quality IS NULL) AS null_quality,
       COUNT(*) FILTER (WHERE l.toxic IS NULL) AS null_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

ORACLE_SQL["delta_new_rows"] = """
SELECT * FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00')
"""

ORACLE_SQL["delta_upsert"] = """
WITH snap AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
recent AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01 00:00:00'),
feed AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice,
         o_orderdate + INTERVAL 1 DAY AS o_orderdate, o_orderpriority FROM recent
  UNION ALL
  SELECT o_orderkey, o_custkey, 'O' AS o_orderstatus, o_totalprice,
         o_orderdate + INTERVAL 2 DAY AS o_orderdate, o_orderpriority
  FROM recent WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
latest AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS rn FROM feed) f
  WHERE rn = 1)
SELECT * FROM snap WHERE NOT EXISTS (SELECT 1 FROM latest WHERE latest.o_orderkey = snap.o_orderkey)
UNION ALL
SELECT * FROM latest
"""

ORACLE_SQL["key_set_changes"] = """
WITH o AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
     n AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00')
SELECT o_orderkey, 'added' AS change FROM (SELECT o_orderkey FROM n EXCEPT SELECT o_orderkey FROM o) a
UNION ALL
SELECT o_orderkey, 'removed' AS change FROM (SELECT o_orderkey FROM o EXCEPT SELECT o_orderkey FROM n) r
"""

# The delta merges equal a computation over the full history.
ORACLE_SQL["trips_delta_merge"] = f"""
SELECT fl.*, c.c_name, c.c_mktsegment, c.c_acctbal
FROM ({_FIRST_LAST.format(where="", start_extra="", end_extra="")}) fl
JOIN customer c ON fl.user_id = c.c_custkey
"""

_OCCUPANCY = ORACLE_SQL["parking_occupancy"]
_LATER = (_OCCUPANCY.replace("1999-01-01 00:00:00", "1999-01-03 00:00:00").replace("1998-01-01 00:00:00", "1999-01-02 00:00:00"))
ORACLE_SQL["parking_delta_upsert"] = f"""
SELECT * FROM ({_LATER}) b
UNION ALL
SELECT * FROM ({_OCCUPANCY}) a WHERE area_id NOT IN (SELECT area_id FROM ({_LATER}) l)
"""

ORACLE_SQL["event_profile_delta_upsert"] = ORACLE_SQL["monthly_event_profile"]
ORACLE_SQL["warranty_delta_upsert"] = ORACLE_SQL["warranty_status"]

ORACLE_SQL["route_points"] = """
SELECT l_suppkey AS vehicle_id, l_shipdate, l_orderkey, l_linenumber, l_quantity, l_discount,
       row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS point_index
FROM lineitem
"""

ORACLE_SQL["fleet_pipeline_rejects"] = """
SELECT c_custkey AS vehicle_id,
       CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'not a position' ELSE '95.125,10.250' END AS gps_coordinates,
       CASE WHEN c_custkey % 11 = 0 THEN 'null' WHEN c_custkey % 13 = 0 THEN 'bad_format' ELSE 'out_of_range' END AS gps_reason
FROM customer
WHERE c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0
"""

ORACLE_SQL["trips_late_merge"] = ORACLE_SQL["trips_delta_merge"]

ORACLE_SQL["event_first_null_times"] = """
SELECT user_id, event_type, ts, event_id, value FROM (
  SELECT user_id, event_type, t AS ts, event_id, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY t ASC NULLS LAST, event_id) AS rn
  FROM (SELECT *, CASE WHEN event_id % 3 > 0 THEN ts END AS t FROM events) e) r
WHERE rn = 1
"""

# Shapes are of one class by construction of their keys.
ORACLE_SQL["geometry_groups_lonlat"] = """
SELECT p_partkey AS id, 'POLYGON' AS geom_type, COUNT(*) OVER (PARTITION BY p_partkey % 60) AS count FROM part
"""

ORACLE_SQL["event_rollup_delta"] = _ROLLUP

ORACLE_SQL["nearest_sites_own_radius"] = f"""
WITH p AS (SELECT c_custkey AS point_id, {_d('(c_custkey * 7919) % 1000')} AS px, {_d('(c_custkey * 104729) % 1000')} AS py FROM customer),
     s AS (SELECT s_suppkey AS site_id, {_d('(s_suppkey * 3571) % 1000')} AS site_x, {_d('(s_suppkey * 7247) % 1000')} AS site_y,
                  {_d('90 + (s_suppkey % 4) * 20')} AS r FROM supplier),
     d AS (SELECT point_id, site_id, site_x, site_y, r,
                  sqrt((site_x - px) * (site_x - px) + (site_y - py) * (site_y - py)) AS distance FROM p CROSS JOIN s),
     o AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY distance, site_id) AS rn FROM d WHERE distance <= r)
SELECT point_id, site_id, site_x, site_y, distance, CAST(rn AS INTEGER) AS rank FROM o WHERE rn <= 3
"""

ORACLE_SQL["within_radius_metres"] = """
WITH p AS (SELECT c_custkey AS id, CAST(2000000 + (c_custkey * 7919) % 200000 AS DOUBLE) / 1000000.0 AS x,
                  CAST(41300000 + (c_custkey * 104729) % 150000 AS DOUBLE) / 1000000.0 AS y,
                  CAST(4000 + (c_custkey % 5) * 1500 AS DOUBLE) AS r FROM customer),
     d AS (SELECT id, r, CAST(2 * 6371008.8 AS DOUBLE) * asin(least(1.0, sqrt(
                  pow(sin((radians(CAST(41.38 AS DOUBLE)) - radians(y)) / 2), 2)
                  + cos(radians(y)) * cos(radians(CAST(41.38 AS DOUBLE))) * pow(sin((radians(CAST(2.1 AS DOUBLE)) - radians(x)) / 2), 2)))) AS m FROM p)
SELECT id, round(m, 3) AS distance FROM d WHERE m <= r
"""
