"""Common table expressions of the SQL counterparts, written without the library."""

from __future__ import annotations

ADMIN = """
reg AS (SELECT printf('%02d', r_regionkey + 11) AS code, r_name AS name FROM region),
nat AS (SELECT n_nationkey,
               printf('%02d', n_regionkey + 11) || '.' ||
               printf('%02d', n_nationkey + 1) AS code, n_name AS name
        FROM nation),
dis AS (SELECT c_custkey, c_acctbal, nat.code || '.' || printf('%07d', c_custkey) AS code,
               c_name AS name, nat.code AS regency
        FROM customer JOIN nat ON c_nationkey = n_nationkey),
vil AS (SELECT o_orderkey, o_orderstatus,
               dis.code || '.' || printf('%09d', o_orderkey) AS code,
               o_orderpriority AS name
        FROM orders JOIN dis ON o_custkey = c_custkey),
adm AS (
  SELECT code, name, 'province' AS level, code AS province_code, CAST(NULL AS VARCHAR) AS regency_code,
         CAST(NULL AS VARCHAR) AS district_code, CAST(NULL AS VARCHAR) AS village_code FROM reg
  UNION ALL
  SELECT code, name, 'regency', split_part(code, '.', 1), code, NULL, NULL FROM nat
  UNION ALL
  SELECT code, name, 'district', split_part(code, '.', 1), regency, code, NULL FROM dis
  UNION ALL
  SELECT code, name, 'village', split_part(code, '.', 1),
         split_part(code, '.', 1) || '.' || split_part(code, '.', 2),
         split_part(code, '.', 1) || '.' || split_part(code, '.', 2) || '.' || split_part(code, '.', 3),
         code FROM vil)
"""

BOUNDARIES = """
bnd AS (
  SELECT 'province' AS level, code, 'derived' AS boundary_source FROM reg
  UNION ALL
  SELECT 'regency', code, 'raw' FROM nat
  WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
  UNION ALL
  SELECT 'district', code, 'raw' FROM dis WHERE c_acctbal > 0
  UNION ALL
  SELECT 'district', code, 'derived' FROM dis WHERE c_acctbal > 9000
  UNION ALL
  SELECT 'village', code, 'raw' FROM vil WHERE o_orderstatus = 'F')
"""

LINES = """
lines AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS start_date, l_quantity AS area, l_discount AS ratio,
         nat.code AS regency, dis.code AS district
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nat ON s_nationkey = n_nationkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN dis ON o_custkey = c_custkey),
bri AS (
  SELECT start_date, 'province' AS level, split_part(regency, '.', 1) AS code, area, ratio FROM lines
  UNION ALL SELECT start_date, 'regency', regency, area, ratio FROM lines
  UNION ALL SELECT start_date, 'district', district, area, ratio FROM lines),
day AS (
  SELECT start_date AS event_date, level, code, count(*) AS unique_event_count,
         CAST(1 AS BIGINT) AS flood_days, sum(area) AS sum_intersection_area_km2,
         max(ratio) AS max_coverage_ratio
  FROM bri GROUP BY ALL),
mon AS (
  SELECT level, code, event_date[1:7] || '-01' AS month_start,
         CAST(sum(unique_event_count) AS BIGINT) AS unique_event_count,
         count(*) AS flood_days, sum(sum_intersection_area_km2) AS sum_intersection_area_km2,
         max(max_coverage_ratio) AS max_coverage_ratio
  FROM day GROUP BY ALL),
alltime AS (
  SELECT level, code, CAST(sum(unique_event_count) AS BIGINT) AS unique_event_count,
         CAST(sum(flood_days) AS BIGINT) AS flood_days,
         sum(sum_intersection_area_km2) AS sum_intersection_area_km2,
         max(max_coverage_ratio) AS max_coverage_ratio
  FROM mon GROUP BY ALL)
"""


def project_y(lat: str) -> str:
    """Equal-area ordinate in metres of a latitude expression."""
    e2 = "0.0066943799901413165"
    e = "0.08181919084262149"
    a_2k0 = "(6378137.0 / (2 * (cos(radians(30.0)) / sqrt(1 - 0.0066943799901413165 * 0.25))))"
    s = f"sin(radians({lat}))"
    return (
        f"({a_2k0} * (1 - {e2}) * ({s} / (1 - {e2} * {s} * {s}) "
        f"- (1 / (2 * {e})) * ln((1 - {e} * {s}) / (1 + {e} * {s}))))"
    )


def project_x(lon: str) -> str:
    """Equal-area abscissa in metres of a longitude expression."""
    k0 = "(cos(radians(30.0)) / sqrt(1 - 0.0066943799901413165 * 0.25))"
    return f"(radians({lon}) * 6378137.0 * {k0})"


SQUARES = """
sq AS (
  SELECT event_id AS row_id, 'u' || CAST(user_id AS VARCHAR) AS uuid,
         strftime(ts, '%Y-%m-%d') AS start_date,
         CASE WHEN event_type = 'click' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS end_date,
         100.0::DOUBLE + ((event_id * 7919) % 9000 + 500)::DOUBLE / 1000.0::DOUBLE AS lon,
         -5.0::DOUBLE + ((event_id * 104729) % 9000 + 500)::DOUBLE / 1000.0::DOUBLE AS lat,
         (0.01::DOUBLE + value / 5000.0::DOUBLE) * 100.0::DOUBLE / (
           SELECT s + (s % 37 = 0)::BIGINT FROM (SELECT greatest(100, ceil(sqrt(max(c_custkey) + 1)))::BIGINT AS s FROM customer)) AS half
  FROM events)
"""

TILES = """
tile AS (
  SELECT 'province' AS level, printf('%02d', r_regionkey + 11) AS code,
         r_regionkey * 2.0::DOUBLE + 100.0::DOUBLE AS xmin, -5.0::DOUBLE AS ymin,
         r_regionkey * 2.0::DOUBLE + 102.0::DOUBLE AS xmax, 5.0::DOUBLE AS ymax
  FROM region
  UNION ALL
  SELECT 'regency', code, (n_nationkey % 5) * 2.0::DOUBLE + 100.0::DOUBLE,
         (n_nationkey // 5) * 2.0::DOUBLE - 5.0::DOUBLE,
         (n_nationkey % 5) * 2.0::DOUBLE + 102.0::DOUBLE,
         (n_nationkey // 5) * 2.0::DOUBLE - 3.0::DOUBLE
  FROM nat
  UNION ALL
  SELECT 'district', code, slot % side * 10.0::DOUBLE / side + 100.0::DOUBLE,
         (slot // side) * 10.0::DOUBLE / side - 5.0::DOUBLE,
         (slot % side + 1) * 10.0::DOUBLE / side + 100.0::DOUBLE,
         (slot // side + 1) * 10.0::DOUBLE / side - 5.0::DOUBLE
  FROM (SELECT code, (c_custkey * 37) % (side * side) AS slot, side
        FROM dis, (SELECT s + (s % 37 = 0)::BIGINT AS side
                   FROM (SELECT greatest(100, ceil(sqrt(max(c_custkey) + 1)))::BIGINT AS s FROM customer))))
"""


def pairs() -> str:
    """Closed-form rectangle overlaps, the counterpart of the general overlap kernel.

    Each side is projected once; widths and heights of the shared rectangle are taken in
    the plane.
    """
    return f"""
psq AS (
  SELECT row_id, uuid, start_date, end_date, lon - half AS lon0, lon + half AS lon1, lat - half AS lat0, lat + half AS lat1,
         {project_x('lon - half')} AS x0, {project_x('lon + half')} AS x1,
         {project_y('(lat - half)')} AS y0, {project_y('(lat + half)')} AS y1
  FROM sq),
ptile AS (
  SELECT level, code, xmin, ymin, xmax, ymax,
         {project_x('xmin')} AS u0, {project_x('xmax')} AS u1,
         {project_y('ymin')} AS v0, {project_y('ymax')} AS v1
  FROM tile),
pairs AS (
  SELECT row_id, uuid, start_date, end_date, level, code,
         (x1 - x0) * (y1 - y0) / 1e6 AS footprint_area_km2,
         (u1 - u0) * (v1 - v0) / 1e6 AS unit_area_km2,
         (least(x1, u1) - greatest(x0, u0)) * (least(y1, v1) - greatest(y0, v0)) / 1e6 AS area
  FROM psq JOIN ptile ON x0 < u1 AND u0 < x1 AND y0 < v1 AND v0 < y1
  WHERE (least(x1, u1) - greatest(x0, u0)) * (least(y1, v1) - greatest(y0, v0)) > 1e-3)
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
