"""Geometry in and out, repair, dissolve, points and simplification."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import geo, wkb
from tidemark.operators import facts, geometry, overlap, thinning
from tidemark.plans import star
from tidemark.plans.catalog import sql
from tidemark.session import cut_lineage


def raw_footprints(spark, d):
    """Squares as a footprint source holds them, geometry in WKB."""
    return star.footprints(spark, d).select(
        "row_id", "uuid", "start_date", "end_date", wkb.encode_wkb("rings").alias("geometry")
    )


def decoded_footprints(spark, d):
    """The same decoded, as a footprint scan delivers them."""
    dec = raw_footprints(spark, d).withColumn("g", wkb.decode_wkb("geometry")).filter(~geo.is_empty(F.col("g.rings")))
    return dec.select(
        "row_id", "uuid", "start_date", "end_date", "g.*", geo.bounds(F.col("g.rings")).alias("extent")
    )


def wkb_roundtrip(spark, d):
    f = decoded_footprints(spark, d)
    return f.select(
        "row_id", "valid", F.size("edges").alias("edges"),
        F.round(geo.area_km2(F.col("rings")), 4).alias("area_km2"),
        F.round("extent.xmin", 6).alias("xmin"), F.round("extent.ymax", 6).alias("ymax"),
    )


def daily_facts_from_wkb(spark, d):
    """The whole build path: decode, repair, extent filter, overlap, day facts."""
    units = star.unit_shapes(spark, d)
    f = overlap.within_extent(decoded_footprints(spark, d), units)
    day = facts.daily_facts(overlap.overlap(f, star.unit_fragments(spark, d)))
    return day.withColumns(
        {
            "sum_intersection_area_km2": F.round("sum_intersection_area_km2", 4),
            "max_coverage_ratio": F.round("max_coverage_ratio", 5),
        }
    )


def repaired_bow_ties(spark, d):
    """Self-crossing rings keep their even-odd area."""
    x, y, h = F.col("lon"), F.col("lat"), F.col("half")
    ring = geo.single_ring(
        geo.point(x - h, y - h), geo.point(x + h, y + h), geo.point(x + h, y - h), geo.point(x - h, y + h),
        geo.point(x - h, y - h),
    )
    fixed = star.squares(spark, d).select("row_id", (y - h).alias("floor"), wkb.repair(ring).alias("g"))
    area = overlap.plane_area_km2(F.col("g.edges"), F.col("floor"))
    return fixed.select("row_id", "g.valid", F.round(area, 4).alias("area_km2"))


def _dissolved(spark, d):
    units = star.unit_shapes(spark, d).filter("level = 'district'")
    return geometry.dissolve(units.withColumn("target_code", F.substring_index("code", ".", 2)))


def dissolved_regencies(spark, d):
    out = _dissolved(spark, d)
    return out.select("target_code", F.round(geo.area_km2(F.col("rings")), 3).alias("area_km2"))


def _grouped_members(spark, d):
    """Events as six members a group: four overlapping squares, one of them drawn again, and a
    ring that crosses itself, all on whole thousandths."""
    k = F.col("event_id")
    g, m = F.floor(k / 6), k % 6
    drawn = F.when(m == 4, k - 1).otherwise(k)
    size = F.when(m == 5, 2).otherwise(1 + drawn * 31 % 7)
    west = 100000 + g % 900 * 10 + drawn * 7 % 5
    south = -4500 + F.floor(g / 900) % 900 * 10 + drawn * 11 % 5

    def at(i, j):
        return geo.point((west + i * size) / 1000, (south + j * size) / 1000)

    square = geo.single_ring(at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0))
    crossed = geo.single_ring(at(0, 1), at(2, 1), at(2, 2), at(1, 2), at(1, 0), at(0, 0), at(0, 1))
    rows = star.table(spark, d, "events").select(
        g.cast("long").alias("target_code"), F.when(m == 5, crossed).otherwise(square).alias("rings"), (m != 5).alias("valid")
    )
    return cut_lineage(rows)


def dissolved_overlaps(spark, d):
    """Area of unions whose members overlap, repeat and cross themselves."""
    found = geometry.dissolve(geometry.repaired(_grouped_members(spark, d)))
    area = F.aggregate("rings", F.lit(0.0), lambda s, r: s + geo.twice_ring_area(r["pts"]) / 2)
    checked = found.select("target_code", area.alias("area"), wkb.repair("rings").alias("g"))
    return checked.select("target_code", F.round("area", 9).alias("area"), "g.valid")


def rejected_units(spark, d):
    """Units whose members have no area or no closed outline."""
    c = star.tiles(spark, d).filter("level = 'district'")
    key = F.substring_index("code", ".", -1).cast("long")
    sides = geo.ring_edges(geo.box(F.col("xmin"), F.col("ymin"), F.when(key % 10 == 3, F.col("xmin")).otherwise(F.col("xmax")), F.col("ymax")))
    members = c.select(F.col("code").alias("target_code"), F.when(key % 10 == 7, F.slice(sides, 1, 3)).otherwise(sides).alias("edges"))
    return geometry.dissolve_with_rejects(members)[1].withColumnRenamed("target_code", "code")


def outline_edges(spark, d):
    """Border edges left per regency once shared borders of its tiles cancel."""
    units = star.unit_shapes(spark, d).filter("level = 'district'")
    members = units.withColumn("target_code", F.substring_index("code", ".", 2))
    return geometry.outline(members, "target_code").groupBy("target_code").agg(F.count(F.lit(1)).alias("edges"))


def sibling_overlaps(spark, d):
    """Tiles of one level never overlap, but every third district has a sibling half a tile east
    of it, which shares half of its tile and half of the next one."""
    units = star.unit_shapes(spark, d)
    t = star.tiles(spark, d).filter("level = 'district' AND CAST(substring_index(code, '.', -1) AS BIGINT) % 3 = 0")
    half = (F.col("xmax") - F.col("xmin")) / 2
    moved = t.select("level", F.concat("code", F.lit("x")).alias("code"), geo.box(F.col("xmin") + half, F.col("ymin"), F.col("xmax") + half, F.col("ymax")).alias("rings"))
    moved = moved.select("level", "code", "rings", geo.ring_edges(F.col("rings")).alias("edges"), geo.bounds(F.col("rings")).alias("extent"))
    s = geometry.sibling_overlaps(units.unionByName(moved))
    return s.groupBy("level").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.sum("intersection_area_km2"), 1).alias("shared_km2"))


def representative_points(spark, d):
    u = geometry.with_centroids(star.unit_shapes(spark, d))
    return u.select(
        "level", "code", F.round("centroid_lat", 6).alias("centroid_lat"), F.round("centroid_lng", 6).alias("centroid_lng")
    )


def simplified_tiles(spark, d):
    """Tiles with points added along their sides lose them again."""
    a, b, c, e = (F.col(n) for n in ("xmin", "ymin", "xmax", "ymax"))
    mx, my = (a + c) / 2, (b + e) / 2
    ring = geo.single_ring(
        geo.point(a, b), geo.point(mx, b), geo.point(c, b), geo.point(c, my), geo.point(c, e),
        geo.point(mx, e), geo.point(a, e), geo.point(a, my), geo.point(a, b),
    )
    t = thinning.simplify(star.tiles(spark, d).select("level", "code", ring.alias("rings")), 0.001)
    return t.select(
        "level", "code", F.size(F.col("rings")[0]["pts"]).alias("points"),
        F.round(geo.area_km2(F.col("rings")), 3).alias("area_km2"),
    )


def boundary_stats(spark, d):
    s = geometry.dataset_stats(star.unit_shapes(spark, d), "level")
    return s.select("level", *(F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")), "geometry_types")


def coordinate_paths(spark, d):
    """Coordinate text in lat/lng order and either nesting, to lng/lat rings."""

    def pair(y, x):
        return F.format_string("[%s,%s]", y.cast("string"), x.cast("string"))

    a, b, c, e = (F.col(n) for n in ("xmin", "ymin", "xmax", "ymax"))
    ring = F.concat(F.lit("["), F.concat_ws(",", pair(b, a), pair(b, c), pair(e, c), pair(e, a), pair(b, a)), F.lit("]"))
    flat = F.concat(F.lit("["), ring, F.lit("]"))
    path = F.when(F.col("level") == "district", flat).otherwise(F.concat(F.lit("["), flat, F.lit("]")))
    t = star.tiles(spark, d).select("level", "code", geo.orient(geo.coordinates_to_rings(path)).alias("rings"))
    ext = geo.bounds(F.col("rings"))
    return t.select("level", "code", ext.alias("b"), F.size("rings").alias("rings")).select(
        "level", "code", "rings", *(F.round(f"b.{n}", 6).alias(n) for n in ("xmin", "ymin", "xmax", "ymax"))
    )


def geojson_features(spark, d):
    """Features read back from their text."""
    from tidemark.sinks.writers import geojson_feature

    u = star.unit_shapes(spark, d).withColumn("boundary_source", F.lit("raw"))
    text = u.select("code", geojson_feature(u.columns).alias("feature"))
    back = F.from_json(
        "feature",
        "struct<type string, properties struct<code string, level string, boundary_source string>, "
        "geometry struct<type string, coordinates array<array<array<array<double>>>>>>",
    )
    return text.select(back.alias("f")).select(
        F.col("f.type").alias("type"), "f.properties.*", F.col("f.geometry.type").alias("geometry_type"),
        F.size(F.col("f.geometry.coordinates")[0][0]).alias("points"),
        F.round(F.col("f.geometry.coordinates")[0][0][0][0], 6).alias("first_x"),
        F.round(F.col("f.geometry.coordinates")[0][0][0][1], 6).alias("first_y"),
    )


QUERIES = {
    "wkb_roundtrip": wkb_roundtrip,
    "daily_facts_from_wkb": daily_facts_from_wkb,
    "repaired_bow_ties": repaired_bow_ties,
    "dissolved_regencies": dissolved_regencies,
    "dissolved_overlaps": dissolved_overlaps,
    "rejected_units": rejected_units,
    "outline_edges": outline_edges,
    "sibling_overlaps": sibling_overlaps,
    "representative_points": representative_points,
    "simplified_tiles": simplified_tiles,
    "boundary_stats": boundary_stats,
    "coordinate_paths": coordinate_paths,
    "geojson_features": geojson_features,
}

_TILES = sql.with_(sql.ADMIN, sql.TILES)
_TILE_AREA = (
    f"({sql.project_x('xmax')} - {sql.project_x('xmin')}) * "
    f"({sql.project_y('ymax')} - {sql.project_y('ymin')}) / 1e6"
)

ORACLES = {
    "wkb_roundtrip": sql.with_(sql.SQUARES)
    + f"""
SELECT row_id, true AS valid, 4 AS edges,
       round(2 * {sql.project_x('half')} * ({sql.project_y('(lat + half)')} - {sql.project_y('(lat - half)')}) / 1e6, 4)
         AS area_km2, round(lon - half, 6) AS xmin, round(lat + half, 6) AS ymax FROM sq""",
    "daily_facts_from_wkb": sql.with_(sql.ADMIN, sql.SQUARES, sql.TILES, sql.pairs())
    + """
, ext AS (SELECT min(xmin) AS a, min(ymin) AS b, max(xmax) AS c, max(ymax) AS d FROM tile WHERE level = 'district')
SELECT start_date AS event_date, level, code, count(*) AS unique_event_count,
       CAST(1 AS BIGINT) AS flood_days, round(sum(area), 4) AS sum_intersection_area_km2,
       round(max(area / unit_area_km2), 5) AS max_coverage_ratio
FROM pairs JOIN psq USING (row_id, start_date), ext
WHERE psq.lon1 >= a AND psq.lat1 >= b AND psq.lon0 <= c AND psq.lat0 <= d
GROUP BY ALL""",
    "repaired_bow_ties": sql.with_(sql.SQUARES)
    + f"""
SELECT row_id, false AS valid,
       round({sql.project_x('half')} * ({sql.project_y('(lat + half)')} - {sql.project_y('(lat - half)')}) / 1e6, 4)
         AS area_km2 FROM sq""",
    "dissolved_regencies": _TILES
    + f"""
SELECT split_part(code, '.', 1) || '.' || split_part(code, '.', 2) AS target_code,
       round(sum({_TILE_AREA}), 3) AS area_km2
FROM tile WHERE level = 'district' GROUP BY 1""",
    "dissolved_overlaps": """
WITH m AS (
  SELECT event_id // 6 AS g, event_id % 6 AS m, CASE WHEN event_id % 6 = 4 THEN event_id - 1 ELSE event_id END AS k FROM events
), r AS (
  SELECT g, g % 900 * 10 + k * 7 % 5 AS x, g // 900 % 900 * 10 + k * 11 % 5 AS y, 1 + k * 31 % 7 AS s FROM m WHERE m < 5
  UNION ALL SELECT g, g % 900 * 10 + k * 7 % 5 + t * 2, g // 900 % 900 * 10 + k * 11 % 5 + t * 2, 2 FROM m, range(2) u(t) WHERE m = 5
), c AS (
  SELECT DISTINCT g, x + i AS cx, y + j AS cy FROM r, range(7) a(i), range(7) b(j) WHERE i < s AND j < s
)
SELECT g AS target_code, round(count(*) * 1e-6, 9) AS area, true AS valid FROM c GROUP BY g""",
    "rejected_units": _TILES
    + """
SELECT code, CASE WHEN k % 10 = 3 THEN 'no area' ELSE 'open outline' END AS reason
FROM (SELECT code, CAST(split_part(code, '.', 3) AS BIGINT) AS k FROM tile WHERE level = 'district') WHERE k % 10 IN (3, 7)""",
    "outline_edges": sql.with_(sql.ADMIN)
    + """
, t AS (SELECT regency, (c_custkey * 37) % (side * side) AS slot, side FROM dis, (SELECT s + (s % 37 = 0)::BIGINT AS side FROM (SELECT greatest(100, ceil(sqrt(max(c_custkey) + 1)))::BIGINT AS s FROM customer))),
n AS (SELECT a.regency, count(*) AS touching FROM t a JOIN t b ON a.regency = b.regency
      AND ((b.slot = a.slot + 1 AND a.slot % a.side <> a.side - 1) OR b.slot = a.slot + a.side) GROUP BY 1)
SELECT t.regency AS target_code, 4 * count(*) - 2 * coalesce(any_value(touching), 0) AS edges
FROM t LEFT JOIN n ON n.regency = t.regency GROUP BY 1""",
    "sibling_overlaps": _TILES
    + f"""
, t AS (SELECT *, CAST(split_part(code, '.', 3) AS BIGINT) AS k, {_TILE_AREA} / 2 AS area FROM tile WHERE level = 'district'),
p AS (
  SELECT area FROM t WHERE k % 3 = 0
  UNION ALL SELECT b.area FROM t a JOIN t b ON a.k % 3 = 0 AND abs(b.xmin - a.xmax) < 1e-9 AND abs(b.ymin - a.ymin) < 1e-9)
SELECT 'district' AS level, count(*) AS pairs, round(sum(area), 1) AS shared_km2 FROM p""",
    "representative_points": _TILES
    + """
SELECT level, code, round((ymin + ymax) / 2, 6) AS centroid_lat, round((xmin + xmax) / 2, 6) AS centroid_lng
FROM tile""",
    "simplified_tiles": _TILES + f"SELECT level, code, 5 AS points, round({_TILE_AREA}, 3) AS area_km2 FROM tile",
    "boundary_stats": _TILES
    + """
SELECT level, round(min(xmin), 6) AS xmin, round(min(ymin), 6) AS ymin, round(max(xmax), 6) AS xmax,
       round(max(ymax), 6) AS ymax, 'Polygon' AS geometry_types FROM tile GROUP BY level""",
    "coordinate_paths": _TILES
    + """
SELECT level, code, 1 AS rings, round(xmin, 6) AS xmin, round(ymin, 6) AS ymin, round(xmax, 6) AS xmax,
       round(ymax, 6) AS ymax FROM tile""",
    "geojson_features": _TILES
    + """
SELECT 'Feature' AS type, code, level, 'raw' AS boundary_source, 'MultiPolygon' AS geometry_type, 5 AS points,
       round(xmin, 6) AS first_x, round(ymin, 6) AS first_y FROM tile""",
}
