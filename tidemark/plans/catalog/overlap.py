"""Footprint x unit overlap and the facts built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codes, geo
from tidemark.operators import facts, overlap
from tidemark.plans import star
from tidemark.plans.catalog import sql


def _measured(spark: SparkSession, d: str) -> DataFrame:
    fp = star.footprints(spark, d)
    return fp.withColumn("footprint_area_km2", geo.area_km2(F.col("rings")))


def _bridge(spark: SparkSession, d: str) -> DataFrame:
    return overlap.bridge(_measured(spark, d), star.unit_fragments(spark, d))


def _round(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def unit_cell_area(spark, d):
    """The prepared unit side: cell pieces of a unit add up to its area."""
    pieces = overlap.unit_fragments(star.unit_shapes(spark, d))
    area = F.sum(F.col("w") * (F.col("r") - F.col("l")) * (F.col("hl") + F.col("hr")) / 2e6)
    return pieces.groupBy("level", "code").agg(
        F.round(area, 3).alias("piece_area_km2"),
        F.round(F.max("unit_area_km2"), 3).alias("unit_area_km2"),
    )


def footprint_unit_bridge(spark, d):
    return _round(
        _bridge(spark, d),
        intersection_area_km2=4,
        footprint_area_km2=4,
        unit_area_km2=3,
        coverage_ratio_of_unit=5,
        coverage_ratio_of_footprint=5,
    )


def daily_facts(spark, d):
    b = overlap.overlap(star.footprints(spark, d), star.unit_fragments(spark, d))
    return _round(facts.daily_facts(b), sum_intersection_area_km2=4, max_coverage_ratio=5)


def daily_facts_shuffled(spark, d):
    """The same facts with the unit side beyond any broadcast limit."""
    b = overlap.overlap(star.footprints(spark, d), star.unit_fragments(spark, d), broadcast_bytes=0)
    return _round(facts.daily_facts(b), sum_intersection_area_km2=4, max_coverage_ratio=5)


def monthly_facts(spark, d):
    b = overlap.overlap(star.footprints(spark, d), star.unit_fragments(spark, d))
    m = facts.monthly_facts(facts.daily_facts(b))
    return _round(m, sum_intersection_area_km2=3, max_coverage_ratio=5)


def intersecting_events(spark, d):
    b = overlap.overlap(star.footprints(spark, d), star.unit_fragments(spark, d), carry=())
    return facts.distinct_events(b)


def event_sample(spark, d):
    b = overlap.overlap(star.footprints(spark, d), star.unit_fragments(spark, d), carry=())
    s = facts.event_sample(_measured(spark, d), b)
    return s.select("uuid", "start_date", "end_date", F.round("area_km2", 4).alias("area_km2"))


def extent_prefilter(spark, d):
    """Footprints touching the extent of all districts."""
    kept = overlap.within_extent(star.footprints(spark, d), star.unit_shapes(spark, d))
    return kept.select("row_id", "start_date")


def diamond_partition(spark, d):
    """Overlaps of slanted footprints with a full tiling add up to the footprint."""
    fp = star.footprints(spark, d, shape="diamond")
    b = overlap.overlap(fp, star.unit_fragments(spark, d).filter("level = 'regency'"), carry=())
    return b.groupBy("row_id").agg(F.round(F.sum("intersection_area_km2"), 4).alias("area_km2"))


def footprint_area(spark, d):
    return _measured(spark, d).select("row_id", F.round("footprint_area_km2", 4).alias("area_km2"))


def village_day_facts(spark, d):
    """District tiles read as villages, suppliers' keys as their postal codes."""
    b, postal = _as_villages(spark, d)
    out = facts.village_day(b, postal)
    return _round(out, sum_intersection_area_km2=4, max_coverage_ratio_of_village=5)


def postal_facts(spark, d):
    b, postal = _as_villages(spark, d)
    return _round(facts.postal_rollup(b, postal), sum_intersection_area_km2=4, max_coverage_ratio=5)


def _as_villages(spark, d):
    b = _bridge(spark, d).filter("level = 'district'").withColumn("level", F.lit("village"))
    postal = star.district_codes(spark, d).select(
        F.col("code").alias("village_code"),
        codes.padded(F.col("c_custkey") % 97, 5).alias("postal_code"),
    )
    return b, postal


QUERIES = {
    "unit_cell_area": unit_cell_area,
    "footprint_unit_bridge": footprint_unit_bridge,
    "daily_facts": daily_facts,
    "daily_facts_shuffled": daily_facts_shuffled,
    "monthly_facts": monthly_facts,
    "intersecting_events": intersecting_events,
    "event_sample": event_sample,
    "extent_prefilter": extent_prefilter,
    "diamond_partition": diamond_partition,
    "footprint_area": footprint_area,
    "village_day_facts": village_day_facts,
    "postal_facts": postal_facts,
}

_BASE = sql.with_(sql.ADMIN, sql.SQUARES, sql.TILES, sql.pairs())

_DAY = """
SELECT start_date AS event_date, level, code, count(*) AS unique_event_count,
       CAST(1 AS BIGINT) AS flood_days, round(sum(area), 4) AS sum_intersection_area_km2,
       round(max(area / unit_area_km2), 5) AS max_coverage_ratio
FROM pairs GROUP BY ALL
"""

_POSTAL = """
pst AS (SELECT code AS village_code, printf('%05d', c_custkey % 97) AS postal_code FROM dis)
"""

_BASE_POSTAL = sql.with_(sql.ADMIN, sql.SQUARES, sql.TILES, sql.pairs(), _POSTAL)

ORACLES = {
    "unit_cell_area": sql.with_(sql.ADMIN, sql.TILES)
    + f"""
, m AS (SELECT level, code, round(({sql.project_x('xmax')} - {sql.project_x('xmin')})
        * ({sql.project_y('ymax')} - {sql.project_y('ymin')}) / 1e6, 3) AS a FROM tile)
SELECT level, code, a AS piece_area_km2, a AS unit_area_km2 FROM m""",
    "footprint_unit_bridge": _BASE
    + """
SELECT row_id, uuid, start_date, level, code, round(area, 4) AS intersection_area_km2,
       round(footprint_area_km2, 4) AS footprint_area_km2, round(unit_area_km2, 3) AS unit_area_km2,
       round(area / unit_area_km2, 5) AS coverage_ratio_of_unit,
       round(area / footprint_area_km2, 5) AS coverage_ratio_of_footprint
FROM pairs""",
    "daily_facts": _BASE + _DAY,
    "daily_facts_shuffled": _BASE + _DAY,
    "monthly_facts": _BASE
    + """
, dayf AS (
  SELECT start_date, level, code, count(*) AS n, sum(area) AS a, max(area / unit_area_km2) AS r
  FROM pairs GROUP BY ALL)
SELECT level, code, start_date[1:7] || '-01' AS month_start, CAST(sum(n) AS BIGINT) AS unique_event_count,
       count(*) AS flood_days, round(sum(a), 3) AS sum_intersection_area_km2,
       round(max(r), 5) AS max_coverage_ratio
FROM dayf GROUP BY ALL""",
    "intersecting_events": _BASE
    + "SELECT count(DISTINCT row_id) AS intersecting_events FROM pairs WHERE level = 'district'",
    "event_sample": _BASE
    + """
SELECT uuid, start_date, end_date, area_km2 FROM (
  SELECT row_id, uuid, start_date, coalesce(end_date, start_date) AS end_date,
         round(any_value(footprint_area_km2), 4) AS area_km2
  FROM pairs WHERE level = 'district' GROUP BY ALL ORDER BY row_id LIMIT 500)""",
    "extent_prefilter": sql.with_(sql.ADMIN, sql.SQUARES, sql.TILES)
    + """
, ext AS (SELECT min(xmin) AS a, min(ymin) AS b, max(xmax) AS c, max(ymax) AS d FROM tile WHERE level = 'district')
SELECT row_id, start_date FROM sq, ext
WHERE lon + half >= a AND lat + half >= b AND lon - half <= c AND lat - half <= d""",
    "diamond_partition": sql.with_(sql.SQUARES)
    + f"""
SELECT row_id, round({sql.project_x('half')} * ({sql.project_y('(lat + half)')} - {sql.project_y('(lat - half)')}) / 1e6, 4)
       AS area_km2
FROM sq""",
    "footprint_area": sql.with_(sql.SQUARES)
    + f"""
SELECT row_id, round(2 * {sql.project_x('half')} * ({sql.project_y('(lat + half)')} - {sql.project_y('(lat - half)')}) / 1e6, 4)
       AS area_km2
FROM sq""",
    "village_day_facts": _BASE_POSTAL
    + """
SELECT start_date AS event_date, code AS village_code, postal_code, count(*) AS event_count,
       count(DISTINCT uuid) AS unique_event_count, round(sum(area), 4) AS sum_intersection_area_km2,
       round(max(area / unit_area_km2), 5) AS max_coverage_ratio_of_village
FROM pairs JOIN pst ON code = village_code WHERE level = 'district' GROUP BY ALL""",
    "postal_facts": _BASE_POSTAL
    + """
SELECT start_date AS event_date, postal_code, count(*) AS event_count,
       count(DISTINCT uuid) AS unique_event_count, round(sum(area), 4) AS sum_intersection_area_km2,
       round(max(area / unit_area_km2), 5) AS max_coverage_ratio
FROM pairs JOIN pst ON code = village_code WHERE level = 'district' GROUP BY ALL""",
}
