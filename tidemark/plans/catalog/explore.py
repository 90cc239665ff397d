"""Interactive queries over the month facts of line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import metrics
from tidemark.functions.dates import full_date_label, month_label, window_label
from tidemark.operators import explore
from tidemark.plans import star
from tidemark.plans.catalog import admin as admin_queries
from tidemark.plans.catalog import facts, sql

FROM, TO = "1996-03", "1998-07"
METRIC = "sum_intersection_area_km2"
TERMS = ("nation_1", "AMERICA", "customer#00000001", "12.0", " asia ", "")


def window_rollup(spark, d):
    return explore.window_rollup(facts.written(spark, d)[1], "district", FROM, TO)


def window_rollup_full(spark, d):
    """An open window answers from the all-time summary."""
    _, month, total = facts.written(spark, d)
    return explore.window_rollup(month, "regency", summary=total)


def window_defaults(spark, d):
    m = facts.written(spark, d)[1]
    return explore.window_defaults(m, "regency", FROM, "2030-01")


def timeline(spark, d):
    return explore.timeline(facts.written(spark, d)[1], "district", FROM)


def trend(spark, d):
    return explore.trend(facts.written(spark, d)[1], "regency", "12.02", FROM, TO)


def trend_axis(spark, d):
    return explore.trend_series(facts.written(spark, d)[1], "district", FROM, TO)


def _features(spark, d):
    """Features of the public levels, district facts of the window and the units."""
    a = admin_queries.admin_units(spark, d, public=True)
    b = admin_queries.boundaries(spark, d, public=True).select("code", "boundary_source")
    feats = b.join(a, "code")
    lookup = explore.window_rollup(facts.written(spark, d)[1], "district", FROM, TO)
    return feats, lookup, a


def map_features(spark, d):
    feats, lookup, a = _features(spark, d)
    out = explore.map_features(feats, lookup, a, "district", METRIC)
    return out.select(
        "code", "boundary_source", "metric_value", "max_coverage_ratio", "bin", "metric_display", "parent_name"
    )


def selection_cards(spark, d):
    """Cards of every regency; the single-card form filters the same plan by code."""
    a = admin_queries.admin_units(spark, d, public=True)
    b = admin_queries.boundaries(spark, d, public=True).select("code", "boundary_source").join(a, "code")
    lookup = explore.window_rollup(facts.written(spark, d)[1], "regency", FROM, TO)
    out = explore.map_features(b, lookup, a, "regency", "unique_event_count", "id")
    return out.select("name", "code", "parent_name", "boundary_source", "metric_display")


def selection_card(spark, d):
    a = admin_queries.admin_units(spark, d, public=True)
    b = admin_queries.boundaries(spark, d, public=True).select("code", "boundary_source").join(a, "code")
    lookup = explore.window_rollup(facts.written(spark, d)[1], "province", FROM, TO)
    return explore.selection_card(b, lookup, a, "province", METRIC, "12")


def dashboard_stats(spark, d):
    feats, lookup, _ = _features(spark, d)
    return explore.stats(lookup, feats.filter("level = 'district'"), METRIC)


def legend(spark, d):
    lookup = explore.window_rollup(facts.written(spark, d)[1], "district", FROM, TO)
    return explore.metric_max(lookup, METRIC).select(F.inline(metrics.legend(F.col("max_value"))))


def search(spark, d):
    index = explore.search_index(admin_queries.admin_units(spark, d))
    out = explore.search(index, TERMS)
    return out.select("query", "position", "code", "name", "level", "resolved_level", "resolved_code")


def search_villages_resolved(spark, d):
    """Hits of unpublished villages resolve to their district."""
    index = explore.search_index(admin_queries.admin_units(spark, d), ("village",))
    return explore.resolve_selection(index).select("code", "resolved_level", "resolved_code")


def search_index(spark, d):
    return explore.search_index(admin_queries.admin_units(spark, d))


def available_levels(spark, d):
    return explore.available_levels(admin_queries.boundaries(spark, d), facts.written(spark, d)[1])


def evidence(spark, d):
    """Months of a unit as evidence, coverage as internal score."""
    m = facts.written(spark, d)[1].select(
        "level",
        "code",
        F.substring("month_start", 1, 7).alias("month"),
        F.col("max_coverage_ratio").alias("internal_score"),
        F.concat_ws("/", "level", "code", "month_start").alias("path"),
    )
    chosen = admin_queries.admin_units(spark, d).filter("level <> 'village'").select("level", "code")
    return explore.highlighted_month(explore.pick_evidence(m, chosen, FROM, TO))


def evidence_notes(spark, d):
    li = star.table(spark, d, "lineitem")
    key = explore.evidence_note_key(
        F.when(F.col("l_linestatus") == "F", F.lit("mixed")).otherwise(F.lower("l_returnflag")),
        F.col("l_discount"),
        F.col("l_tax"),
    )
    tip = explore.evidence_tooltip(
        F.col("l_returnflag"), F.when(F.col("l_tax") > 0.05, F.lit("")).otherwise(F.lit("v1")), F.col("l_linestatus")
    )
    return li.groupBy(key.alias("note_key"), tip.alias("tooltip")).agg(F.count(F.lit(1)).alias("rows"))


def number_display(spark, d):
    o = star.table(spark, d, "orders")
    v = F.when(F.col("o_orderstatus") == "F", F.round("o_totalprice")).otherwise(-F.col("o_orderkey") / 8)
    return o.select(
        "o_orderkey",
        metrics.display_number(v).alias("en"),
        metrics.display_number(v, "id").alias("id"),
    )


def date_labels(spark, d):
    o = star.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return o.select(
        "o_orderkey",
        month_label(F.substring("day", 1, 7)).alias("month_label"),
        full_date_label(F.col("day")).alias("en_label"),
        full_date_label(F.col("day"), "id").alias("id_label"),
        window_label(F.substring("day", 1, 7), F.lit("1998-07")).alias("window"),
    )


def window_drag(spark, d):
    """Both sliders of a window moved past each other, over order and ship months."""
    o = star.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("a"))
    li = star.table(spark, d, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM").alias("b"))
    j = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    f1, t1 = explore.normalize_window(F.col("a"), F.col("b"), "from")
    f2, t2 = explore.normalize_window(F.col("a"), F.col("b"), "to")
    return j.groupBy(f1.alias("from_moved"), t1.alias("to_dragged"), f2.alias("from_dragged"), t2.alias("to_moved")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def level_extent(spark, d):
    """Extent of all features of a level, of both kinds of level there are."""
    shapes = star.unit_shapes(spark, d)
    parts = [
        explore.extent_of(shapes.filter(F.col("level") == lv)).withColumn("level", F.lit(lv))
        for lv in ("province", "district")
    ]
    return parts[0].unionByName(parts[1])


QUERIES = {
    "level_extent": level_extent,
    "window_rollup": window_rollup,
    "window_rollup_full": window_rollup_full,
    "window_defaults": window_defaults,
    "timeline": timeline,
    "trend": trend,
    "trend_axis": trend_axis,
    "map_features": map_features,
    "selection_cards": selection_cards,
    "selection_card": selection_card,
    "dashboard_stats": dashboard_stats,
    "legend": legend,
    "search": search,
    "search_villages_resolved": search_villages_resolved,
    "search_index": search_index,
    "available_levels": available_levels,
    "evidence": evidence,
    "evidence_notes": evidence_notes,
    "number_display": number_display,
    "date_labels": date_labels,
    "window_drag": window_drag,
}

_BASE = sql.with_(sql.ADMIN, sql.LINES)
_BND = sql.with_(sql.ADMIN, sql.BOUNDARIES, sql.LINES)
_IN = f"month_start[1:7] BETWEEN '{FROM}' AND '{TO}'"


def _window(level: str, name: str = "win") -> str:
    return f"""
, {name} AS (
  SELECT code, CAST(sum(unique_event_count) AS BIGINT) AS unique_event_count,
         CAST(sum(flood_days) AS BIGINT) AS flood_days,
         sum(sum_intersection_area_km2) AS sum_intersection_area_km2,
         max(max_coverage_ratio) AS max_coverage_ratio
  FROM mon WHERE level = '{level}' AND {_IN} GROUP BY code)
"""


def _display(v: str) -> str:
    rounded = f"sign({v}) * floor(abs(CAST({v} AS DOUBLE)) * 100 + 0.5) / 100"
    return f"rtrim(rtrim(format('{{:,.2f}}', CAST({rounded} AS DOUBLE)), '0'), '.')"


def _swap(v: str) -> str:
    return f"translate({v}, ',.', '.,')"


_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_MONTHS_ID = "['Jan','Feb','Mar','Apr','Mei','Jun','Jul','Agu','Sep','Okt','Nov','Des']"

ORACLES = {
    "window_rollup": _BASE + _window("district") + "SELECT *, 'date_window' AS mode FROM win",
    "window_rollup_full": _BASE
    + "SELECT * EXCLUDE (level), 'summary_all_time' AS mode FROM alltime WHERE level = 'regency'",
    "window_defaults": _BASE
    + f"""
SELECT CASE WHEN bool_or(month_start[1:7] = '{FROM}') THEN '{FROM}' ELSE min(month_start)[1:7] END AS month_from,
       max(month_start)[1:7] AS month_to FROM mon WHERE level = 'regency'""",
    "timeline": _BASE
    + f"""
, f AS (SELECT *, month_start[1:7] AS m FROM mon WHERE level = 'district' AND month_start[1:7] >= '{FROM}')
SELECT x.m AS month_to, code, CAST(sum(unique_event_count) AS BIGINT) AS unique_event_count,
       CAST(sum(flood_days) AS BIGINT) AS flood_days, sum(sum_intersection_area_km2) AS sum_intersection_area_km2,
       max(max_coverage_ratio) AS max_coverage_ratio
FROM (SELECT DISTINCT m FROM f) x JOIN f ON f.m <= x.m GROUP BY 1, 2""",
    "trend": _BASE
    + f"SELECT * EXCLUDE (level) FROM mon WHERE level = 'regency' AND code = '12.02' AND {_IN}",
    "trend_axis": _BASE
    + f"""
, s AS (SELECT * EXCLUDE (level), CAST(row_number() OVER (PARTITION BY code ORDER BY month_start) - 1 AS INTEGER) AS ix,
               count(*) OVER (PARTITION BY code) AS n
        FROM mon WHERE level = 'district' AND {_IN})
SELECT *, CASE WHEN ix = 0 OR ix = n - 1 OR ix % greatest(1, CAST(ceil(n / 6) AS BIGINT)) = 0
               THEN month_start[1:4] ELSE '' END AS axis_label FROM s""",
    "map_features": _BND
    + _window("district")
    + f"""
, mx AS (SELECT greatest(max({METRIC}), 0) AS m FROM win)
SELECT bnd.code, boundary_source, coalesce({METRIC}, 0.0) AS metric_value,
       coalesce(max_coverage_ratio, 0.0) AS max_coverage_ratio,
       CAST(CASE WHEN m = 0 OR coalesce({METRIC}, 0) <= 0 THEN 0
            ELSE least(5, floor({METRIC} / m * 5) + 1) END AS INTEGER) AS bin,
       {_display(f'coalesce({METRIC}, 0)')} AS metric_display, nat.name AS parent_name
FROM bnd JOIN dis ON dis.code = bnd.code JOIN nat ON nat.code = dis.regency
LEFT JOIN win ON win.code = bnd.code CROSS JOIN mx
WHERE bnd.level = 'district'""",
    "selection_cards": _BND
    + _window("regency")
    + f"""
SELECT nat.name, bnd.code, reg.name AS parent_name, boundary_source,
       {_swap(_display('coalesce(unique_event_count, 0)'))} AS metric_display
FROM bnd JOIN nat ON nat.code = bnd.code JOIN reg ON reg.code = split_part(nat.code, '.', 1)
LEFT JOIN win ON win.code = bnd.code""",
    "selection_card": _BND
    + _window("province")
    + f"""
SELECT reg.name, bnd.code, 'selection.root_country' AS parent_name, boundary_source,
       {_display(f'coalesce({METRIC}, 0)')} AS metric_display,
       {_display('coalesce(max_coverage_ratio, 0)')} AS coverage_display
FROM bnd JOIN reg ON reg.code = bnd.code LEFT JOIN win ON win.code = bnd.code WHERE bnd.code = '12'""",
    "dashboard_stats": _BND
    + _window("district")
    + f"""
SELECT CAST(sum(unique_event_count) AS BIGINT) AS total_events,
       count(*) FILTER (WHERE {METRIC} > 0) AS units_with_data,
       (SELECT count(*) FROM bnd WHERE level = 'district') AS rendered_units FROM win""",
    "legend": _BASE
    + _window("district")
    + f"""
SELECT CAST(i AS INTEGER) AS step, CASE WHEN i = 0 THEN 0 ELSE CAST(floor(i / 5 * m + 0.5) AS BIGINT) END AS threshold
FROM (SELECT max({METRIC}) AS m FROM win) CROSS JOIN range(6) r(i)""",
    "search": _BASE
    + """
, q AS (SELECT * FROM (VALUES ('nation_1'), ('america'), ('customer#00000001'), ('12.0'), ('asia')) t(query)),
hits AS (
  SELECT query, adm.*, CASE level WHEN 'province' THEN 1 WHEN 'regency' THEN 2 ELSE 3 END AS rank
  FROM q JOIN adm ON contains(lower(name), query) OR contains(code, query) WHERE level <> 'village')
SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY rank, name, code) AS INTEGER) AS position,
       code, name, level, level AS resolved_level, code AS resolved_code
FROM hits QUALIFY position <= 8""",
    "search_villages_resolved": _BASE
    + "SELECT code, 'district' AS resolved_level, district_code AS resolved_code FROM adm WHERE level = 'village'",
    "search_index": _BASE
    + """
SELECT * FROM adm WHERE level <> 'village'""",
    "available_levels": _BND
    + """
SELECT DISTINCT level, CAST(CASE level WHEN 'province' THEN 1 WHEN 'regency' THEN 2 ELSE 3 END AS BIGINT) AS level_rank
FROM bnd WHERE level IN (SELECT level FROM mon)""",
    "evidence": _BASE
    + f"""
SELECT level, code, month_start[1:7] AS month, level || '/' || code || '/' || month_start AS path,
       max_coverage_ratio AS internal_score, month_start[1:7] AS highlighted_month
FROM mon WHERE {_IN}
QUALIFY row_number() OVER (PARTITION BY level, code ORDER BY max_coverage_ratio DESC, month_start DESC) = 1""",
    "evidence_notes": """
SELECT 'evidence.gap.note.' || CASE WHEN l_linestatus <> 'F' THEN lower(l_returnflag)
         WHEN l_discount >= l_tax THEN 'mixed.internal_higher' ELSE 'mixed.external_higher' END AS note_key,
       concat_ws(chr(10), l_returnflag, CASE WHEN l_tax > 0.05 THEN NULL ELSE 'v1' END, l_linestatus) AS tooltip,
       count(*) AS rows
FROM lineitem GROUP BY ALL""",
    "level_extent": sql.with_(sql.ADMIN, sql.TILES)
    + """
SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, level
FROM tile WHERE level IN ('province', 'district') GROUP BY level""",
    "number_display": f"""
WITH v AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice) ELSE -o_orderkey / 8 END AS v FROM orders)
SELECT o_orderkey, {_display('v')} AS en, {_swap(_display('v'))} AS id FROM v""",
    "date_labels": f"""
SELECT o_orderkey, strftime(o_orderdate, '%b %Y') AS month_label,
       strftime(o_orderdate, '%b %-d, %Y') AS en_label,
       day(o_orderdate) || ' ' || ({_MONTHS_ID})[month(o_orderdate)] || ' ' || year(o_orderdate) AS id_label,
       CASE WHEN strftime(o_orderdate, '%Y-%m') = '1998-07' THEN 'Jul 1998'
            ELSE strftime(o_orderdate, '%b %Y') || ' – Jul 1998' END AS "window"
FROM orders""",
    "window_drag": """
WITH j AS (SELECT strftime(o_orderdate, '%Y-%m') AS a, strftime(l_shipdate, '%Y-%m') AS b
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT a AS from_moved, CASE WHEN b < a THEN a ELSE b END AS to_dragged,
       CASE WHEN a > b THEN b ELSE a END AS from_dragged, b AS to_moved, count(*) AS rows
FROM j GROUP BY ALL""",
}
