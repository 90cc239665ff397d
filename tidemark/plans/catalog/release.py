"""Release packaging, manifests, checks and the incremental refresh."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.operators import admin, explore, overlap, release, validation
from tidemark.operators import facts as fact_ops
from tidemark.plans import pipelines, star
from tidemark.plans.catalog import admin as admin_queries
from tidemark.plans.catalog import facts, geometry, reports, sql
from tidemark.plans.catalog import overlap as overlap_queries
from tidemark.schemas import ADMIN_COLUMNS
from tidemark.session import cut_lineage, work_path
from tidemark.sinks import writers
from tidemark.sources import assets as asset_files
from tidemark.sources import footprints
from tidemark.streaming import refresh

STAMP = "2024-01-01T00:00:00+00:00"


def month_spine(spark, d):
    """Spine over months with a return of a full discount, so that gaps occur."""
    rare = facts.line_bridge(spark, d).filter("coverage_ratio = 0 AND intersection_area_km2 = 1")
    return release.month_spine(fact_ops.monthly_facts(fact_ops.daily_facts(rare)))


def metric_assets(spark, d):
    a = release.metric_assets(facts.monthly(spark, d))
    return a.select("level", F.array_join("months", ",").alias("months"), "trend_bundle_segments")


def shard_keys(spark, d):
    """Rows and units per trend shard."""
    t = writers.trend_shards(facts.monthly(spark, d))
    return t.groupBy("level", "shard_key").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("code").alias("units")
    )


def methodology(spark, d):
    """Metric dictionary with the largest observed value of each metric."""
    total = facts.all_time(spark, d)
    observed = total.agg(
        F.create_map(*(x for m in release.METRICS for x in (F.lit(m), F.max(m).cast("double")))).alias("m")
    ).select(F.explode("m").alias("metric", "largest"))
    return release.methodology(spark).join(observed, "metric")


def reference_manifest(spark, d):
    b = admin_queries.boundaries(spark, d)
    m = release.reference_manifest(b, admin_queries.release_gate(spark, d), STAMP)
    return m.select(
        "dataset", "generated_at", F.array_join("available_levels", ",").alias("available_levels"),
        "release_gate.warning_code", F.array_join("artifacts", ",").alias("artifacts"),
        F.array_join(F.map_values("artifact_paths"), ",").alias("paths"),
    )


def _facts_manifest(spark, d):
    daily, monthly, _ = facts.written(spark, d)
    counts = fact_ops.row_counts(daily, monthly)
    rows = star.table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))
    pairs = facts.written_bridge(spark, d)
    hits = pairs.filter("level = 'district'").agg(F.count(F.lit(1)).alias("n"))
    sample = (
        pairs
        .filter("level = 'district'")
        .orderBy("start_date", "code", "intersection_area_km2", "coverage_ratio")
        .limit(fact_ops.EVENT_SAMPLE_LIMIT)
    )
    gate = fact_ops.enabled_levels(False, admin_queries.coverage_overall(spark, d)).select("warning")
    return release.facts_manifest(counts, rows, hits, sample, gate, STAMP)


def facts_manifest(spark, d):
    m = _facts_manifest(spark, d)
    per = F.transform("level_row_counts", lambda r: F.concat_ws(":", r["level"], r["day_rows"], r["month_rows"]))
    return m.select(
        "generated_at", "status", "source_rows", "intersecting_events", "event_sample_size",
        F.array_join("built_levels", ",").alias("built_levels"),
        F.array_join(per, ",").alias("level_row_counts"), F.array_join("warnings", ",").alias("warnings"),
    )


def footprint_manifest(spark, d):
    """Facts manifest of the footprints: events that meet a district, each once however many units
    it meets, and the sample of them."""
    prints = star.footprints(spark, d).withColumn("footprint_area_km2", F.lit(0.0))
    pairs = cut_lineage(overlap.overlap(prints, star.unit_fragments(spark, d)))
    daily = cut_lineage(fact_ops.daily_facts(pairs))
    counts = fact_ops.row_counts(daily, fact_ops.monthly_facts(daily))
    rows = prints.agg(F.count(F.lit(1)).alias("n"))
    gate = fact_ops.enabled_levels(False, admin_queries.coverage_overall(spark, d)).select("warning")
    m = release.facts_manifest(counts, rows, fact_ops.distinct_events(pairs), fact_ops.event_sample(prints, pairs), gate, STAMP)
    per = F.transform("level_row_counts", lambda r: F.concat_ws(":", r["level"], r["day_rows"], r["month_rows"]))
    return m.select("status", "source_rows", "intersecting_events", "event_sample_size", F.array_join(per, ",").alias("level_row_counts"))


def gated_builds(spark, d):
    """Whether a build stops at the district gate, for thresholds that any, this and no coverage meets."""
    overall = cut_lineage(admin_queries.coverage_overall(spark, d))
    out = []
    for threshold in (0.0, 0.5, 2.0):
        try:
            admin.assert_release_ready(admin.release_gate(overall, threshold))
            stopped = False
        except RuntimeError:
            stopped = True
        out.append((threshold, stopped))
    district = overall.filter("level = 'district'")
    return spark.createDataFrame(out, "threshold double, stopped boolean").select(
        "*", *(district.select(c).scalar().alias(c) for c in ("coverage_ratio", "admin_total"))
    )


def derived_regencies(spark, d):
    """Regencies dissolved from districts and joined to the units of all provinces but two; outlines
    of the others are rejected as unknown."""
    members = star.unit_shapes(spark, d).filter("level = 'district'").withColumn("target_code", F.substring_index("code", ".", 2))
    units = admin_queries.admin_units(spark, d).filter("province_code NOT IN ('11', '13')")
    postal = units.filter("level = 'village'").select(F.col("code").alias("village_code"), F.lit("").alias("postal_code"))
    found, rejects = pipelines.derive_levels(members, units, postal)
    shown = found.select("code", "level", "name", "boundary_source", F.round(geo.area_km2(F.col("rings")), 3).alias("area_km2"), F.lit(None).cast("string").alias("reason"))
    none = (F.lit(None).cast(t).alias(n) for n, t in (("level", "string"), ("name", "string"), ("boundary_source", "string"), ("area_km2", "double")))
    return shown.unionByName(rejects.select("code", "reason", *none))


def replaced_table(spark, d):
    """A partitioned table written whole and then anew from two of its levels."""
    path = work_path(spark, "replaced")
    daily = facts.written(spark, d)[0]
    writers.write_table(daily, path, "level")
    writers.write_table(daily.filter("level <> 'province'"), path, "level")
    return spark.read.parquet(path).groupBy("level").agg(F.count(F.lit(1)).alias("rows"))


def _release(spark, d):
    """All assets of one release."""
    daily, monthly, summary = facts.written(spark, d)
    units = admin_queries.admin_units(spark, d)
    b = admin_queries.boundaries(spark, d).drop("province_code", "level").join(units, "code")
    overall = admin.coverage(units, b)
    gate = admin.release_gate(overall)
    assets = release.metric_assets(monthly)
    manifest = release.release_manifest(
        explore.available_levels(b, monthly), assets, _facts_manifest(spark, d), gate, "v1", STAMP
    )
    events, states = reports.published(spark, d)
    files = reports.files(spark, d)
    registry = star.prepared("registry", spark, d, lambda: reports.registry(spark, d))
    return {
        "assets": spark.createDataFrame([(n,) for n in validation.ROOT_ASSETS], "name string"),
        "manifest": manifest,
        "coverage": overall,
        "coverage_by_province": admin.coverage_by_province(units, b),
        "gate": gate,
        "methodology": release.methodology(spark),
        "methodology_texts": release.methodology_texts(spark),
        "search_index": explore.search_index(units),
        "boundaries": b,
        "metric_assets": assets,
        "month_shards": writers.month_shards(monthly),
        "trend_shards": writers.trend_shards(monthly),
        "summary": summary,
        "events": events,
        "states": states,
        "registry": registry,
        "files": files,
        "daily": daily,
        "monthly": monthly,
    }


def release_manifest(spark, d):
    m = _release(spark, d)["manifest"]
    return m.select(
        "dataset_version", "default_level", "default_metric", "default_language",
        F.array_join("available_levels", ",").alias("available_levels"),
        F.array_join("metrics", ",").alias("metrics"),
        F.size(F.col("metric_assets")["regency"]["months"]).alias("regency_months"),
        "source_status", F.col("source_summary.intersecting_events").alias("intersecting_events"),
        F.array_join("warning_codes", ",").alias("warning_codes"),
    )


def validate_release(spark, d):
    """Every check over the derived release; several sources share a place, which the
    registry check reports."""
    return validation.validate_release(_release(spark, d)).groupBy("check_id", "asset", "severity").agg(
        F.count(F.lit(1)).alias("messages")
    )


def check_registry(spark, d):
    """Suppliers as registry rows: shared nations, wrong levels and missing files."""
    s = star.table(spark, d, "supplier")
    reg = star.regencies(spark, d)
    rows = s.join(reg, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("code").alias("admin_code"),
        F.when(F.col("s_acctbal") < 0, F.lit("district")).otherwise(F.lit("regency")).alias("admin_level"),
        F.lit("11").alias("province_code"),
        F.col("s_name").alias("slug"),
        F.concat("s_name", F.lit("/e")).alias("events_path"),
        F.concat("s_name", F.lit("/s")).alias("states_path"),
    )
    files = s.filter("s_acctbal > 0").select(F.concat("s_name", F.lit("/e")).alias("path"))
    return validation.check_registry(rows, files)


def check_metrics(spark, d):
    """Months announced from all lines, shards from discounted large lines only."""
    m = facts.monthly(spark, d)
    few = facts.line_bridge(spark, d).filter("coverage_ratio = 0 AND intersection_area_km2 = 1")
    shards = writers.month_shards(fact_ops.monthly_facts(fact_ops.daily_facts(few)))
    trends = writers.trend_shards(m).filter("level <> 'district'")
    return validation.check_metrics(release.metric_assets(m), shards, trends, facts.all_time(spark, d))


def check_domains(spark, d):
    """Order states where review states are expected, villages in the search index."""
    o = star.table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("admin_code"), F.lit("regency").alias("admin_level"),
        F.col("o_orderstatus").alias("public_state"),
    )
    e = o.select("admin_code", "admin_level", F.lit(None).cast("string").alias("source_name"), F.lit("").alias("source_date"))
    q = validation.check_qualitative(e, o)
    i = validation.check_search_index(admin_queries.admin_units(spark, d))
    return q.unionByName(i)


def check_totals(spark, d):
    """A summary without its provinces does not add up."""
    some = facts.all_time(spark, d).filter("level <> 'province'")
    return validation.check_totals(facts.daily(spark, d), facts.monthly(spark, d), some)


def refreshed_daily_facts(spark, d):
    """Day facts kept by the file stream over line files, one run after another."""
    return refresh.replay(spark, facts.line_bridge(spark, d), lambda batch: batch)


def refreshed_footprint_facts(spark, d):
    """WKB footprints arriving in files, overlapped batch by batch with the prepared units."""
    fragments = star.unit_fragments(spark, d)

    def to_bridge(batch):
        return overlap.overlap(footprints.decode_footprints(batch), fragments)

    raw = geometry.raw_footprints(spark, d).withColumn("area_km2", F.lit(None).cast("double"))
    day = refresh.replay(spark, raw, to_bridge)
    return day.withColumns(
        {
            "sum_intersection_area_km2": F.round("sum_intersection_area_km2", 4),
            "max_coverage_ratio": F.round("max_coverage_ratio", 5),
        }
    )


def redelivered_footprint_facts(spark, d):
    """The same footprints, part of whose files come again: under other names, and written anew
    in another order."""
    fragments = star.unit_fragments(spark, d)

    def to_bridge(batch):
        return overlap.overlap(footprints.decode_footprints(batch), fragments)

    raw = geometry.raw_footprints(spark, d).withColumn("area_km2", F.lit(None).cast("double"))
    day = refresh.replay(spark, raw, to_bridge, again=True)
    return day.withColumns(
        {
            "sum_intersection_area_km2": F.round("sum_intersection_area_km2", 4),
            "max_coverage_ratio": F.round("max_coverage_ratio", 5),
        }
    )


def unit_month_spine(spark, d):
    """A spine for each district, whose months have gaps whatever the size of the tables."""
    monthly = facts.monthly(spark, d).filter("level = 'district'").withColumn("level", F.col("code"))
    return release.month_spine(monthly).withColumnRenamed("level", "code")


def collection_features(spark, d):
    """Features per level of collection documents written and read back, with the lines around
    them and the commas between."""
    path = work_path(spark, "collections")
    u = star.unit_shapes(spark, d).withColumn("boundary_source", F.lit("raw"))
    writers.write_feature_collections(u, path)
    lines = asset_files.read_collections(spark, path)
    end = Window.partitionBy("level").orderBy("file", "line")
    back = Window.partitionBy("level").orderBy(F.col("file").desc(), F.col("line").desc())
    # limits on the row numbers hold in each task before the shuffle, so that no task gets a level whole
    heads = lines.select("level", "value", F.row_number().over(end).alias("n")).filter("n <= 2").groupBy("level").agg(
        F.max(F.when(F.col("n") == 1, F.col("value"))).alias("head"),
        F.max(F.when(F.col("n") == 2, ~F.col("value").startswith(","))).alias("first_without"),
    )
    feet = lines.select("level", F.col("value").alias("foot"), F.row_number().over(back).alias("m")).filter("m = 1").drop("m")
    commas = lines.groupBy("level").agg(F.count_if(F.col("value").startswith(",")).alias("commas"))
    sides = heads.join(feet, "level").join(commas, "level").select("level", "head", "foot", "commas", "first_without")
    codes = asset_files.read_collection_features(spark, path).groupBy("level").agg(
        F.count(F.lit(1)).alias("features"), F.min(F.col("properties")["code"]).alias("least"), F.max(F.col("properties")["code"]).alias("most")
    )
    return sides.join(codes, "level")


def gap_shards(spark, d):
    """Month folders of the few lines of quantity 1 and discount 0, gap months included."""
    few = facts.line_bridge(spark, d).filter("coverage_ratio = 0 AND intersection_area_km2 = 1")
    path = work_path(spark, "gap-shards")
    writers.write_month_shards(fact_ops.monthly_facts(fact_ops.daily_facts(few)), path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1).alias(name)
    return files.select(part("level"), part("month")).distinct()


def broken_release(spark, d):
    """A release without a month's shards, one summary column too many, a lost property,
    no notes and a path that leads nowhere."""
    a = dict(_release(spark, d))
    a["assets"] = a["assets"].filter("name <> 'methodology'")
    a["month_shards"] = a["month_shards"].filter("NOT (level = 'regency' AND month = '1995-05')")
    a["summary"] = a["summary"].withColumn("extra", F.lit(1))
    a["methodology_texts"] = a["methodology_texts"].filter("kind = 'source'")
    a["manifest"] = a["manifest"].withColumn("search_index", F.lit("elsewhere"))
    a["features"] = a["boundaries"].select(
        "level", F.create_map(*(F.lit(x) for c in (*ADMIN_COLUMNS,) for x in (c, ""))).alias("properties")
    )
    return validation.validate_release(a).filter("check_id <> 'registry'")


QUERIES = {
    "footprint_manifest": footprint_manifest,
    "gated_builds": gated_builds,
    "derived_regencies": derived_regencies,
    "replaced_table": replaced_table,
    "gap_shards": gap_shards,
    "broken_release": broken_release,
    "month_spine": month_spine,
    "metric_assets": metric_assets,
    "shard_keys": shard_keys,
    "methodology": methodology,
    "reference_manifest": reference_manifest,
    "facts_manifest": facts_manifest,
    "release_manifest": release_manifest,
    "validate_release": validate_release,
    "check_registry": check_registry,
    "check_metrics": check_metrics,
    "check_domains": check_domains,
    "check_totals": check_totals,
    "refreshed_daily_facts": refreshed_daily_facts,
    "refreshed_footprint_facts": refreshed_footprint_facts,
    "redelivered_footprint_facts": redelivered_footprint_facts,
    "unit_month_spine": unit_month_spine,
    "collection_features": collection_features,
}

_LINES = sql.with_(sql.ADMIN, sql.LINES)
_BND = sql.with_(sql.ADMIN, sql.BOUNDARIES)
_ALL = sql.with_(sql.ADMIN, sql.BOUNDARIES, sql.LINES)
_GATE = """
CASE WHEN (SELECT count(DISTINCT level) FROM bnd WHERE level <> 'village') < 3 THEN 'missing_required_levels'
     WHEN (SELECT count(DISTINCT code) FROM bnd WHERE level = 'district') >= 0.98 * (SELECT count(*) FROM dis)
     THEN NULL ELSE 'district_threshold_not_met' END
"""
_RARE = """
, rare AS (SELECT DISTINCT level, start_date[1:7] AS month, start_date, code FROM bri WHERE ratio = 0 AND area = 1),
rmon AS (SELECT level, month, count(DISTINCT code) AS n FROM rare GROUP BY ALL)
"""

ORACLES = {
    "footprint_manifest": overlap_queries._BASE
    + """
, c AS (SELECT level, k, (SELECT count(DISTINCT (start_date, code)) FROM pairs p WHERE p.level = l.level) AS dn,
               (SELECT count(DISTINCT (start_date[1:7], code)) FROM pairs p WHERE p.level = l.level) AS mn
        FROM (VALUES ('province', 1), ('regency', 2), ('district', 3)) l(level, k)),
n AS (SELECT count(DISTINCT row_id) AS n FROM pairs WHERE level = 'district')
SELECT 'ok' AS status, (SELECT count(*) FROM sq) AS source_rows, (SELECT n FROM n) AS intersecting_events,
       (SELECT least(n, 500) FROM n) AS event_sample_size, string_agg(level || ':' || dn || ':' || mn, ',' ORDER BY k) AS level_row_counts
FROM c""",
    "gated_builds": admin_queries._COV
    + """
SELECT t.threshold, coverage_ratio < t.threshold OR coalesce((SELECT warning_code FROM gate) = 'missing_required_levels', false) AS stopped,
       coverage_ratio, admin_total
FROM cov, (VALUES (0.0::double), (0.5::double), (2.0::double)) t(threshold) WHERE level = 'district'""",
    "derived_regencies": geometry._TILES
    + f"""
, r AS (SELECT split_part(code, '.', 1) || '.' || split_part(code, '.', 2) AS code, round(sum({geometry._TILE_AREA}), 3) AS area_km2
        FROM tile WHERE level = 'district' GROUP BY 1)
SELECT r.code, CASE WHEN known THEN 'regency' END AS level, CASE WHEN known THEN name END AS name,
       CASE WHEN known THEN 'derived' END AS boundary_source, CASE WHEN known THEN area_km2 END AS area_km2,
       CASE WHEN NOT known THEN 'unknown unit' END AS reason
FROM (SELECT *, split_part(code, '.', 1) NOT IN ('11', '13') AS known FROM r) AS r JOIN adm ON adm.code = r.code""",
    "replaced_table": _LINES + "SELECT level, count(*) AS rows FROM day WHERE level <> 'province' GROUP BY level",
    "month_spine": _LINES
    + _RARE
    + """
, ends AS (SELECT level, min(month) AS a, max(month) AS b FROM rmon GROUP BY level),
spine AS (
  SELECT level, strftime(unnest(generate_series(CAST(a || '-01' AS DATE), CAST(b || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS month
  FROM ends)
SELECT spine.level, spine.month, coalesce(n, 0) AS rows, n IS NOT NULL AS observed
FROM spine LEFT JOIN rmon USING (level, month)""",
    "gap_shards": _LINES
    + _RARE
    + """
, ends AS (SELECT level, min(month) AS a, max(month) AS b FROM rmon GROUP BY level)
SELECT level, strftime(unnest(generate_series(CAST(a || '-01' AS DATE), CAST(b || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS month
FROM ends""",
    "broken_release": """
SELECT * FROM (VALUES
  ('required_assets', 'methodology', 'error', 'not among the published files'),
  ('manifest', 'build_manifest', 'error', 'search_index does not name its asset'),
  ('methodology', 'methodology', 'error', 'no text of kind note'),
  ('metrics', 'regency', 'error', 'no shard for month 1995-05'),
  ('metrics', 'summary', 'error', 'column outside the contract: extra'),
  ('features', 'province', 'error', 'features lack the property boundary_source'),
  ('features', 'regency', 'error', 'features lack the property boundary_source'),
  ('features', 'district', 'error', 'features lack the property boundary_source'),
  ('features', 'village', 'error', 'features lack the property boundary_source')
) t(check_id, asset, severity, message)""",
    "metric_assets": _LINES
    + """
SELECT level, string_agg(DISTINCT month_start[1:7], ',' ORDER BY month_start[1:7]) AS months,
       CAST(CASE level WHEN 'district' THEN 2 END AS INTEGER) AS trend_bundle_segments
FROM mon GROUP BY level""",
    "shard_keys": _LINES
    + """
SELECT level, CASE level WHEN 'district' THEN split_part(code, '.', 1) || '.' || split_part(code, '.', 2) ELSE code END AS shard_key,
       count(*) AS rows, count(DISTINCT code) AS units FROM mon GROUP BY ALL""",
    "methodology": _LINES
    + """
, t AS (SELECT max(unique_event_count) AS a, max(flood_days) AS b, max(sum_intersection_area_km2) AS c,
               max(max_coverage_ratio) AS d FROM alltime)
SELECT 'unique_event_count' AS metric, 'How many footprints touch the unit, one for each pair of footprint and unit.' AS definition, CAST(a AS DOUBLE) AS largest FROM t
UNION ALL SELECT 'flood_days', 'Days on which the unit has any footprint.', b FROM t
UNION ALL SELECT 'sum_intersection_area_km2', 'Square kilometres shared by footprints and the unit, added over all pairs.', c FROM t
UNION ALL SELECT 'max_coverage_ratio', 'Greatest part of the unit that any one footprint covers, between 0 and 1.', d FROM t""",
    "reference_manifest": _BND
    + f"""
SELECT 'reference' AS dataset, '{STAMP}' AS generated_at, string_agg(level, ',' ORDER BY k) AS available_levels,
       {_GATE} AS warning_code,
       'dim_admin_unit,bridge_village_postal_code,coverage_report,'
       || string_agg('dim_boundary_' || level, ',' ORDER BY k) AS artifacts,
       'dim_admin_unit,bridge_village_postal_code,coverage,' || string_agg('boundary_shapes/level=' || level, ',' ORDER BY k) AS paths
FROM (VALUES ('province', 1), ('regency', 2), ('district', 3), ('village', 4)) v(level, k)
WHERE level IN (SELECT level FROM bnd)""",
    "facts_manifest": _LINES
    + f"""
, c AS (SELECT level, (SELECT count(*) FROM day d WHERE d.level = l.level) AS dn,
               (SELECT count(*) FROM mon m WHERE m.level = l.level) AS mn, k
        FROM (VALUES ('province', 1), ('regency', 2), ('district', 3)) l(level, k))
SELECT '{STAMP}' AS generated_at, 'ok' AS status, (SELECT count(*) FROM lineitem) AS source_rows,
       (SELECT count(*) FROM lines) AS intersecting_events,
       least((SELECT count(*) FROM lines), 500) AS event_sample_size, 'province,regency,district' AS built_levels,
       string_agg(level || ':' || dn || ':' || mn, ',' ORDER BY k) AS level_row_counts,
       'village_metrics_skipped_by_default' AS warnings FROM c""",
    "release_manifest": _ALL
    + f"""
SELECT 'v1' AS dataset_version, 'province' AS default_level, 'unique_event_count' AS default_metric, 'id' AS default_language,
       (SELECT string_agg(level, ',' ORDER BY k) FROM (VALUES ('province', 1), ('regency', 2), ('district', 3)) v(level, k)
        WHERE level IN (SELECT level FROM bnd) AND level IN (SELECT level FROM mon)) AS available_levels,
       'unique_event_count,flood_days,sum_intersection_area_km2,max_coverage_ratio' AS metrics,
       CAST((SELECT count(DISTINCT month_start) FROM mon WHERE level = 'regency') AS INTEGER) AS regency_months,
       'ok' AS source_status, (SELECT count(*) FROM lines) AS intersecting_events,
       coalesce({_GATE}, '') AS warning_codes""",
    "validate_release": sql.with_(sql.ADMIN, reports._REPORTS, reports._NORM)
    + """
, known AS (SELECT DISTINCT source AS slug FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
fst AS (SELECT slug, arg_max(admin_code, (period_start, admin_code)) AS admin_code FROM st GROUP BY slug)
SELECT 'registry' AS check_id, 'regency index' AS asset, 'error' AS severity, count(*) AS messages
FROM (SELECT admin_code FROM fst JOIN known USING (slug) GROUP BY admin_code HAVING count(*) > 1) HAVING count(*) > 0""",
    "check_registry": sql.with_(sql.ADMIN)
    + """
, s AS (SELECT s_name, s_acctbal, code FROM supplier JOIN nat ON s_nationkey = n_nationkey)
SELECT 'registry' AS check_id, 'regency index' AS asset, 'error' AS severity, 'repeats admin_code ' || code AS message
FROM s GROUP BY code HAVING count(*) > 1
UNION ALL SELECT 'registry', s_name, 'error', 'admin_level differs from regency' FROM s WHERE s_acctbal < 0
UNION ALL SELECT 'registry', s_name, 'error', 'province_code is not the first segment of admin_code' FROM s WHERE split_part(code, '.', 1) <> '11'
UNION ALL SELECT 'registry', s_name, 'error', 'names a file that was not written: ' || s_name || '/s' FROM s
UNION ALL SELECT 'registry', s_name, 'error', 'names a file that was not written: ' || s_name || '/e' FROM s WHERE s_acctbal <= 0""",
    "check_metrics": _LINES
    + _RARE
    + """
SELECT 'metrics' AS check_id, level AS asset, 'error' AS severity, 'no shard for month ' || month AS message
FROM (SELECT DISTINCT level, month_start[1:7] AS month FROM mon EXCEPT SELECT level, month FROM rmon)
UNION ALL SELECT 'metrics', 'district', 'error', 'no trend bundle'""",
    "check_domains": """
SELECT DISTINCT 'qualitative' AS check_id, 'states' AS asset, 'error' AS severity, 'public_state outside its domain: ' || o_orderstatus AS message
FROM orders
UNION ALL SELECT 'qualitative', 'events', 'error', 'null in column source_name'
UNION ALL SELECT 'qualitative', 'events', 'error', 'lacks the column summary'
UNION ALL SELECT 'search_index', 'search_index', 'error', 'level outside its domain: village'""",
    "check_totals": _LINES
    + """
SELECT DISTINCT 'totals' AS check_id, level AS asset, 'error' AS severity, 'month and all-time facts differ' AS message
FROM alltime WHERE level = 'province'""",
    "refreshed_daily_facts": _LINES + "SELECT * FROM day",
    "refreshed_footprint_facts": overlap_queries.ORACLES["daily_facts"],
    "redelivered_footprint_facts": overlap_queries.ORACLES["daily_facts"],
    "unit_month_spine": _LINES
    + """
, umon AS (
  SELECT code, strftime(CAST(event_date AS DATE), '%Y-%m') AS month FROM day WHERE level = 'district' GROUP BY ALL),
ends AS (SELECT code, min(month) AS a, max(month) AS b FROM umon GROUP BY code),
spine AS (
  SELECT code, strftime(unnest(generate_series(CAST(a || '-01' AS DATE), CAST(b || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS month
  FROM ends)
SELECT spine.code, spine.month, CASE WHEN umon.code IS NULL THEN 0 ELSE 1 END AS rows, umon.code IS NOT NULL AS observed
FROM spine LEFT JOIN umon USING (code, month)""",
    "collection_features": sql.with_(sql.ADMIN, sql.TILES)
    + """
SELECT level, '{"type":"FeatureCollection","features":[' AS head, ']}' AS foot, count(*) - 1 AS commas, true AS first_without,
       count(*) AS features, min(code) AS least, max(code) AS most FROM tile GROUP BY level""",
}
