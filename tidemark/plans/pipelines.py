"""The build stages end to end: reference geography, facts, reports, release.

Stages hand over through written tables; each may run on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import admin, explore, facts, geometry, overlap, qualitative, release
from tidemark.schemas import (
    ADMIN_COLUMNS,
    EVENT_SAMPLE_LIMIT,
    PUBLIC_LEVELS,
    SIMPLIFY_TOLERANCE_DEG,
    VILLAGE_THRESHOLD,
)
from tidemark.session import cut_lineage
from tidemark.sinks import writers
from tidemark.sources import assets, dumps, footprints
from tidemark.sources.reports import read_reports, report_slugs

BOUNDARY_COLUMNS = (
    *ADMIN_COLUMNS,
    "postal_code",
    "centroid_lat",
    "centroid_lng",
    "boundary_source",
    "rings",
    "edges",
    "extent",
)


def derive_levels(members: DataFrame, units: DataFrame, postal: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dissolved boundaries of the missing levels, and ``code, reason`` of units without one:
    those whose members have no closed outline, and outlines of codes that name no unit."""
    found, rejects = geometry.dissolve_with_rejects(members)
    shapes = found.withColumnRenamed("target_code", "code")
    unknown = shapes.join(units, "code", "left_anti").select("code", F.lit("unknown unit").alias("reason"))
    rejects = rejects.withColumnRenamed("target_code", "code").unionByName(unknown)
    named = admin.with_postal(units.join(shapes, "code"), postal)
    placed = geometry.with_centroids(named).withColumn("boundary_source", F.lit("derived"))
    return dumps.with_shapes(placed).select(*BOUNDARY_COLUMNS), rejects


def build_reference(
    spark: SparkSession, admin_dump: str, postal_dump: str, boundary_root: str, out: str, generated_at: str
) -> None:
    """Hierarchy, postal bridge, boundaries of all levels, coverage and gate."""
    rows = dumps.read_admin(spark, admin_dump)
    units = dumps.read_units(spark, admin_dump)
    postal = dumps.read_postal(spark, postal_dump)
    raw = cut_lineage(admin.enrich_boundaries(dumps.read_boundaries(spark, boundary_root), units, postal))
    kept, members = admin.choose_levels(raw, units)
    derived, rejects = derive_levels(members, units, postal)
    writers.write_table(rejects, f"{out}/rejected_units")
    boundaries = cut_lineage(kept.select(*BOUNDARY_COLUMNS).unionByName(derived))
    overall = admin.coverage(rows, boundaries)
    gate = admin.release_gate(overall)

    writers.write_table(rows, f"{out}/dim_admin_unit")
    writers.write_table(postal, f"{out}/bridge_village_postal_code")
    writers.write_table(boundaries, f"{out}/boundary_shapes", "level")
    writers.write_geo(boundaries, f"{out}/dim_boundary")
    writers.write_geojson(boundaries, f"{out}/dim_boundary_geojson")
    writers.write_table(overall, f"{out}/coverage/overall")
    writers.write_table(admin.coverage_by_province(rows, boundaries), f"{out}/coverage/by_province")
    writers.write_table(admin.source_mix(boundaries), f"{out}/coverage/source_mix")
    writers.write_table(gate, f"{out}/coverage/gate")
    writers.write_table(admin.reference_summary(rows, postal, boundaries), f"{out}/reference_summary")
    manifest = release.reference_manifest(boundaries, gate, generated_at)
    writers.write_document(manifest.select(F.struct("*").alias("doc")), f"{out}/reference_manifest")


def build_facts(
    spark: SparkSession,
    footprint_path: str,
    reference: str,
    out: str,
    generated_at: str,
    include_village: bool = False,
    village_threshold: float = VILLAGE_THRESHOLD,
    sample_limit: int = EVENT_SAMPLE_LIMIT,
) -> None:
    """Bridge, day, month and all-time facts, event sample and manifest. An absent source
    leaves a status document only; a closed gate stops the build."""
    if not assets.path_exists(spark, footprint_path):
        gone = release.missing_source_manifest(spark, footprint_path, generated_at)
        writers.write_document(gone.select(F.struct("*").alias("doc")), f"{out}/facts_manifest")
        return
    admin.assert_release_ready(spark.read.parquet(f"{reference}/coverage/gate"))
    enabled = facts.enabled_levels(
        include_village, spark.read.parquet(f"{reference}/coverage/overall"), village_threshold
    )
    units = spark.read.parquet(f"{reference}/boundary_shapes").join(
        enabled.select(F.explode("levels").alias("level")), "level", "left_semi"
    )
    fragments = cut_lineage(overlap.unit_fragments(units))
    source, rejects = footprints.scan_footprints(spark, footprint_path)
    writers.write_table(rejects, f"{out}/rejected_footprints")
    prints = overlap.within_extent(source, units)
    writers.write_table(overlap.bridge(prints, fragments), f"{out}/bridge", "level")
    bridge = spark.read.parquet(f"{out}/bridge")

    pairs = bridge.withColumnRenamed("coverage_ratio_of_unit", "coverage_ratio")
    writers.write_table(facts.fact_order(facts.daily_facts(pairs)), f"{out}/fact_day", "level")
    daily = spark.read.parquet(f"{out}/fact_day")
    writers.write_table(facts.fact_order(facts.monthly_facts(daily)), f"{out}/fact_month", "level")
    monthly = spark.read.parquet(f"{out}/fact_month")
    writers.write_table(facts.all_time(monthly), f"{out}/fact_all_time", "level")
    if include_village:
        postal = spark.read.parquet(f"{reference}/bridge_village_postal_code")
        writers.write_table(facts.village_day(bridge, postal), f"{out}/fact_village_day")
        writers.write_table(facts.postal_rollup(bridge, postal), f"{out}/fact_postal_day")

    sample = cut_lineage(facts.event_sample(prints, bridge, sample_limit, ("source_file", "source_row")))
    writers.write_geo(sample, f"{out}/fact_event_sample")
    manifest = release.facts_manifest(
        facts.row_counts(daily, monthly),
        spark.read.parquet(footprint_path).agg(F.count(F.lit(1)).alias("n")),
        facts.distinct_events(bridge),
        sample,
        enabled.select("warning"),
        generated_at,
    )
    writers.write_table(manifest, f"{out}/facts_manifest_table")
    writers.write_document(manifest.select(F.struct("*").alias("doc")), f"{out}/facts_manifest")


def build_reports(spark: SparkSession, reviewed: str, out: str, reviewed_at: str) -> None:
    """Events with nested records, states and the per-slug bundles."""
    reports = cut_lineage(qualitative.normalize_reports(read_reports(spark, reviewed)))
    ranked = cut_lineage(qualitative.rank_reports(reports))
    featured = qualitative.build_events(ranked)
    nested = qualitative.nest_supporting(featured, qualitative.supporting_records(ranked))
    states = qualitative.build_states(reports, featured, reviewed_at)
    writers.write_table(nested, f"{out}/events")
    writers.write_table(states, f"{out}/states")
    slugs = report_slugs(spark, reviewed)
    published = qualitative.bundle_order(spark.read.parquet(f"{out}/events"), "event_date", "event_id")
    writers.write_bundles(published, slugs, f"{out}/regencies/events")
    reviewed_states = qualitative.bundle_order(spark.read.parquet(f"{out}/states"), "period_start", "admin_code")
    writers.write_bundles(reviewed_states, slugs, f"{out}/regencies/states")
    writers.write_table(slugs, f"{out}/slugs")


def package_release(
    spark: SparkSession, reference: str, built: str, reports: str, out: str, version: str, generated_at: str
) -> dict[str, DataFrame]:
    """Write shards, boundaries, index, registry and manifest; returns the written assets
    for `operators.validation.validate_release`."""
    read = spark.read.parquet
    monthly = read(f"{built}/fact_month").filter(F.col("level").isin(*PUBLIC_LEVELS))
    daily = read(f"{built}/fact_day").filter(F.col("level").isin(*PUBLIC_LEVELS))
    total = read(f"{built}/fact_all_time").filter(F.col("level").isin(*PUBLIC_LEVELS))
    shapes = read(f"{reference}/boundary_shapes")
    available = cut_lineage(explore.available_levels(shapes, monthly))
    public = shapes.join(available.select("level"), "level", "left_semi")
    units = read(f"{reference}/dim_admin_unit").join(available.select("level"), "level", "left_semi")
    gate = read(f"{reference}/coverage/gate")

    writers.write_month_shards(monthly, f"{out}/metrics/month")
    writers.write_trend_shards(monthly, f"{out}/metrics/trend")
    writers.write_table(total, f"{out}/metrics/summary_all_time", "level")
    writers.write_geojson(public, f"{out}/boundaries", SIMPLIFY_TOLERANCE_DEG)
    writers.write_table(explore.search_index(units), f"{out}/search_index")
    writers.write_table(release.methodology(spark), f"{out}/methodology/metrics")
    writers.write_table(release.methodology_texts(spark), f"{out}/methodology/texts")
    writers.write_feature_collections(public, f"{out}/boundary_collections", SIMPLIFY_TOLERANCE_DEG)
    writers.write_table(read(f"{reference}/coverage/overall"), f"{out}/coverage_report/overall")
    writers.write_table(read(f"{reference}/coverage/by_province"), f"{out}/coverage_report/by_province")
    writers.write_table(gate, f"{out}/coverage_report/gate")

    events, states = read(f"{reports}/events"), read(f"{reports}/states")
    files = assets.bundle_files(spark, f"{reports}/regencies")
    named = qualitative.regency_index(
        files,
        events.filter("page = 0").withColumn("position", F.struct("event_date", "event_id")),
        states.withColumn("position", F.struct("period_start", "admin_code")),
    )
    writers.write_table(named.filter("admin_code IS NOT NULL"), f"{out}/regencies")
    months = release.metric_assets(monthly)
    manifest = release.release_manifest(
        available, months, read(f"{built}/facts_manifest_table"), gate, version, generated_at
    )
    writers.write_table(manifest, f"{out}/build_manifest")
    return {
        "assets": assets.folder_names(spark, out),
        "manifest": read(f"{out}/build_manifest"),
        "coverage": read(f"{reference}/coverage/overall"),
        "coverage_by_province": read(f"{reference}/coverage/by_province"),
        "gate": gate,
        "methodology": read(f"{out}/methodology/metrics"),
        "methodology_texts": read(f"{out}/methodology/texts"),
        "features": assets.read_features(spark, f"{out}/boundaries"),
        "search_index": read(f"{out}/search_index"),
        "boundaries": public,
        "metric_assets": months,
        "month_shards": assets.read_month_shards(spark, f"{out}/metrics/month"),
        "trend_shards": assets.read_trend_shards(spark, f"{out}/metrics/trend"),
        "summary": read(f"{out}/metrics/summary_all_time"),
        "events": events,
        "states": states,
        "registry": read(f"{out}/regencies"),
        "files": files,
        "daily": daily,
        "monthly": monthly,
    }
