"""Release packaging: manifests, month spine, methodology."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codes import level_rank
from tidemark.operators.explore import month_of
from tidemark.schemas import BUNDLE_SEGMENTS, METRICS, PUBLIC_LEVELS

METRIC_DEFINITIONS = {
    "unique_event_count": "How many footprints touch the unit, one for each pair of footprint and unit.",
    "flood_days": "Days on which the unit has any footprint.",
    "sum_intersection_area_km2": "Square kilometres shared by footprints and the unit, added over all pairs.",
    "max_coverage_ratio": "Greatest part of the unit that any one footprint covers, between 0 and 1.",
}


SOURCES = ("dated footprints", "administrative units", "postal codes", "boundary dumps")
NOTES = ("district coverage gates a release", "villages are optional", "assets are built ahead", "figures are indicative")

# Where a release keeps its assets.
ASSET_PATHS = {"coverage_report": "coverage_report", "search_index": "search_index", "methodology": "methodology"}
ROUTE_VERSION = "1"
METRIC_FOLDERS = ("metrics/summary_all_time", "metrics/month", "metrics/trend")


def methodology_texts(spark: SparkSession, sources: Sequence[str] = SOURCES, notes: Sequence[str] = NOTES) -> DataFrame:
    """``kind, text`` of the sources and notes that go with the metrics."""
    rows = [("source", s) for s in sources] + [("note", n) for n in notes]
    return spark.createDataFrame(rows, "kind string, text string")


def methodology(spark: SparkSession) -> DataFrame:
    rows = [(m, METRIC_DEFINITIONS[m]) for m in METRICS]
    return spark.createDataFrame(rows, "metric string, definition string")


def month_spine(monthly: DataFrame) -> DataFrame:
    """Every calendar month between the observed ends of a level, with the rows it holds;
    gap months are empty shards and not ``observed``."""
    counts = monthly.select("level", month_of(monthly).alias("month")).groupBy("level", "month").agg(
        F.count(F.lit(1)).alias("rows")
    )

    def first(c: str):
        return F.to_date(F.concat(c, F.lit("-01")))

    ends = counts.groupBy("level").agg(first(F.min("month")).alias("a"), first(F.max("month")).alias("b"))
    spine = ends.select(
        "level", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("d")
    ).select("level", F.date_format("d", "yyyy-MM").alias("month"))
    return spine.join(counts, ["level", "month"], "left").select(
        "level", "month", F.coalesce("rows", F.lit(0)).alias("rows"), F.col("rows").isNotNull().alias("observed")
    )


def metric_assets(monthly: DataFrame) -> DataFrame:
    """Per public level: sorted observed months and the bundle segments of its trends."""
    months = monthly.filter(F.col("level").isin(*PUBLIC_LEVELS)).select(
        "level", month_of(monthly).alias("month")
    )
    segments = F.create_map(*(F.lit(x) for kv in BUNDLE_SEGMENTS.items() for x in kv))
    return months.groupBy("level").agg(F.sort_array(F.collect_set("month")).alias("months")).select(
        "level", "months", segments[F.col("level")].cast("int").alias("trend_bundle_segments")
    )


def _levels(df: DataFrame, name: str) -> DataFrame:
    """Distinct levels in order as one array row; at most four values."""
    ranked = df.select("level").distinct().select(F.struct(level_rank(F.col("level")).alias("k"), "level").alias("s"))
    return ranked.agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["level"]).alias(name))


def reference_manifest(boundaries: DataFrame, gate: DataFrame, generated_at: str) -> DataFrame:
    """One row: levels present, artifact names and paths under the build's folder, gate."""
    present = _levels(boundaries, "available_levels").scalar()
    out = gate.select(
        F.lit("reference").alias("dataset"),
        F.lit(generated_at).alias("generated_at"),
        present.alias("available_levels"),
        F.struct("district_threshold", "district_release_ready", "warning_code").alias("release_gate"),
    )
    fixed = F.array(F.lit("dim_admin_unit"), F.lit("bridge_village_postal_code"), F.lit("coverage_report"))
    named = F.transform("available_levels", lambda lv: F.concat(F.lit("dim_boundary_"), lv))
    folders = F.transform("available_levels", lambda lv: F.concat(F.lit("boundary_shapes/level="), lv))
    paths = F.concat(F.array(F.lit("dim_admin_unit"), F.lit("bridge_village_postal_code"), F.lit("coverage")), folders)
    return out.withColumn("artifacts", F.concat(fixed, named)).withColumn("artifact_paths", F.map_from_arrays("artifacts", paths))


def facts_manifest(
    counts: DataFrame,
    source_rows: DataFrame,
    intersecting: DataFrame,
    sample: DataFrame,
    warnings: DataFrame,
    generated_at: str,
) -> DataFrame:
    """One row: status, counts per level, warnings. ``counts`` is `facts.row_counts`,
    ``source_rows`` and ``intersecting`` one-row counts, ``warnings`` has ``warning``."""
    levels = _levels(counts, "built_levels").scalar()
    ordered = F.sort_array(
        F.collect_list(F.struct(level_rank(F.col("level")).alias("k"), "level", "day_rows", "month_rows"))
    )
    per_level = counts.agg(
        F.transform(
            ordered,
            lambda r: F.struct(
                r["level"].alias("level"), r["day_rows"].alias("day_rows"), r["month_rows"].alias("month_rows")
            ),
        ).alias("r")
    ).scalar()
    built = warnings.agg(F.sort_array(F.collect_set("warning")).alias("warnings"))
    return built.select(
        F.lit(generated_at).alias("generated_at"),
        F.when(F.size(levels) > 0, F.lit("ok")).otherwise(F.lit("no_intersections_found")).alias("status"),
        source_rows.scalar().alias("source_rows"),
        intersecting.scalar().alias("intersecting_events"),
        sample.agg(F.count(F.lit(1)).alias("n")).scalar().alias("event_sample_size"),
        levels.alias("built_levels"),
        per_level.alias("level_row_counts"),
        "warnings",
    )


def missing_source_manifest(spark: SparkSession, path: str, generated_at: str) -> DataFrame:
    """Status row of a build whose footprint source is absent."""
    return spark.createDataFrame(
        [(generated_at, "missing_source", f"footprint source not found at {path}", [])],
        "generated_at string, status string, warning string, built_levels array<string>",
    )


def release_manifest(
    available: DataFrame, assets: DataFrame, facts: DataFrame, gate: DataFrame, version: str, generated_at: str
) -> DataFrame:
    """One row: version, defaults, levels, asset paths, months per level, where the reports
    are, facts status, warning codes."""

    def at(folder: str):
        return F.concat(F.lit(f"{folder}/level="), "level").alias(folder.split("/")[-1])

    levels = available.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("level_rank", "level"))), lambda s: s["level"]).alias("l")
    ).scalar()
    boundaries = available.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("level", at("boundaries"))))).alias("m")
    ).scalar()
    by_level = assets.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("level", F.struct("months", "trend_bundle_segments", *map(at, METRIC_FOLDERS)))))).alias("m")
    ).scalar()
    codes = gate.agg(F.sort_array(F.collect_set("warning_code")).alias("w")).scalar()
    return facts.select(
        F.lit(version).alias("dataset_version"),
        F.lit(generated_at).alias("generated_at"),
        F.lit("province").alias("default_level"),
        F.lit(METRICS[0]).alias("default_metric"),
        F.lit("id").alias("default_language"),
        levels.alias("available_levels"),
        F.array(*(F.lit(m) for m in METRICS)).alias("metrics"),
        by_level.alias("metric_assets"),
        boundaries.alias("boundary_assets"),
        *(F.lit(path).alias(name) for name, path in ASSET_PATHS.items()),
        F.struct(
            F.lit("events").alias("global_events_path"),
            F.lit("states").alias("global_states_path"),
            F.lit("regencies").alias("regency_index_path"),
            F.lit("regencies").alias("regency_assets_base_path"),
            F.array(*(F.lit(v) for v in PUBLIC_LEVELS)).alias("supported_levels"),
            F.lit(ROUTE_VERSION).alias("route_version"),
        ).alias("qualitative"),
        F.col("status").alias("source_status"),
        F.struct("intersecting_events", "built_levels", "event_sample_size").alias("source_summary"),
        codes.alias("warning_codes"),
    )


