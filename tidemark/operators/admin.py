"""Administrative hierarchy: enrichment, level choice, coverage and the release gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codes
from tidemark.schemas import ADMIN_COLUMNS, DISTRICT_THRESHOLD, LEVELS


def classify(rows: DataFrame) -> DataFrame:
    """Admin rows from ``code, name``; malformed codes are left to `rejected_codes`."""
    h = codes.hierarchy(F.col("code"))
    out = rows.select("code", "name", *(c.alias(n) for n, c in h.items()))
    return out.filter(F.col("level").isNotNull()).select(*ADMIN_COLUMNS)


def rejected_codes(rows: DataFrame) -> DataFrame:
    """Rows whose code has no level."""
    return rows.filter(codes.level_of(F.col("code")).isNull())


def last_wins(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """Latest row per key by source position, as a map-side combined ``max_by``."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*position)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


def enrich_boundaries(boundaries: DataFrame, admin: DataFrame, postal: DataFrame) -> DataFrame:
    """Boundary rows joined to their unit by code; unmatched boundaries are dropped, names
    and ancestors come from the unit, postal codes apply to villages only."""
    own = [c for c in boundaries.columns if c not in ADMIN_COLUMNS]
    joined = boundaries.select("code", *own).join(admin.select(*ADMIN_COLUMNS), "code")
    return with_postal(joined, postal).select(*ADMIN_COLUMNS, "postal_code", *own)


def with_postal(units: DataFrame, postal: DataFrame) -> DataFrame:
    p = postal.select(F.col("village_code").alias("_v"), F.col("postal_code").alias("_p"))
    hit = (F.col("level") == "village") & (F.col("code") == F.col("_v"))
    return units.join(p, hit, "left").withColumn("postal_code", F.col("_p")).drop("_v", "_p")


def level_sources(present: DataFrame) -> DataFrame:
    """Which rows each level is built from, given the distinct raw levels present.

    A level with any raw row keeps its raw rows only; otherwise it is dissolved from the
    next lower level that ended up non-empty.
    """
    has = {
        lv: F.coalesce(F.max(F.when(F.col("level") == lv, 1)), F.lit(0)) == 1 for lv in LEVELS
    }
    flags = present.agg(*(c.alias(lv) for lv, c in has.items()))
    rows = []
    for i, lv in enumerate(LEVELS):
        source = F.lit(None).cast("string")
        for low in reversed(LEVELS[i:]):
            source = F.when(F.col(low), F.lit(low)).otherwise(source)
        rows.append(F.struct(F.lit(lv).alias("level"), source.alias("source_level")))
    return flags.select(F.inline(F.array(*rows))).filter("source_level IS NOT NULL")


def choose_levels(raw: DataFrame, admin: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw rows to keep, and lower rows to dissolve with their ``target_level`` and
    ``target_code``. ``raw`` is enriched; the plan table has at most four rows."""
    plan = F.broadcast(level_sources(raw.select("level").distinct()))
    kept = raw.join(plan.filter("level = source_level").select("level"), "level", "left_semi")
    todo = plan.filter("level <> source_level").select(
        F.col("level").alias("target_level"), "source_level"
    )
    target = F.lit(None).cast("string")
    for lv in LEVELS:
        target = F.when(F.col("target_level") == lv, codes.parent_code(lv)).otherwise(target)
    members = (
        raw.join(todo, F.col("level") == F.col("source_level"))
        .withColumn("target_code", target)
        .filter(F.coalesce(F.col("target_code"), F.lit("")) != "")
    )
    # A level derived on the way up must be a known unit too, or its members stop there.
    members = members.withColumn("_k0", F.col("target_code"))
    keys = ["_k0"]
    rank, top, low = codes.level_rank, F.col("target_level"), F.col("source_level")
    for lv in LEVELS[1:3]:
        between = (rank(top) < rank(F.lit(lv))) & (rank(F.lit(lv)) < rank(low))
        members = members.withColumn(
            f"_{lv}", F.when(between, codes.parent_code(lv)).otherwise(F.col("target_code"))
        )
        keys.append(f"_{lv}")
    for k in keys:
        members = members.join(admin.select(F.col("code").alias(k)), k, "left_semi")
    return kept, members.drop(*keys)


def admin_totals(admin: DataFrame) -> DataFrame:
    """Units per level and per (level, province) in one pass; ``province_code`` is null in
    the per-level rows."""
    return (
        admin.groupingSets(
            [["level"], ["level", "province_code"]], "level", "province_code"
        )
        .agg(F.count(F.lit(1)).alias("admin_total"), F.grouping_id().alias("_g"))
        .withColumn("per_province", F.col("_g") == 0)
        .drop("_g")
    )


def _ratio(found: Column, total: Column) -> Column:
    """Found over total, six decimals half-even; 0 without units."""
    return F.when(total > 0, F.bround(found / total, 6)).otherwise(F.lit(0.0))


def coverage(admin: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Overall coverage, one row per level, whatever rows exist."""
    spine = admin.sparkSession.createDataFrame([(lv,) for lv in LEVELS], "level string")
    totals = admin.groupBy("level").agg(F.count(F.lit(1)).alias("admin_total"))
    found = boundaries.groupBy("level").agg(F.countDistinct("code").alias("boundary_total"))
    return (
        spine.join(totals, "level", "left")
        .join(found, "level", "left")
        .fillna(0, ["admin_total", "boundary_total"])
        .withColumn("coverage_ratio", _ratio(F.col("boundary_total"), F.col("admin_total")))
    )


def coverage_by_province(admin: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Coverage per province and level; every known province has all four levels."""
    provinces = admin.filter(F.coalesce(F.col("province_code"), F.lit("")) != "")
    levels = F.explode(F.array(*(F.lit(lv) for lv in LEVELS))).alias("level")
    spine = provinces.select("province_code").distinct().select("province_code", levels)
    keys = ["province_code", "level"]
    totals = admin.groupBy(*keys).agg(F.count(F.lit(1)).alias("admin_total"))
    found = boundaries.groupBy(*keys).agg(F.countDistinct("code").alias("boundary_total"))
    return (
        spine.join(totals, keys, "left")
        .join(found, keys, "left")
        .fillna(0, ["admin_total", "boundary_total"])
        .withColumn("coverage_ratio", _ratio(F.col("boundary_total"), F.col("admin_total")))
    )


def source_mix(boundaries: DataFrame) -> DataFrame:
    """Boundary rows (not distinct codes) per level and source."""
    return boundaries.groupBy("level", "boundary_source").agg(F.count(F.lit(1)).alias("rows"))


def release_gate(overall: DataFrame, threshold: float = DISTRICT_THRESHOLD) -> DataFrame:
    """One row: threshold, readiness, and the warning with missing levels taking precedence."""

    def of(level: str, value: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("level") == level, F.col(value))), F.lit(0))

    required = (
        (of("province", "boundary_total") > 0)
        & (of("regency", "boundary_total") > 0)
        & (of("district", "boundary_total") > 0)
    )
    return (
        overall.agg(required.alias("_all"), of("district", "coverage_ratio").alias("_ratio"))
        .select(
            F.lit(threshold).alias("district_threshold"),
            (F.col("_all") & (F.col("_ratio") >= threshold)).alias("district_release_ready"),
            F.when(~F.col("_all"), F.lit("missing_required_levels"))
            .when(F.col("_ratio") < threshold, F.lit("district_threshold_not_met"))
            .alias("warning_code"),
        )
    )


def assert_release_ready(gate: DataFrame) -> None:
    """Stop a build whose gate is closed; reads the gate's single row."""
    row = gate.select("district_release_ready").first()
    if row is None or not row["district_release_ready"]:
        raise RuntimeError("district release gate is not ready; rebuild the geography first")


def reference_summary(admin: DataFrame, postal: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Named row counts of one reference build."""
    named = [
        admin.agg(F.lit("admin_units").alias("item"), F.count(F.lit(1)).alias("rows")),
        postal.agg(F.lit("postal_rows").alias("item"), F.count(F.lit(1)).alias("rows")),
    ]
    spine = admin.sparkSession.createDataFrame([(lv,) for lv in LEVELS], "level string")
    per_level = (
        spine.join(boundaries.groupBy("level").agg(F.count(F.lit(1)).alias("rows")), "level", "left")
        .select(F.concat("level", F.lit("_boundaries")).alias("item"), F.coalesce("rows", F.lit(0)).alias("rows"))
    )
    return named[0].unionByName(named[1]).unionByName(per_level)
