"""Interactive queries over month facts: windows, trends, search, map features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import codes, metrics
from tidemark.functions.dates import in_window
from tidemark.operators.facts import all_time
from tidemark.schemas import ADMIN_COLUMNS, BUNDLE_SEGMENTS, METRICS, PUBLIC_LEVELS, SEARCH_LIMIT

def month_of(df: DataFrame) -> Column:
    """The partition column when the shards carry one, else derived from the date."""
    return F.col("month") if "month" in df.columns else F.substring("month_start", 1, 7)


def observed_months(monthly: DataFrame) -> DataFrame:
    """Distinct months per level."""
    return monthly.select("level", month_of(monthly).alias("month")).distinct()


def window_defaults(monthly: DataFrame, level: str, month_from: str = "", month_to: str = "") -> DataFrame:
    """One row ``month_from, month_to``: a missing or unobserved end becomes the first or
    last observed month."""
    m = monthly.filter(F.col("level") == level).select(month_of(monthly).alias("month"))

    def pick(asked: str, fallback: Column) -> Column:
        return F.when(F.max((F.col("month") == asked).cast("int")) == 1, F.lit(asked)).otherwise(fallback)

    return m.agg(
        pick(month_from, F.min("month")).alias("month_from"),
        pick(month_to, F.max("month")).alias("month_to"),
    )


def normalize_window(month_from: Column, month_to: Column, moved: str) -> tuple[Column, Column]:
    """Moving one end past the other drags the other along."""
    if moved == "from":
        return month_from, F.greatest(month_from, month_to)
    return F.least(month_from, month_to), month_to


def window_rollup(
    monthly: DataFrame,
    level: str,
    month_from: str = "",
    month_to: str = "",
    summary: DataFrame | None = None,
    months: DataFrame | None = None,
) -> DataFrame:
    """Metrics per unit within the window and the mode that answered.

    The full window, or a window without months, is answered from the all-time summary.
    The choice reads one row of month bounds: from ``months`` (`release.metric_assets`, as the
    manifest lists them) or, without it, from the facts of the level. The window itself is a
    partition filter.
    """
    own = monthly.filter(F.col("level") == level)
    month = month_of(monthly)
    inside = in_window(month, month_from, month_to)
    if months is not None:
        listed = months.filter(F.col("level") == level).select(F.explode("months").alias("month"))
        bounds, seen, hit = listed, F.col("month"), in_window(F.col("month"), month_from, month_to)
    else:
        bounds, seen, hit = own, month, inside
    span = bounds.agg(
        F.min(seen).alias("lo"), F.max(seen).alias("hi"), F.max(hit.cast("int")).alias("any")
    ).first()
    full = (
        not span["any"]
        or ((not month_from or month_from == span["lo"]) and (not month_to or month_to == span["hi"]))
    )
    if full:
        rows = (summary if summary is not None else all_time(own)).filter(F.col("level") == level)
        return rows.select("code", *METRICS, F.lit("summary_all_time").alias("mode"))
    return all_time(own.filter(inside)).select("code", *METRICS, F.lit("date_window").alias("mode"))


def timeline(monthly: DataFrame, level: str, month_from: str = "") -> DataFrame:
    """For a fixed start, the window rollup of every observed end month.

    Each unit's own months are accumulated once, then held until its next own month; the
    window holds at most one row per calendar month of a unit.
    """
    own = monthly.filter(F.col("level") == level).withColumn("_m", month_of(monthly))
    own = own.filter(in_window(F.col("_m"), month_from, None))
    months = own.select("_m").distinct().agg(F.sort_array(F.collect_list("_m")).alias("ms"))
    along = Window.partitionBy("code").orderBy("_m")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    cumulative = own.select(
        "code",
        "_m",
        F.lead("_m").over(along).alias("_next"),
        F.sum("unique_event_count").over(upto).alias("unique_event_count"),
        F.sum("flood_days").over(upto).alias("flood_days"),
        F.sum("sum_intersection_area_km2").over(upto).alias("sum_intersection_area_km2"),
        F.max("max_coverage_ratio").over(upto).alias("max_coverage_ratio"),
    ).withColumn("_ms", months.scalar())
    held = F.filter(
        F.col("_ms"),
        lambda m: (m >= F.col("_m")) & (F.col("_next").isNull() | (m < F.col("_next"))),
    )
    return cumulative.select(F.explode(held).alias("month_to"), "code", *METRICS)


def trend(monthly: DataFrame, level: str, code: str, month_from: str = "", month_to: str = "") -> DataFrame:
    """Ordered month series of one unit. Shards carrying ``shard_key`` are pruned by it."""
    rows = monthly.filter((F.col("level") == level) & (F.col("code") == code))
    if "shard_key" in monthly.columns:
        k = BUNDLE_SEGMENTS.get(level, 0)
        key = ".".join(code.split(".")[:k]) if k else code
        rows = rows.filter(F.col("shard_key") == key)
    rows = rows.filter(in_window(month_of(monthly), month_from, month_to))
    return rows.select("code", "month_start", *METRICS).orderBy("month_start")


def trend_series(monthly: DataFrame, level: str, month_from: str = "", month_to: str = "") -> DataFrame:
    """All series of a level with the axis label of each point: both ends and every
    ceil(n/6)-th point show the year. A series has one row per calendar month."""
    rows = monthly.filter(F.col("level") == level)
    rows = rows.filter(in_window(month_of(monthly), month_from, month_to))
    along = Window.partitionBy("code").orderBy("month_start")
    whole = Window.partitionBy("code")
    ix = (F.row_number().over(along) - 1).alias("ix")
    numbered = rows.select("code", "month_start", *METRICS, ix, F.count(F.lit(1)).over(whole).alias("n"))
    step = F.greatest(F.lit(1), F.ceil(F.col("n") / 6))
    shown = (F.col("ix") == 0) | (F.col("ix") == F.col("n") - 1) | (F.col("ix") % step == 0)
    return numbered.withColumn(
        "axis_label", F.when(shown, F.substring("month_start", 1, 4)).otherwise(F.lit(""))
    )


def stats(lookup: DataFrame, features: DataFrame, metric: str, fallback_events: DataFrame | None = None) -> DataFrame:
    """Total events, units with data, rendered units; an empty lookup falls back to the
    build's count of intersecting events."""
    agg = lookup.agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("unique_event_count").alias("_events"),
        F.coalesce(F.sum((F.coalesce(F.col(metric), F.lit(0)) > 0).cast("long")), F.lit(0)).alias("units_with_data"),
    )
    other = F.lit(0).cast("long") if fallback_events is None else F.coalesce(fallback_events.scalar(), F.lit(0))
    rendered = features.agg(F.count(F.lit(1)).alias("n")).scalar()
    return agg.select(
        F.when(F.col("_n") > 0, F.coalesce("_events", F.lit(0))).otherwise(other).cast("long").alias("total_events"),
        "units_with_data",
        rendered.alias("rendered_units"),
    )


def metric_max(lookup: DataFrame, metric: str) -> DataFrame:
    """Largest value of a metric, never below zero."""
    v = F.coalesce(F.max(F.coalesce(F.col(metric), F.lit(0)).cast("double")), F.lit(0.0))
    return lookup.agg(F.greatest(v, F.lit(0.0)).alias("max_value"))


def with_parent(features: DataFrame, admin: DataFrame, level: str) -> DataFrame:
    """``parent_name``: the parent's name, else its code, else ``selection.no_parent``;
    provinces belong to ``selection.root_country``."""
    if level == "province":
        return features.withColumn("parent_name", F.lit("selection.root_country"))
    above = {"regency": "province", "district": "regency", "village": "district"}[level]
    parents = admin.filter(F.col("level") == above).select(
        F.col("code").alias("_pc"), F.col("name").alias("_pn")
    )
    named = features.join(parents, F.col(f"{above}_code") == F.col("_pc"), "left")
    parent = F.coalesce(
        F.nullif("_pn", F.lit("")), F.nullif(f"{above}_code", F.lit("")), F.lit("selection.no_parent")
    )
    return named.withColumn("parent_name", parent).drop("_pc", "_pn")


def map_features(
    boundaries: DataFrame,
    lookup: DataFrame,
    admin: DataFrame,
    level: str,
    metric: str,
    language: str = "en",
) -> DataFrame:
    """Boundary rows with metric value, coverage, bin, display text and parent; units
    without data show 0. The maximum is a scalar subquery over all units with data."""
    rows = lookup.select(
        F.col("code").alias("_c"),
        F.col(metric).cast("double").alias("_v"),
        F.col("max_coverage_ratio").alias("_cov"),
    )
    own = boundaries.filter(F.col("level") == level)
    joined = own.join(rows, F.col("code") == F.col("_c"), "left")
    value = F.coalesce(F.col("_v"), F.lit(0.0))
    out = joined.withColumn("metric_value", value).withColumn(
        "max_coverage_ratio", F.coalesce(F.col("_cov"), F.lit(0.0))
    )
    out = out.withColumn(
        "bin", metrics.color_bin(F.col("metric_value"), metric_max(lookup, metric).scalar())
    ).withColumn("metric_display", metrics.display_number(F.col("metric_value"), language))
    return with_parent(out.drop("_c", "_v", "_cov"), admin, level)


def selection_card(
    boundaries: DataFrame, lookup: DataFrame, admin: DataFrame, level: str, metric: str, code: str,
    language: str = "en",
) -> DataFrame:
    """The selected unit's card; both sides are filtered to one code before joining."""
    card = map_features(
        boundaries.filter(F.col("code") == code),
        lookup.filter(F.col("code") == code),
        admin,
        level,
        metric,
        language,
    )
    return card.select(
        "name",
        "code",
        "parent_name",
        F.coalesce(F.nullif("boundary_source", F.lit("")), F.lit("raw")).alias("boundary_source"),
        "metric_display",
        metrics.display_number(F.col("max_coverage_ratio"), language).alias("coverage_display"),
    )


def search_index(admin: DataFrame, levels: Sequence[str] = PUBLIC_LEVELS) -> DataFrame:
    """Units of the published levels; the index order is that of levels, then of names."""
    return admin.filter(F.col("level").isin(*levels)).select(*ADMIN_COLUMNS)


def search(
    index: DataFrame, queries: Sequence[str], levels: Sequence[str] = PUBLIC_LEVELS, k: int = SEARCH_LIMIT
) -> DataFrame:
    """First ``k`` units per query in index order, with the selection each hit resolves to.

    The index is scanned once for all queries; ``row_number <= k`` becomes a per-partition
    window group limit, so at most ``k`` rows per query and task are shuffled.
    """
    asked = sorted({q.strip().lower() for q in queries} - {""})
    if not asked:
        asked_col = F.expr("array()").cast("array<string>")
    else:
        asked_col = F.array(*(F.lit(q) for q in asked))
    name = F.lower("name")
    hits = F.filter(asked_col, lambda q: F.contains(name, q) | F.contains(F.col("code"), q))
    ranked = (
        index.filter(F.col("level").isin(*levels))
        .select(F.explode(hits).alias("query"), *index.columns)
        .withColumn(
            "position",
            F.row_number().over(
                Window.partitionBy("query").orderBy(codes.level_rank(F.col("level")), "name", "code")
            ),
        )
        .filter(F.col("position") <= k)
    )
    return resolve_selection(ranked, levels)


def resolve_selection(hits: DataFrame, levels: Sequence[str] = PUBLIC_LEVELS) -> DataFrame:
    """``resolved_level`` is the hit's own level when published, else the nearest published
    one; ``resolved_code`` is the hit's code at that level."""
    level = F.when(F.col("level").isin(*levels), F.col("level"))
    for candidate in ("district", "regency", "province"):
        if candidate in levels:
            level = F.coalesce(level, F.lit(candidate))
    code = F.col("code")
    for lv in ("province", "regency", "district", "village"):
        own = F.coalesce(F.nullif(f"{lv}_code", F.lit("")), F.col("code"))
        code = F.when(F.col("resolved_level") == lv, own).otherwise(code)
    return hits.withColumn("resolved_level", level).withColumn("resolved_code", code)


def available_levels(boundaries: DataFrame, monthly: DataFrame) -> DataFrame:
    """Public levels that have both boundaries and facts, in order."""
    b = boundaries.select("level").distinct()
    m = monthly.select("level").distinct()
    return (
        b.filter(F.col("level").isin(*PUBLIC_LEVELS))
        .join(m, "level", "left_semi")
        .withColumn("level_rank", codes.level_rank(F.col("level")))
    )


def pick_evidence(
    months: DataFrame, selections: DataFrame, month_from: str = "", month_to: str = ""
) -> DataFrame:
    """Evidence month per selected (level, code): the window's month when it is a single
    one, else the month with the highest internal score, later month on ties."""
    inside = months.join(selections, ["level", "code"], "left_semi")
    if month_from and month_from == month_to:
        inside = inside.filter(F.col("month") == month_from)
    else:
        if month_from:
            inside = inside.filter(F.col("month") >= month_from)
        if month_to:
            inside = inside.filter(F.col("month") <= month_to)
    best = F.max_by(
        F.struct("month", "path", "internal_score"),
        F.struct(F.coalesce("internal_score", F.lit(0.0)), "month"),
    )
    return inside.groupBy("level", "code").agg(best.alias("b")).select("level", "code", "b.*")


def highlighted_month(picked: DataFrame, month_from: str = "", month_to: str = "") -> DataFrame:
    """Month highlighted in the trend: the single-month window, else the evidence month."""
    single = F.lit(month_from) if month_from and month_from == month_to else F.lit(None)
    return picked.withColumn("highlighted_month", F.coalesce(single.cast("string"), F.col("month")))


def evidence_note_key(gap_signal: Column, internal: Column, external: Column) -> Column:
    mixed = F.when(internal >= external, F.lit("mixed.internal_higher")).otherwise(
        F.lit("mixed.external_higher")
    )
    return F.concat(
        F.lit("evidence.gap.note."), F.when(gap_signal == "mixed", mixed).otherwise(gap_signal)
    )


def evidence_tooltip(label: Column, vintage: Column, resolution: Column) -> Column:
    """Non-empty parts, one per line."""
    blank = F.lit("")
    return F.concat_ws("\n", *(F.nullif(c, blank) for c in (label, vintage, resolution)))


def coverage_banner(gate: DataFrame) -> DataFrame:
    """Message keys for the banner and its warning."""
    return gate.select(
        F.when(F.col("district_release_ready"), F.lit("panel.coverage_ready"))
        .otherwise(F.lit("panel.coverage_blocked"))
        .alias("banner_key"),
        F.coalesce(
            F.concat(F.lit("warning."), F.nullif("warning_code", F.lit(""))),
            F.lit("panel.coverage_reason"),
        ).alias("warning_key"),
    )


def extent_of(features: DataFrame) -> DataFrame:
    """Extent of all features of a level."""
    return features.agg(
        F.min("extent.xmin").alias("xmin"),
        F.min("extent.ymin").alias("ymin"),
        F.max("extent.xmax").alias("xmax"),
        F.max("extent.ymax").alias("ymax"),
    )
