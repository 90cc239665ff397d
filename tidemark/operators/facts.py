"""Day, month and all-time facts from the footprint x unit bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start
from tidemark.operators import geometry
from tidemark.operators.ranking import staged_rank
from tidemark.schemas import EVENT_SAMPLE_LIMIT, VILLAGE_THRESHOLD
from tidemark.session import cut_lineage


def daily_facts(bridge: DataFrame) -> DataFrame:
    """Pairs per (start date, unit). ``unique_event_count`` counts bridge rows, so a uuid
    that occurs twice in the source counts twice; `postal_rollup` has the distinct form."""
    return (
        bridge.groupBy(F.col("start_date").alias("event_date"), "level", "code")
        .agg(
            F.count(F.lit(1)).alias("unique_event_count"),
            F.sum("intersection_area_km2").alias("sum_intersection_area_km2"),
            F.max("coverage_ratio").alias("max_coverage_ratio"),
        )
        .withColumn("flood_days", F.lit(1).cast("long"))
    )


def _fold(df: DataFrame, keys: list[str], days: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("unique_event_count").cast("long").alias("unique_event_count"),
        days.cast("long").alias("flood_days"),
        F.sum("sum_intersection_area_km2").alias("sum_intersection_area_km2"),
        F.max("max_coverage_ratio").alias("max_coverage_ratio"),
    )


def monthly_facts(daily: DataFrame) -> DataFrame:
    """Days folded to months; every day row is one flood day."""
    months = daily.withColumn("month_start", month_start(F.col("event_date")))
    return _fold(months, ["level", "code", "month_start"], F.count(F.lit(1)))


def all_time(monthly: DataFrame) -> DataFrame:
    """Months folded to one row per unit."""
    return _fold(monthly, ["level", "code"], F.sum("flood_days"))


#: Row ids, of some tens of bytes each, that a sample may broadcast.
BROADCAST_IDS = 100_000


def _time(df: DataFrame) -> list[str]:
    return [c for c in ("event_date", "month_start") if c in df.columns]


def fact_order(df: DataFrame) -> DataFrame:
    """Facts as written: by level, then time when there is one, then code."""
    return df.orderBy("level", *_time(df), "code")


def fact_positions(df: DataFrame) -> DataFrame:
    """Each fact with its ``position`` in that order, counted per level and time."""
    return staged_rank(df, [], [F.col(c) for c in ("level", *_time(df))], [F.col("code").asc()])


def bad_dates(footprints: DataFrame) -> DataFrame:
    """Count of start dates that are no calendar date; they still keep their sliced keys."""
    return footprints.agg(
        F.count_if(F.expr("try_cast(start_date AS DATE) IS NULL")).alias("bad_start_dates")
    )


def distinct_events(bridge: DataFrame, level: str = "district") -> DataFrame:
    """Number of source rows with a positive overlap at one level."""
    rows = bridge.filter(F.col("level") == level).select("row_id").distinct()
    return rows.agg(F.count(F.lit(1)).alias("intersecting_events"))


def event_sample(
    footprints: DataFrame,
    bridge: DataFrame,
    n: int = EVENT_SAMPLE_LIMIT,
    order: tuple[str, ...] = ("row_id",),
) -> DataFrame:
    """First ``n`` intersecting footprints in source order, with the rings of their repair where
    a column ``valid`` tells that it takes one.

    The ``n`` rows are found on row ids and order columns alone (a top-n per task), so that
    geometry is joined to a broadcast of ``n`` ids, up to `BROADCAST_IDS`, and not shuffled.
    """
    hits = bridge.filter(F.col("level") == "district").select("row_id")
    if order == ("row_id",):
        placed = hits.distinct()
    else:
        placed = footprints.select("row_id", *order).join(hits, "row_id", "left_semi")
    first = placed.orderBy(*order).limit(n).select("row_id")
    found = footprints.join(F.broadcast(first) if n <= BROADCAST_IDS else first, "row_id")
    if "valid" in found.columns:
        found = geometry.repaired(cut_lineage(found.select("row_id", *(c for c in order if c != "row_id"), "uuid", "start_date", "end_date", "footprint_area_km2", "rings", "valid")))
    return (
        found.orderBy(*order)
        .select(
            "uuid",
            "start_date",
            F.when(F.coalesce(F.col("end_date"), F.lit("")) == "", F.col("start_date"))
            .otherwise(F.col("end_date"))
            .alias("end_date"),
            F.col("footprint_area_km2").alias("area_km2"),
            "rings",
        )
    )


def row_counts(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """Day and month rows per built level."""
    d = daily.groupBy("level").agg(F.count(F.lit(1)).alias("day_rows"))
    m = monthly.groupBy("level").agg(F.count(F.lit(1)).alias("month_rows"))
    return d.join(m, "level", "left").fillna(0, ["month_rows"])


def village_day(bridge: DataFrame, postal: DataFrame) -> DataFrame:
    """Village facts with postal code; pair count and distinct uuid count side by side."""
    days = (
        bridge.filter(F.col("level") == "village")
        .groupBy(F.col("start_date").alias("event_date"), F.col("code").alias("village_code"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("uuid").alias("unique_event_count"),
            F.sum("intersection_area_km2").alias("sum_intersection_area_km2"),
            F.max("coverage_ratio_of_unit").alias("max_coverage_ratio_of_village"),
        )
    )
    return days.join(postal, "village_code", "left")


def postal_rollup(bridge: DataFrame, postal: DataFrame) -> DataFrame:
    """Facts per (start date, postal code); one footprint over several villages of a code
    counts once in ``unique_event_count``."""
    villages = bridge.filter(F.col("level") == "village")
    return (
        villages.join(postal, villages["code"] == postal["village_code"])
        .groupBy(F.col("start_date").alias("event_date"), "postal_code")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("uuid").alias("unique_event_count"),
            F.sum("intersection_area_km2").alias("sum_intersection_area_km2"),
            F.max("coverage_ratio_of_unit").alias("max_coverage_ratio"),
        )
    )


def enabled_levels(
    include_village: bool, coverage: DataFrame, threshold: float = VILLAGE_THRESHOLD
) -> DataFrame:
    """Levels to build with the reason when village is left out; ``coverage`` is the
    overall table of `operators.admin.coverage`."""
    ratio = F.coalesce(
        F.max(F.when(F.col("level") == "village", F.col("coverage_ratio"))), F.lit(0.0)
    )
    on = F.lit(include_village)
    warning = F.when(~on, F.lit("village_metrics_skipped_by_default")).when(
        F.col("ratio") < threshold, F.lit("village_metrics_skipped_low_coverage")
    )
    base = F.array(F.lit("province"), F.lit("regency"), F.lit("district"))
    return (
        coverage.agg(ratio.alias("ratio"))
        .select(warning.alias("warning"))
        .select(
            F.when(F.col("warning").isNull(), F.concat(base, F.array(F.lit("village"))))
            .otherwise(base)
            .alias("levels"),
            "warning",
        )
    )
