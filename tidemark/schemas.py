"""Names, levels, thresholds and explicit schemas shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# Level names from coarse to fine, and the published subset.
LEVELS = ("province", "regency", "district", "village")
PUBLIC_LEVELS = ("province", "regency", "district")

# The four published metrics.
METRICS = (
    "unique_event_count",
    "flood_days",
    "sum_intersection_area_km2",
    "max_coverage_ratio",
)

# Release gates and default limits.
DISTRICT_THRESHOLD = 0.98
VILLAGE_THRESHOLD = 0.95
EVENT_SAMPLE_LIMIT = 500
SEARCH_LIMIT = 8
SIMPLIFY_TOLERANCE_DEG = 0.001
BUNDLE_SEGMENTS = {"district": 2}

# Overlaps at or below this many square metres are numeric noise of touching borders.
AREA_EPS_M2 = 1e-3

# The review states a period can publish.
PUBLIC_STATES = (
    "not_reviewed_yet",
    "reviewed_but_no_publishable_report",
    "has_featured_report_only",
    "has_featured_report_and_more",
)

ADMIN_COLUMNS = (
    "code",
    "name",
    "level",
    "province_code",
    "regency_code",
    "district_code",
    "village_code",
)

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

RING = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("ring", T.IntegerType()),
        T.StructField("pts", T.ArrayType(POINT)),
    ]
)

RINGS = T.ArrayType(RING)

EDGE = T.StructType(
    [
        T.StructField("x0", T.DoubleType()),
        T.StructField("y0", T.DoubleType()),
        T.StructField("x1", T.DoubleType()),
        T.StructField("y1", T.DoubleType()),
    ]
)

EDGES = T.ArrayType(EDGE)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ADMIN = _strings(*ADMIN_COLUMNS)

POSTAL = _strings("village_code", "postal_code")

FOOTPRINT = T.StructType(
    [
        T.StructField("uuid", T.StringType()),
        T.StructField("area_km2", T.DoubleType()),
        T.StructField("geometry", T.BinaryType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
    ]
)

METRIC_FIELDS = [
    T.StructField("unique_event_count", T.LongType()),
    T.StructField("flood_days", T.LongType()),
    T.StructField("sum_intersection_area_km2", T.DoubleType()),
    T.StructField("max_coverage_ratio", T.DoubleType()),
]

MONTH_FACT = T.StructType(
    [
        T.StructField("level", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("month_start", T.StringType()),
        *METRIC_FIELDS,
    ]
)

REPORT_COLUMNS = (
    "event_id",
    "event_date",
    "admin_level",
    "admin_code",
    "location_label",
    "source_name",
    "source_url",
    "source_date",
    "headline",
    "summary_id",
    "summary_en",
    "media_type",
    "media_url",
    "claim_type",
    "impact_tags",
    "canonical_event_group",
    "review_status",
    "verification_status",
    "match_confidence",
    "published",
    "evidence_scope",
    "is_supporting_evidence",
    "duplicate_group",
    "source_family_id",
    "time_window_start",
    "time_window_end",
)

REPORT = _strings(*REPORT_COLUMNS)

SUPPORTING_COLUMNS = (
    "event_id",
    "headline",
    "claim_type",
    "source_name",
    "source_url",
    "source_date",
    "media_type",
    "media_url",
)

SUPPORTING = _strings(*SUPPORTING_COLUMNS)

EVENT = T.StructType(
    [
        *_strings(
            "event_id",
            "event_date",
            "admin_level",
            "admin_code",
            "location_label",
            "source_name",
            "source_url",
            "source_date",
            "headline",
            "summary",
            "summary_id",
            "summary_en",
            "media_type",
            "media_url",
            "claim_type",
        ).fields,
        T.StructField("impact_tags", T.ArrayType(T.StringType())),
        *_strings("canonical_event_group", "period_start", "period_end").fields,
        T.StructField("supporting_records", T.ArrayType(SUPPORTING)),
    ]
)

# A row of written events: one with many supporting records continues on further pages.
EVENT_PAGE = T.StructType(
    [*EVENT.fields, T.StructField("slug", T.StringType()), T.StructField("page", T.IntegerType())]
)

STATE = T.StructType(
    [
        *_strings(
            "geography_period_id",
            "admin_level",
            "admin_code",
            "province_code",
            "period_start",
            "period_end",
            "public_state",
            "featured_event_id",
        ).fields,
        T.StructField("supporting_event_count", T.LongType()),
        *_strings("review_status_rollup", "reviewed_at").fields,
    ]
)

REGISTRY_ROW = T.StructType(
    [
        *_strings(
            "admin_code",
            "admin_level",
            "province_code",
            "slug",
            "events_path",
            "states_path",
            "updated_at",
        ).fields,
        T.StructField("public_state_summary", T.MapType(T.StringType(), T.LongType())),
    ]
)
