"""Reviewed reports to events, review states, registry and per-place summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import media, text
from tidemark.functions.codes import province_of
from tidemark.functions.dates import (
    in_window,
    month_slice,
    month_token,
    normalize_date,
    period_end,
    period_start,
)
from tidemark.operators.ranking import staged_rank
from tidemark.schemas import REPORT_COLUMNS, SUPPORTING_COLUMNS

GROUP = ["slug", "admin_code", "period_start", "period_end", "event_group"]
PERIOD = ["slug", "admin_code", "period_start", "period_end"]


def normalize_reports(raw: DataFrame) -> DataFrame:
    """Ordered fix-ups of reviewed rows; later steps see the result of earlier ones."""
    e = text.or_empty
    df = raw.select(
        "slug", "source_row", *(e(F.col(c)).alias(c) for c in REPORT_COLUMNS)
    )
    c = F.col
    df = df.withColumn(
        "verification_status",
        F.when(text.lowered(c("match_confidence")) == "publishable", F.lit("publishable")).otherwise(
            c("verification_status")
        ),
    )
    matched = (text.lowered(c("review_status")) == "manual_match") & (
        text.lowered(c("duplicate_group")) == "reviewed"
    )
    scoped = ~text.parse_bool(c("published")) & text.parse_bool(c("evidence_scope"))
    no_source_date = normalize_date(c("source_date")) == ""
    family = text.strip(c("source_family_id"))
    duplicate = F.startswith(text.strip(c("claim_type")), F.lit("dup-")) & (family != "")
    fallback = text.strip(c("impact_tags"))
    borrow = (
        text.lowered(c("headline")).isin(*text.GENERIC_INPUT_HEADLINES)
        & (fallback != "")
        & (normalize_date(fallback) == "")
    )
    df = df.withColumns(
        {
            "review_status": F.when(matched, F.lit("reviewed")).otherwise(c("review_status")),
            "published": F.when(scoped, F.lit("true")).otherwise(c("published")),
            "source_date": F.when(no_source_date, normalize_date(c("event_date"))).otherwise(c("source_date")),
            "claim_type": F.when(duplicate, family).otherwise(c("claim_type")),
            "headline": F.when(borrow, fallback).otherwise(c("headline")),
        }
    )
    group = text.strip(c("canonical_event_group"))
    listed = F.contains(group, F.lit("|"))
    no_tags = F.size(text.normalize_tags(c("impact_tags"))) == 0
    made = F.concat(
        F.lit("ceg-"),
        F.replace(c("admin_code"), F.lit("."), F.lit("-")),
        F.lit("-"),
        month_token(normalize_date(c("event_date"))),
        F.lit("-"),
        c("event_id"),
    )
    return df.withColumns(
        {
            "impact_tags": F.when(no_tags & listed & ~F.startswith(group, F.lit("ceg-")), group).otherwise(
                c("impact_tags")
            ),
            "canonical_event_group": F.when((group == "") | listed, made).otherwise(
                c("canonical_event_group")
            ),
        }
    )


def publishable() -> Column:
    ready = (text.lowered(F.col("verification_status")) == "publishable") | (
        text.lowered(F.col("match_confidence")) == "publishable"
    )
    shown = text.parse_bool(F.col("published")) | text.parse_bool(F.col("evidence_scope"))
    return text.lowered(F.col("review_status")).isin("reviewed", "manual_match") & ready & shown


def with_periods(reports: DataFrame) -> DataFrame:
    c = F.col
    return reports.withColumns(
        {
            "period_start": period_start(c("time_window_start"), c("event_date")),
            "period_end": period_end(c("time_window_end"), c("time_window_start"), c("event_date")),
            "event_group": F.coalesce(F.nullif("canonical_event_group", F.lit("")), c("event_id")),
        }
    )


def rank_reports(reports: DataFrame) -> DataFrame:
    """Publishable reports with their position in their event group: the first report is
    featured, the rest support it in that order. Ranks are taken over keys and dates alone and
    joined back by source row, so that texts are moved once."""
    c = F.col
    day = normalize_date(c("event_date"))
    rows = with_periods(reports).filter(publishable())
    light = rows.select(
        *GROUP,
        "event_id",
        "source_row",
        text.parse_bool(c("is_supporting_evidence")).alias("late"),
        normalize_date(c("source_date"), day).alias("told"),
        day.alias("day"),
    )
    ranked = staged_rank(
        light, GROUP, split=[c("late"), c("told"), c("day")], order=[c("event_id"), c("source_row")]
    )
    return rows.join(ranked.select("slug", "source_row", "position"), ["slug", "source_row"])


def _event_columns() -> list[Column]:
    c = F.col
    day = normalize_date(c("event_date"))
    summary = F.coalesce(F.nullif("summary_id", F.lit("")), c("summary_en"), F.lit(""))
    return [
        c("event_id"),
        day.alias("event_date"),
        c("admin_level"),
        c("location_label"),
        c("source_name"),
        c("source_url"),
        normalize_date(c("source_date"), day).alias("source_date"),
        c("headline"),
        summary.alias("summary"),
        c("summary_id"),
        c("summary_en"),
        c("media_type"),
        c("media_url"),
        c("claim_type"),
        text.normalize_tags(c("impact_tags")).alias("impact_tags"),
        c("event_group").alias("canonical_event_group"),
    ]


def build_events(ranked: DataFrame) -> DataFrame:
    """Featured reports as events with the number of supporting records."""
    sizes = ranked.groupBy(*GROUP).agg((F.count(F.lit(1)) - 1).alias("supporting_count"))
    featured = ranked.filter("position = 1").select(*GROUP, *_event_columns())
    return featured.join(sizes, GROUP)


def supporting_records(ranked: DataFrame) -> DataFrame:
    """Supporting reports as rows, ordered by ``position`` within their event group."""
    c = F.col
    day = normalize_date(c("source_date"), normalize_date(c("event_date")))
    values = {n: c(n) for n in SUPPORTING_COLUMNS} | {"source_date": day}
    return ranked.filter("position > 1").select(
        *GROUP, (c("position") - 1).alias("position"), *(v.alias(n) for n, v in values.items())
    )


def nest_supporting(events: DataFrame, supporting: DataFrame, page_size: int = 1000) -> DataFrame:
    """Events with their supporting records as an array, for document sinks.

    An event with more than ``page_size`` records continues on further rows with ``page``
    counting up, so no array grows with a crowded group and no record is lost.
    """
    record = F.struct("position", *SUPPORTING_COLUMNS)
    pages = (
        supporting.withColumn("page", F.floor((F.col("position") - 1) / page_size).cast("int"))
        .groupBy(*GROUP, "page")
        .agg(F.sort_array(F.collect_list(record)).alias("_r"))
        .withColumn(
            "supporting_records",
            F.transform("_r", lambda r: F.struct(*(r[n].alias(n) for n in SUPPORTING_COLUMNS))),
        )
        .drop("_r")
    )
    nested = events.join(pages, GROUP, "left")
    empty = F.expr("array()").cast(pages.schema["supporting_records"].dataType)
    return nested.withColumn("page", F.coalesce("page", F.lit(0))).withColumn(
        "supporting_records", F.coalesce("supporting_records", empty)
    )


def build_states(reports: DataFrame, events: DataFrame, reviewed_at: str) -> DataFrame:
    """One review state per (place, period); ``reviewed_at`` is a parameter so that runs
    repeat."""
    rows = with_periods(reports).groupBy(*PERIOD).agg(
        F.min_by("admin_level", "source_row").alias("admin_level"),
        F.max((text.lowered(F.col("review_status")) == "reviewed").cast("int")).alias("_reviewed"),
    )
    found = events.groupBy(*PERIOD).agg(
        F.count(F.lit(1)).alias("_events"),
        F.sum("supporting_count").alias("_supporting"),
        F.max(F.struct("event_date", "event_id")).alias("_top"),
    )
    n = F.coalesce(F.col("_events"), F.lit(0))
    more = F.when(n > 0, n - 1 + F.col("_supporting")).otherwise(F.lit(0))
    return (
        rows.join(found, PERIOD, "left")
        .withColumn("supporting_event_count", more.cast("long"))
        .select(
            "slug",
            F.concat("admin_code", F.lit(":"), month_token(F.col("period_start"))).alias("geography_period_id"),
            "admin_level",
            "admin_code",
            province_of(F.col("admin_code")).alias("province_code"),
            "period_start",
            "period_end",
            F.when((n > 0) & (F.col("supporting_event_count") > 0), F.lit("has_featured_report_and_more"))
            .when(n > 0, F.lit("has_featured_report_only"))
            .when(F.col("_reviewed") == 1, F.lit("reviewed_but_no_publishable_report"))
            .otherwise(F.lit("not_reviewed_yet"))
            .alias("public_state"),
            F.coalesce(F.col("_top.event_id"), F.lit("")).alias("featured_event_id"),
            "supporting_event_count",
            F.lit("reviewed").alias("review_status_rollup"),
            F.lit(reviewed_at).alias("reviewed_at"),
        )
    )


def bundle_order(rows: DataFrame, date: str, tie: str) -> DataFrame:
    """Rows of every slug as its bundle lists them: latest ``date`` first, ties by descending
    ``tie``. Slugs are ranged, so that a crowded one spreads over tasks."""
    order = [F.col("slug"), F.col(date).desc(), F.col(tie).desc()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def publication_positions(rows: DataFrame, date: str, tie: str) -> DataFrame:
    """``bundle_position`` of each row within its slug and ``global_position`` over all slugs,
    both latest first; ties by ``tie`` in the bundle and by place overall."""
    by_date = [F.coalesce(date, F.lit(""))]
    placed = staged_rank(rows, ["slug"], by_date, [F.col(tie).desc()], "bundle_position", [True])
    everywhere = [F.col("admin_code").desc(), F.col("slug").desc(), F.col(tie).desc()]
    return staged_rank(placed, [], by_date, everywhere, "global_position", [True])


def related_positions(items: DataFrame) -> DataFrame:
    """``position`` of each related item of a place, latest source first."""
    order = [F.col("kind").asc(), F.col("event_id").desc()]
    return staged_rank(items, ["level", "code"], [F.coalesce("source_date", F.lit(""))], order, "position", [True])


def bundle_counts(slugs: DataFrame, events: DataFrame, states: DataFrame) -> DataFrame:
    """Events, states and bundles of one build."""
    return slugs.agg(F.countDistinct("slug").alias("regency_bundle_count")).select(
        "regency_bundle_count",
        events.agg(F.count(F.lit(1)).alias("n")).scalar().alias("global_events"),
        states.agg(F.count(F.lit(1)).alias("n")).scalar().alias("global_states"),
    )


def state_histogram(states: DataFrame) -> DataFrame:
    """``public_state_summary`` map per slug; empty states are not counted."""
    counts = (
        states.filter(text.or_empty(F.col("public_state")) != "")
        .groupBy("slug", "public_state")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("slug").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("public_state", "n")))).alias(
            "public_state_summary"
        )
    )


def first_values(rows: DataFrame, alternatives: dict[str, Sequence[str]]) -> DataFrame:
    """Per slug and output name, the first non-empty value over the rows of a bundle, which
    stand by descending ``position``, trying the alternative columns of a row in turn."""
    blank = F.lit("")
    out = []
    for name, columns in alternatives.items():
        present = [F.nullif(c, blank) for c in columns if c in rows.columns]
        value = F.coalesce(*present) if present else F.lit(None).cast("string")
        out.append(F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), F.col("position"))).alias(name))
    return rows.groupBy("slug").agg(*out)


def regency_index(files: DataFrame, events: DataFrame, states: DataFrame) -> DataFrame:
    """Registry of slugs having both bundle files.

    ``files(slug, kind, path, modified)``; ``events`` and ``states`` carry ``slug`` and
    ``position``. States are consulted before events.
    """
    names = {"admin_code": ("admin_code", "code"), "admin_level": ("admin_level", "level"), "province_code": ("province_code",)}
    both = (
        files.groupBy("slug")
        .agg(
            F.max(F.when(F.col("kind") == "events", F.col("path"))).alias("events_path"),
            F.max(F.when(F.col("kind") == "states", F.col("path"))).alias("states_path"),
            F.max("modified").alias("_modified"),
        )
        .filter("events_path IS NOT NULL AND states_path IS NOT NULL")
    )
    s = first_values(states, names)
    e = first_values(events, names)
    joined = (
        both.join(s.select("slug", *(F.col(n).alias(f"s_{n}") for n in names)), "slug", "left")
        .join(e.select("slug", *(F.col(n).alias(f"e_{n}") for n in names)), "slug", "left")
        .join(state_histogram(states), "slug", "left")
    )
    code = F.coalesce("s_admin_code", "e_admin_code")
    return joined.select(
        code.alias("admin_code"),
        F.coalesce("s_admin_level", "e_admin_level", F.lit("regency")).alias("admin_level"),
        F.coalesce("s_province_code", "e_province_code", F.nullif(province_of(code), F.lit(""))).alias("province_code"),
        "slug",
        "events_path",
        "states_path",
        F.date_format("_modified", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("updated_at"),
        F.coalesce("public_state_summary", F.expr("map()").cast("map<string,bigint>")).alias("public_state_summary"),
    )


def effective_rows(
    selections: DataFrame, global_rows: DataFrame, bundle_rows: DataFrame, bundle_codes: DataFrame
) -> DataFrame:
    """Rows answering each selection (``level, code``).

    A regency whose bundle loaded (``bundle_codes(code)``) is answered by its bundle alone,
    even when that is empty; every other selection by the global rows. Never merged.
    """
    loaded = bundle_codes.select("code").distinct().withColumn("_b", F.lit(True))
    marked = selections.select("level", "code").distinct().join(loaded, "code", "left")
    bundled = F.coalesce(F.col("_b"), F.lit(False)) & (F.col("level") == "regency")
    own = marked.filter(bundled).join(
        bundle_rows.filter("admin_code = bundle_code").drop("bundle_code"),
        F.col("code") == F.col("admin_code"),
    )
    shared = marked.filter(~bundled).join(
        global_rows,
        (F.col("code") == F.col("admin_code")) & (F.col("level") == F.col("admin_level")),
    )
    return own.unionByName(shared).drop("_b")


def events_in_window(events: DataFrame, month_from: str = "", month_to: str = "") -> DataFrame:
    return events.filter(in_window(month_slice(F.col("event_date")), month_from, month_to))


def states_in_window(states: DataFrame, month_from: str = "", month_to: str = "") -> DataFrame:
    """Either end of the period lies in the window."""
    return states.filter(
        in_window(month_slice(F.col("period_start")), month_from, month_to)
        | in_window(month_slice(F.col("period_end")), month_from, month_to)
    )


def with_media(events: DataFrame) -> DataFrame:
    """Own media, media of supporting records, and the display rank they give."""
    c = F.col
    return (
        events.withColumn("own_media", media.media(c("media_type"), c("media_url"), c("source_url")))
        .withColumn("other_media", media.supporting_media(c("supporting_records")))
        .withColumn("media_rank", media.media_rank(c("own_media"), c("other_media")))
    )


def display_order(events: DataFrame) -> DataFrame:
    """Position of an event in its place's list: media rank, then latest date, then id.

    Continuation pages of an event (see `nest_supporting`) are not listed themselves, but a
    video on one of them counts for the rank.
    """
    c = F.col
    if "page" in events.columns:
        event = ["level", "code", "event_id", "canonical_event_group"]
        late = (
            events.filter((c("page") > 0) & F.exists("other_media", lambda m: m["kind"] == "video"))
            .select(*event)
            .distinct()
            .withColumn("_video", F.lit(2))
        )
        rank = F.greatest(c("media_rank"), F.coalesce(c("_video"), F.lit(0)))
        events = (
            events.filter("page = 0")
            .join(late, event, "left")
            .withColumn("media_rank", rank)
            .drop("_video")
        )
    return staged_rank(
        events,
        ["level", "code"],
        split=[c("media_rank"), text.or_empty(c("event_date"))],
        descending=[True, True],
        order=[c("event_id").desc()],
    )


def related_items(ordered: DataFrame, continued: DataFrame | None = None) -> DataFrame:
    """Additional events (all but the first) and exploded supporting records, those on
    ``continued`` pages included."""
    c = F.col
    blank = F.lit("")
    extra = ordered.filter("position > 1").select(
        "level",
        "code",
        F.lit("event").alias("kind"),
        "event_id",
        "headline",
        "media_type",
        "media_url",
        c("event_date").alias("source_date"),
        "source_name",
        "source_url",
        "summary_id",
        "summary_en",
        "location_label",
        "impact_tags",
        "claim_type",
    )
    holders = ordered.select("level", "code", "location_label", "supporting_records")
    if continued is not None:
        holders = holders.unionByName(continued.select(*holders.columns))
    support = holders.withColumn("r", F.explode("supporting_records")).select(
        "level",
        "code",
        F.lit("supporting").alias("kind"),
        c("r.event_id").alias("event_id"),
        c("r.headline").alias("headline"),
        c("r.media_type").alias("media_type"),
        c("r.media_url").alias("media_url"),
        c("r.source_date").alias("source_date"),
        c("r.source_name").alias("source_name"),
        c("r.source_url").alias("source_url"),
        blank.alias("summary_id"),
        blank.alias("summary_en"),
        "location_label",
        F.array().cast("array<string>").alias("impact_tags"),
        c("r.claim_type").alias("claim_type"),
    )
    return extra.unionByName(support)


def latest_states(states: DataFrame) -> DataFrame:
    """Latest state per place by period start, then review time."""
    latest = F.max_by("public_state", F.struct("period_start", "reviewed_at"))
    return states.groupBy("level", "code").agg(latest.alias("latest_state"), F.count(F.lit(1)).alias("states"))


def range_state(events: Column, related: Column, latest: Column) -> Column:
    return (
        F.when((events > 0) & (related > 0), F.lit("has_featured_report_and_more"))
        .when(events > 0, F.lit("has_featured_report_only"))
        .otherwise(text.or_empty(latest))
    )


def qualitative_summary(
    selections: DataFrame,
    ordered: DataFrame,
    states: DataFrame,
    registry_codes: DataFrame,
) -> DataFrame:
    """Per selection: counts, featured event, public state and the has-data flag.

    ``ordered`` is `display_order` of the effective events in the window, ``states`` the
    effective states in the window.
    """
    keys = ["level", "code"]
    counted = "supporting_count" in ordered.columns
    records = F.col("supporting_count") if counted else F.size("supporting_records")
    per_place = ordered.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(records).alias("_supporting"),
        F.max(F.when(F.col("position") == 1, F.col("event_id"))).alias("featured_event_id"),
    )
    reg = registry_codes.select("code").distinct().withColumn("_reg", F.lit("regency"))
    zero = F.lit(0).cast("long")
    events = F.coalesce(F.col("events"), zero)
    related = F.when(events > 0, events - 1 + F.col("_supporting")).otherwise(zero)
    joined = (
        selections.select(*keys).distinct()
        .join(per_place, keys, "left")
        .join(latest_states(states), keys, "left")
        .join(reg, "code", "left")
    )
    state = range_state(events, related, F.col("latest_state"))
    indexed = F.coalesce(F.col("_reg") == F.col("level"), F.lit(False))
    return joined.select(
        *keys,
        events.alias("events"),
        related.cast("long").alias("related_count"),
        F.coalesce("featured_event_id", F.lit("")).alias("featured_event_id"),
        state.alias("public_state"),
        ((events > 0) | (F.coalesce("states", zero) > 0) | indexed).alias("has_data"),
        text.state_label_key(state).alias("state_label_key"),
        text.state_note_key(state).alias("state_note_key"),
        text.empty_message_key(state).alias("empty_message_key"),
    )


def fill_events(raw: DataFrame) -> DataFrame:
    """Event columns with missing values defaulted and links made public; rows with a ``page``
    keep it, beside the slug and period that tell events apart."""
    names = (
        "event_id", "event_date", "admin_level", "admin_code", "location_label", "source_name",
        "source_date", "headline", "summary_id", "summary_en", "media_type", "claim_type",
        "canonical_event_group",
    )
    c = F.col
    tags = F.filter(F.coalesce(c("impact_tags"), F.array().cast("array<string>")), lambda t: text.or_empty(t) != "")
    records = F.transform(
        F.coalesce(c("supporting_records"), F.expr("array()").cast(raw.schema["supporting_records"].dataType)),
        lambda r: F.struct(
            *(
                (media.public_url(r[n]) if n.endswith("_url") else text.or_empty(r[n])).alias(n)
                for n in SUPPORTING_COLUMNS
            )
        ),
    )
    paged = []
    if "page" in raw.columns:
        paged = [text.or_empty(c(n)).alias(n) for n in ("slug", "period_start", "period_end")]
        paged.append(F.coalesce("page", F.lit(0)).alias("page"))
    return raw.select(
        *(text.or_empty(c(n)).alias(n) for n in names),
        *paged,
        media.public_url(c("source_url")).alias("source_url"),
        media.public_url(c("media_url")).alias("media_url"),
        tags.alias("impact_tags"),
        records.alias("supporting_records"),
    )


def whole_events(pages: DataFrame) -> DataFrame:
    """First pages of filled events (see `nest_supporting`) with ``records``, the number of
    supporting records on all pages. Equal pages of rows that repeat an event count once."""
    event = ["slug", "admin_code", "period_start", "period_end", "canonical_event_group", "event_id"]
    size = F.size("supporting_records")
    continued = pages.filter("page > 0").select(*event, "page", size.alias("_n")).distinct()
    more = continued.groupBy(*event).agg(F.sum("_n").alias("_more"))
    records = (size + F.coalesce("_more", F.lit(0))).cast("int")
    return pages.filter("page = 0").join(more, event, "left").withColumn("records", records).drop("_more")


def fill_states(raw: DataFrame) -> DataFrame:
    names = (
        "admin_code", "admin_level", "featured_event_id", "geography_period_id", "period_start",
        "period_end", "public_state", "review_status_rollup", "reviewed_at",
    )
    return raw.select(
        *(text.or_empty(F.col(n)).alias(n) for n in names),
        F.coalesce(F.col("supporting_event_count"), F.lit(0)).cast("long").alias("supporting_event_count"),
    )
