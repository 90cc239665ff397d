"""Date-string columns: month keys, normalisation, window labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations of the published labels.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
MONTH_NAMES_ID = ("Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agu", "Sep", "Okt", "Nov", "Des")


def month_start(date: Column) -> Column:
    return F.concat(F.substring(date, 1, 7), F.lit("-01"))


def month_token(value: Column) -> Column:
    """``YYYY-MM`` of a long enough string, else empty."""
    v = F.coalesce(value, F.lit(""))
    return F.when(F.length(v) >= 7, F.substring(v, 1, 7)).otherwise(F.lit(""))


def month_slice(value: Column) -> Column:
    """First seven characters whatever the length; empty for null."""
    return F.substring(F.coalesce(value, F.lit("")), 1, 7)


def normalize_date(value: Column, fallback: Column | None = None) -> Column:
    """Keep 10 characters, complete 7 with the first day, otherwise the fallback."""
    text = F.trim(F.coalesce(value, F.lit("")))
    other = F.lit("") if fallback is None else fallback
    return (
        F.when(F.length(text) == 10, text)
        .when(F.length(text) == 7, F.concat(text, F.lit("-01")))
        .otherwise(other)
    )


def period_start(window_start: Column, event_date: Column) -> Column:
    day = normalize_date(event_date)
    seed = F.when(F.length(day) == 10, F.concat(F.substring(day, 1, 7), F.lit("-01")))
    return normalize_date(window_start, F.coalesce(seed, day))


def period_end(window_end: Column, window_start: Column, event_date: Column) -> Column:
    return normalize_date(window_end, period_start(window_start, event_date))


def in_window(month: Column, month_from: str | None, month_to: str | None) -> Column:
    """Month within an optionally open window; null or empty months are outside."""
    ok = month.isNotNull() & (month != "")
    if month_from:
        ok = ok & (month >= month_from)
    if month_to:
        ok = ok & (month <= month_to)
    return ok


def _month_name(month: Column, names: tuple[str, ...] = MONTH_NAMES) -> Column:
    ix = F.substring(month, 6, 2).cast("int")
    return F.element_at(F.array(*(F.lit(n) for n in names)), ix)


def month_label(month: Column) -> Column:
    """``Mon YYYY``; a dash when there is no month."""
    empty = month.isNull() | (month == "")
    return F.when(empty, F.lit("—")).otherwise(
        F.concat_ws(" ", _month_name(month), F.substring(month, 1, 4))
    )


def full_date_label(date: Column, language: str = "en") -> Column:
    """Day, short month and year in the order of the language."""
    day = F.substring(date, 9, 2).cast("int").cast("string")
    year = F.substring(date, 1, 4)
    empty = date.isNull() | (date == "")
    if language == "id":
        text = F.concat_ws(" ", day, _month_name(date, MONTH_NAMES_ID), year)
    else:
        text = F.concat(_month_name(date), F.lit(" "), day, F.lit(", "), year)
    return F.when(empty, F.lit("—")).otherwise(text)


def window_label(month_from: Column, month_to: Column) -> Column:
    """Range, single month, or ``selection.all_time`` when the window has no start."""
    has_from = F.coalesce(month_from, F.lit("")) != ""
    has_to = F.coalesce(month_to, F.lit("")) != ""
    return (
        F.when(
            has_from & has_to & (month_from != month_to),
            F.concat(month_label(month_from), F.lit(" – "), month_label(month_to)),
        )
        .when(has_from, month_label(month_from))
        .otherwise(F.lit("selection.all_time"))
    )
