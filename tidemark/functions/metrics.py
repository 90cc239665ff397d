"""Metric display helpers: choropleth bins, legend, number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of colour steps, the first one being "no data".
COLOR_STEPS = 6


def color_bin(value: Column, max_value: Column) -> Column:
    top = COLOR_STEPS - 1
    empty = F.coalesce(max_value, F.lit(0.0)) == 0
    return F.when(empty | (value <= 0), F.lit(0)).otherwise(
        F.least(F.lit(top), F.floor(value / max_value * top).cast("int") + 1)
    ).cast("int")


def legend(max_value: Column) -> Column:
    """Threshold per step; the first step is labelled 0."""
    top = COLOR_STEPS - 1
    return F.transform(
        F.sequence(F.lit(0), F.lit(top)),
        lambda i: F.struct(
            i.cast("int").alias("step"),
            F.when(i == 0, F.lit(0)).otherwise(F.floor(i / F.lit(top) * max_value + 0.5)).cast("long").alias("threshold"),
        ),
    )


def display_number(value: Column, language: str = "en") -> Column:
    """At most two decimals, grouped thousands, separators of the language; ties round away
    from zero."""
    v = F.coalesce(value, F.lit(0)).cast("double")
    text = F.format_number(F.signum(v) * F.floor(F.abs(v) * 100 + 0.5) / 100, 2)
    text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    text = F.when(text == "-0", F.lit("0")).otherwise(text)
    return F.translate(text, ",.", ".,") if language == "id" else text
