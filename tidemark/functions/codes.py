"""Dotted administrative codes as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import LEVELS


def padded(key: Column, width: int) -> Column:
    """A number in at least ``width`` digits; a longer one is never cut."""
    digits = key.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def segments(code: Column) -> Column:
    return F.size(F.split(code, r"\."))


def prefix(code: Column, k: int) -> Column:
    """First ``k`` segments; shorter codes stay as they are."""
    return F.substring_index(code, ".", k)


def level_of(code: Column) -> Column:
    """Level by segment count; null for anything but one to four segments."""
    n = segments(code)
    out = F.lit(None).cast("string")
    for i, level in enumerate(LEVELS, start=1):
        out = F.when(n == i, F.lit(level)).otherwise(out)
    return out


def checked_level(code: Column) -> Column:
    """`level_of`, failing the job on a malformed code."""
    level = level_of(code)
    return F.when(
        level.isNull(), F.raise_error(F.concat(F.lit("unexpected code format: "), code))
    ).otherwise(level)


def hierarchy(code: Column) -> dict[str, Column]:
    """Level and ancestor columns of a code."""
    n = segments(code)
    out = {"level": level_of(code), "province_code": prefix(code, 1)}
    for i, level in enumerate(LEVELS[1:], start=2):
        out[f"{level}_code"] = F.when(n >= i, prefix(code, i))
    return out


def parent_code(level: str) -> Column:
    """The row's code at ``level``; village falls back to the row's own code."""
    if level not in LEVELS:
        raise ValueError(f"unsupported level: {level}")
    col = F.col(f"{level}_code")
    if level == "village":
        return F.coalesce(F.nullif(col, F.lit("")), F.col("code"))
    return col


def level_rank(level: Column) -> Column:
    return F.array_position(F.array(*(F.lit(v) for v in LEVELS)), level)


def province_of(code: Column) -> Column:
    return prefix(F.coalesce(code, F.lit("")), 1)
