"""Ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def staged_rank(
    df: DataFrame,
    keys: Sequence[str],
    split: Sequence[Column],
    order: Sequence[Column],
    name: str = "position",
    descending: Sequence[bool] | None = None,
) -> DataFrame:
    """1-based position within ``keys`` ordered by ``split`` then ``order``.

    The ``split`` columns lead the order and cut a crowded group into pieces ranked by
    separate tasks; each piece starts after the rows of the pieces before it, known from
    counts combined on the map side. Split values must not be null; ``descending`` gives
    their direction.
    """
    parts = [f"_s{i}" for i in range(len(split))]
    cols = df.columns
    rows = df.select(*cols, *(c.alias(p) for c, p in zip(split, parts)))
    down = descending or [False] * len(parts)
    directions = [F.col(p).desc() if d else F.col(p).asc() for p, d in zip(parts, down)]
    counts = rows.groupBy(*keys, *parts).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*directions).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, *parts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy(*keys, *parts).orderBy(*order))
    return (
        rows.withColumn("_local", local)
        .join(offsets, [*keys, *parts])
        .select(*cols, (F.col("_off") + F.col("_local")).alias(name))
    )
