"""Registered queries over the star-schema tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def modules():
    from tidemark.plans.catalog import (
        admin,
        explore,
        facts,
        geometry,
        labels,
        overlap,
        release,
        reports,
        sources,
    )

    return (overlap, geometry, facts, admin, explore, reports, labels, sources, release)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in modules():
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in modules():
        out.update(m.ORACLES)
    return out
