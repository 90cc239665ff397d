"""Footprint x unit overlap as an equi-join on grid cells.

Both sides are cut along a square grid in the equal-area plane. Inside one cell a
polygon is a set of signed, x-monotone fragments ``(l, hl) -> (r, hr)`` with heights
above the cell's floor, so the overlap of two polygons in that cell is

    sum over fragment pairs of  w_a * w_b * integral of min(height_a, height_b)

which is one codegen'd projection above the join followed by a map-side combined sum.
Fragments of a unit that run above a cell collapse into flat ceilings, so cells in the
interior of a unit hold a single fragment whatever the detail of its border.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.schemas import AREA_EPS_M2
from tidemark.session import BROADCAST_BYTES, broadcast_if_small, cut_lineage

#: Widest and narrowest cells, and the width of a cell in widths of a mean unit.
CELL_M, LEAST_CELL_M, CELL_UNITS = 20_000.0, 100.0, 1.25
FRAGMENT_BYTES = 160
#: Unit pieces of one cell that one task meets.
UNIT_ROWS = 50_000

_PIECE = ("l", "hl", "r", "hr")


def projected_edges(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per non-vertical edge of ``df(*keys, edges, extent)``: plane coordinates left
    to right, weight +1 for a top edge and -1 for a bottom edge, and the geometry's floor."""
    e = df.select(*keys, F.col("extent.ymin").alias("_floor"), F.explode("edges").alias("_e"))
    e = e.filter(F.col("_e.x0") != F.col("_e.x1"))
    p = e.select(
        *keys,
        geo.project_y(F.col("_floor")).alias("_floor"),
        geo.project_x(F.col("_e.x0")).alias("x0"),
        geo.project_y(F.col("_e.y0")).alias("y0"),
        geo.project_x(F.col("_e.x1")).alias("x1"),
        geo.project_y(F.col("_e.y1")).alias("y1"),
    )
    rightward = F.col("x1") > F.col("x0")
    return p.select(
        *keys,
        "_floor",
        F.least("x0", "x1").alias("xa"),
        F.when(rightward, F.col("y0")).otherwise(F.col("y1")).alias("ya"),
        F.greatest("x0", "x1").alias("xb"),
        F.when(rightward, F.col("y1")).otherwise(F.col("y0")).alias("yb"),
        F.when(rightward, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("w"),
    )


def plane_area_km2(edges: Column, floor: Column) -> Column:
    """Planar area of directed lon/lat edges, heights taken above the geometry's floor."""
    base = geo.project_y(floor)
    strips = F.transform(
        edges,
        lambda e: (geo.project_x(e["x0"]) - geo.project_x(e["x1"]))
        * ((geo.project_y(e["y0"]) - base) + (geo.project_y(e["y1"]) - base)),
    )
    return F.aggregate(strips, F.lit(0.0), lambda acc, v: acc + v) / F.lit(2e6)


def _pack(col: Column, row: Column) -> Column:
    """Grid column and row in one long, the join key."""
    return F.shiftleft(col.cast("long"), 32) + (row.cast("long") + F.lit(1 << 30))


def cell_fragments(edges: DataFrame, keys: Sequence[str], cell_m: float = CELL_M) -> DataFrame:
    """Cut projected edges along the grid; ``top`` marks pieces clamped to a cell's ceiling."""
    c = F.lit(float(cell_m))

    def index(v: Column) -> Column:
        return F.floor(v / c).cast("int")

    columns = F.sequence(index(F.col("xa")), index(F.col("xb")))
    peak = index(F.greatest("ya", "yb"))
    rows = F.sequence(F.least(index(F.col("_floor")), peak), peak)
    placed = edges.select(
        *keys, "xa", "ya", "xb", "yb", "w", "_floor", F.explode(columns).alias("_c")
    ).select(*keys, "xa", "ya", "xb", "yb", "w", "_c", F.explode(rows).alias("_r"))

    cx, cy = F.col("_c") * c, F.col("_r") * c
    xa, ya, xb, yb = (F.col(n) for n in ("xa", "ya", "xb", "yb"))
    slope = (yb - ya) / (xb - xa)
    local = placed.select(
        *keys,
        "w",
        _pack(F.col("_c"), F.col("_r")).alias("cell"),
        (F.greatest(xa, cx) - cx).alias("l"),
        (F.least(xb, cx + c) - cx).alias("r"),
        (F.when(xa >= cx, ya).otherwise(ya + slope * (cx - xa)) - cy).alias("hl"),
        (F.when(xb <= cx + c, yb).otherwise(ya + slope * (cx + c - xa)) - cy).alias("hr"),
    ).filter((F.col("r") > F.col("l")) & (F.greatest("hl", "hr") > 0))

    left, right, hl, hr = (F.col(n) for n in ("l", "r", "hl", "hr"))
    rising = hr > hl

    def crossing(height: Column) -> Column:
        return left + (height - hl) * (right - left) / (hr - hl)

    zero = F.lit(0.0)
    at_floor = F.when(F.least(hl, hr) < 0, crossing(zero))
    at_ceiling = F.when((F.greatest(hl, hr) > c) & (F.least(hl, hr) < c), crossing(c))
    in_l = F.when(rising, F.coalesce(at_floor, left)).otherwise(F.coalesce(at_ceiling, left))
    in_r = F.when(rising, F.coalesce(at_ceiling, right)).otherwise(F.coalesce(at_floor, right))
    top_l = F.when(rising, F.coalesce(at_ceiling, left)).otherwise(left)
    top_r = F.when(rising, right).otherwise(F.coalesce(at_ceiling, right))

    def clamp(h: Column) -> Column:
        return F.least(F.greatest(h, zero), c)

    def piece(top: bool, a: Column, ha: Column, b: Column, hb: Column, keep: Column) -> Column:
        return F.struct(
            F.lit(top).alias("top"),
            a.alias("l"),
            ha.alias("hl"),
            b.alias("r"),
            hb.alias("hr"),
            keep.alias("keep"),
        )

    pieces = F.array(
        piece(False, in_l, clamp(hl), in_r, clamp(hr), F.least(hl, hr) < c),
        piece(True, top_l, c, top_r, c, (F.greatest(hl, hr) > c) | (F.least(hl, hr) >= c)),
    )
    return (
        local.select(*keys, "w", "cell", F.explode(pieces).alias("_p"))
        .filter(F.col("_p.keep") & (F.col("_p.r") > F.col("_p.l")))
        .select(*keys, "w", "cell", "_p.top", *(f"_p.{n}" for n in _PIECE))
    )


def merge_ceilings(fragments: DataFrame, keys: Sequence[str], cell_m: float = CELL_M) -> DataFrame:
    """Replace the ceiling pieces of each (geometry, cell) by their net coverage.

    Neighbouring edges share a vertex, so their breakpoint weights cancel in the grouped
    sum and only the true ends of a covered stretch survive.
    """
    c = F.lit(float(cell_m))
    group = [*keys, "cell"]
    ends = (
        fragments.filter("top")
        .select(
            *group,
            F.explode(
                F.array(
                    F.struct(F.col("l").alias("x"), F.col("w").alias("d")),
                    F.struct(F.col("r").alias("x"), (-F.col("w")).alias("d")),
                )
            ).alias("_b"),
        )
        .groupBy(*group, F.col("_b.x").alias("x"))
        .agg(F.sum("_b.d").alias("d"))
        .filter("d <> 0")
    )
    along = Window.partitionBy(*group).orderBy("x")
    flat = (
        ends.select(
            *group,
            F.col("x").alias("l"),
            F.lead("x").over(along).alias("r"),
            F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("w"),
        )
        .filter("w <> 0 AND r IS NOT NULL")
        .select(*group, "w", "l", c.alias("hl"), "r", c.alias("hr"))
    )
    sloped = fragments.filter("NOT top").select(*group, "w", "l", "hl", "r", "hr")
    return sloped.unionByName(flat)


def cell_size(units: DataFrame) -> float:
    """Cell width for units of some size: cells shrink with the units, so that one holds as many
    of them however fine the hierarchy is; `CELL_M` at most."""
    wide = geo.project_x(F.col("extent.xmax")) - geo.project_x(F.col("extent.xmin"))
    high = geo.project_y(F.col("extent.ymax")) - geo.project_y(F.col("extent.ymin"))
    mean = units.agg(F.avg(wide * high).alias("m2")).first()["m2"]
    if mean is None or not math.isfinite(mean):
        return CELL_M
    return float(round(min(CELL_M, max(LEAST_CELL_M, CELL_UNITS * math.sqrt(mean)))))


def unit_fragments(units: DataFrame, cell_m: float | None = None) -> DataFrame:
    """The join-ready side of all levels at once: ``units(level, code, edges, extent)``, in cells
    of ``cell_m`` or of `cell_size`, which a column tells.

    The result depends on the hierarchy only; callers write it once and reuse it.
    """
    cell_m = cell_m or cell_size(units)
    keys = ["level", "code", "unit_area_km2", "u_south", "u_north"]
    area = plane_area_km2(F.col("edges"), F.col("extent.ymin")).alias("unit_area_km2")
    reach = (F.col("extent.ymin").alias("u_south"), F.col("extent.ymax").alias("u_north"))
    edges = projected_edges(units.select("level", "code", "edges", "extent", area, *reach), keys)
    return merge_ceilings(cell_fragments(edges, keys, cell_m), keys, cell_m).withColumn("cell_m", F.lit(float(cell_m)))


def _with_integral(pairs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Add ``m2``, the integral of the lower of two linear heights over the shared x
    interval. Steps are separate projections, so each value is computed once per pair."""
    lo = F.greatest("a_l", "b_l").alias("lo")
    hi = F.least("a_r", "b_r").alias("hi")

    def rise(side: str) -> Column:
        l, hl, r, hr = (F.col(f"{side}_{n}") for n in _PIECE)
        return ((hr - hl) / (r - l)).alias(f"{side}_rise")

    def height(side: str, x: str) -> Column:
        return (F.col(f"{side}_hl") + F.col(f"{side}_rise") * (F.col(x) - F.col(f"{side}_l"))).alias(
            f"{side}_{x}"
        )

    weight = (F.col("a_w") * F.col("b_w")).alias("w")
    sides = ("a_l", "a_hl", "b_l", "b_hl")
    p = pairs.select(*keep, *sides, weight, lo, hi, rise("a"), rise("b"))
    p = p.select(
        *keep, "w", (F.col("hi") - F.col("lo")).alias("width"),
        height("a", "lo"), height("a", "hi"), height("b", "lo"), height("b", "hi"),
    )
    total = F.col("a_lo") + F.col("a_hi") + F.col("b_lo") + F.col("b_hi")
    p = p.select(
        *keep, "w", "width", total.alias("total"),
        (F.col("a_lo") - F.col("b_lo")).alias("d0"), (F.col("a_hi") - F.col("b_hi")).alias("d1"),
    )
    apart = F.abs("d0") + F.abs("d1")
    crossed = (F.col("d0") * F.col("d0") + F.col("d1") * F.col("d1")) / apart
    gap = F.when(F.col("d0") * F.col("d1") < 0, crossed).otherwise(apart)
    return p.select(*keep, (F.col("w") * F.col("width") * (F.col("total") - gap) / 4).alias("m2"))


def within_extent(footprints: DataFrame, units: DataFrame, level: str = "district") -> DataFrame:
    """Keep footprints whose extent touches the extent of one level, borders included.

    The level's extent is one row, attached as scalar subqueries. Both inputs carry an
    ``extent`` struct; an absent level keeps nothing.
    """
    ext = units.filter(F.col("level") == level).agg(
        F.min("extent.xmin").alias("xmin"),
        F.min("extent.ymin").alias("ymin"),
        F.max("extent.xmax").alias("xmax"),
        F.max("extent.ymax").alias("ymax"),
    )

    def side(name: str) -> Column:
        return ext.select(name).scalar()

    return footprints.filter(
        (F.col("extent.xmax") >= side("xmin"))
        & (F.col("extent.ymax") >= side("ymin"))
        & (F.col("extent.xmin") <= side("xmax"))
        & (F.col("extent.ymin") <= side("ymax"))
    )


def hot_cells(footprints: DataFrame, cell_m: float = CELL_M, rows_per_task: int = 2_000_000) -> DataFrame:
    """Cells holding more footprint pieces than one task should, with their salt.

    Counts are combined on the map side; at most (all pieces / ``rows_per_task``) cells
    qualify, so the result is small whatever the input.
    """
    pieces = cell_fragments(projected_edges(footprints, ["row_id"]), ["row_id"], cell_m)
    counts = pieces.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    salt = F.ceil(F.col("n") / rows_per_task).cast("int")
    return counts.filter(F.col("n") > rows_per_task).select("cell", salt.alias("salt"))


def dense_cells(fragments: DataFrame, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """``cell, parts`` of cells with more than ``unit_rows`` unit pieces, and into how many parts
    these are divided."""
    counts = fragments.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > unit_rows).select("cell", F.ceil(F.col("n") / unit_rows).cast("int").alias("parts"))


def overlap(
    footprints: DataFrame,
    fragments: DataFrame,
    carry: Sequence[str] = ("start_date",),
    cell_m: float | None = None,
    eps_m2: float = AREA_EPS_M2,
    broadcast_bytes: int = BROADCAST_BYTES,
    salt: int | None = None,
    hot: DataFrame | None = None,
    unit_rows: int = UNIT_ROWS,
) -> DataFrame:
    """Bridge rows ``row_id, *carry, level, code, intersection_area_km2, unit_area_km2,
    coverage_ratio``; one per footprint row and unit whose overlap exceeds ``eps_m2``.

    A unit side proven small is broadcast, so footprints are not moved before the sum.
    Otherwise both sides are shuffled on (cell, salt): a crowded cell is spread over several
    partitions and its unit side is repeated that many times. Crowded are the cells ``hot``, by
    default `hot_cells`, each by its own weight; with ``salt`` alone every cell is spread by it.
    Cells are those of ``fragments``. A cell with more than
    ``unit_rows`` unit pieces, as where thousands of borders meet, is divided: each part holds a
    share of the units, and the cell's footprints meet every part. Both sides are sorted, not
    built in memory. Pieces of a cell reach
    down to a common floor; a pair whose latitudes do not meet would sum to nothing and is
    left out of the join.
    """
    if cell_m is None:
        own = fragments.select("cell_m").first() if "cell_m" in fragments.columns else None
        cell_m = own["cell_m"] if own else CELL_M
    keys = ["row_id", *carry]
    sided = [*keys, "f_south", "f_north"]
    reach = {"f_south": F.col("extent.ymin"), "f_north": F.col("extent.ymax")}
    fa = cell_fragments(projected_edges(footprints.withColumns(reach), sided), sided, cell_m).select(
        *sided, "cell", F.col("w").alias("a_w"), *(F.col(n).alias(f"a_{n}") for n in _PIECE)
    )
    fb = fragments.select(
        "level",
        "code",
        "unit_area_km2",
        "u_south",
        "u_north",
        F.col("cell").alias("b_cell"),
        F.col("w").alias("b_w"),
        *(F.col(n).alias(f"b_{n}") for n in _PIECE),
    )
    on = (
        (F.col("cell") == F.col("b_cell"))
        & (F.col("a_l") < F.col("b_r"))
        & (F.col("b_l") < F.col("a_r"))
        & (F.col("f_south") < F.col("u_north"))
        & (F.col("u_south") < F.col("f_north"))
    )
    small = broadcast_if_small(fb, FRAGMENT_BYTES, broadcast_bytes)
    if small is not None:
        pairs = fa.join(small, on)
    else:
        factor_a = factor_b = F.lit(salt or 1)
        if hot is not None or salt is None:
            hot = hot_cells(footprints, cell_m) if hot is None else hot
            known = cut_lineage(hot)
            known = broadcast_if_small(known, 16) or known
            fa = fa.join(known, "cell", "left")
            fb = fb.join(known.select(F.col("cell").alias("b_cell"), "salt"), "b_cell", "left")
            factor_a = factor_b = F.coalesce(F.col("salt"), F.lit(1))
        fa = fa.withColumn("a_salt", F.pmod(F.xxhash64("row_id"), factor_a).cast("int")).drop("salt")
        fb = fb.withColumn("b_salt", F.explode(F.sequence(F.lit(0), factor_b - 1))).drop("salt")
        dense = cut_lineage(dense_cells(fragments, unit_rows))
        dense = broadcast_if_small(dense, 16) or dense
        parts = F.coalesce(F.col("parts"), F.lit(1))
        fa = fa.join(dense, "cell", "left").withColumn("a_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        fb = fb.join(dense.withColumnRenamed("cell", "b_cell"), "b_cell", "left")
        fb = fb.withColumn("b_part", F.pmod(F.xxhash64("level", "code", "b_l", "b_hl"), parts).cast("int")).drop("parts")
        pairs = fa.join(fb, on & (F.col("a_salt") == F.col("b_salt")) & (F.col("a_part") == F.col("b_part")))
    by_pair = [*keys, "level", "code", "unit_area_km2"]
    return (
        _with_integral(pairs, by_pair)
        .groupBy(*keys, "level", "code")
        .agg(F.sum("m2").alias("_m2"), F.max("unit_area_km2").alias("unit_area_km2"))
        .filter(F.col("_m2") > eps_m2)
        .select(
            *keys,
            "level",
            "code",
            (F.col("_m2") / 1e6).alias("intersection_area_km2"),
            "unit_area_km2",
            (F.col("_m2") / 1e6 / F.col("unit_area_km2")).alias("coverage_ratio"),
        )
    )


def bridge(footprints: DataFrame, fragments: DataFrame, **options) -> DataFrame:
    """Footprint x unit bridge with both coverage ratios."""
    b = overlap(
        footprints, fragments, carry=("uuid", "start_date", "footprint_area_km2"), **options
    )
    return b.select(
        "row_id",
        "uuid",
        "start_date",
        "level",
        "code",
        "intersection_area_km2",
        "footprint_area_km2",
        "unit_area_km2",
        F.col("coverage_ratio").alias("coverage_ratio_of_unit"),
        F.try_divide("intersection_area_km2", "footprint_area_km2").alias("coverage_ratio_of_footprint"),
    )
