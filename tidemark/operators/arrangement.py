"""Arrangements of edges: crossings, coverage on either side, outlines of unions and repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

#: Decimals that vertices are rounded to (0.1 mm in degrees), and how near a vertex may come to
#: an edge without cutting it.
DECIMALS, NEAR = 9, 1.5e-9
#: Where cell lines lie relative to the extent, in cells: no multiple of an edge's length.
SHIFT_X, SHIFT_Y = 0.618033988749895, 0.754877666246693
ENDS = ["x0", "y0", "x1", "y1"]


def _merged(edges: DataFrame, key: str, parity: bool) -> DataFrame:
    """Edges from their lesser end to the greater, ``net`` times; those that cancel are gone."""
    near = edges.select(key, *(F.round(c, DECIMALS).alias(c) for c in ENDS), "net")
    forward = F.struct("x0", "y0") < F.struct("x1", "y1")
    a = [F.when(forward, F.col(c)).otherwise(F.col(d)).alias(c) for c, d in zip(ENDS, ("x1", "y1", "x0", "y0"))]
    whole = near.filter("x0 <> x1 OR y0 <> y1").select(key, *a, F.when(forward, F.col("net")).otherwise(-F.col("net")).alias("net"))
    return whole.groupBy(key, *ENDS).agg(F.sum("net").alias("net")).filter("net % 2 <> 0" if parity else "net <> 0")


def _gridded(edges: DataFrame, key: str) -> DataFrame:
    """Edges with the grid of their key: origin ``ox``, ``oy`` and cell width ``w``, half the
    mean edge, so that an edge meets about four cells on average whatever its key holds."""
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    w = F.avg(length) / 2
    grid = edges.groupBy(key).agg(
        w.alias("w"),
        (F.min("x0") - SHIFT_X * w).alias("ox"),
        (F.min(F.least("y0", "y1")) - SHIFT_Y * w).alias("oy"),
    )
    return edges.join(grid, key)


def _cell(v: Column, origin: str) -> Column:
    return F.floor((v - F.col(origin)) / F.col("w"))


def _y_at(x: Column) -> Column:
    """Ordinate of an edge that isn't upright."""
    return F.col("y0") + (x - F.col("x0")) * F.try_divide(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))


def _cells(edges: DataFrame) -> DataFrame:
    """One row per cell (``i``, ``j``) that an edge meets: columns first, then the rows it
    spans inside the column."""
    spread = edges.withColumn("i", F.explode(F.sequence(_cell(F.col("x0") - NEAR, "ox"), _cell(F.col("x1") + NEAR, "ox"))))
    left = F.col("ox") + F.col("i") * F.col("w")
    upright = F.col("x0") == F.col("x1")
    a = F.when(upright, F.col("y0")).otherwise(_y_at(F.least(F.greatest("x0", left - NEAR), F.col("x1"))))
    b = F.when(upright, F.col("y1")).otherwise(_y_at(F.greatest(F.least("x1", left + F.col("w") + NEAR), F.col("x0"))))
    rows = F.sequence(_cell(F.least(a, b) - NEAR, "oy"), _cell(F.greatest(a, b) + NEAR, "oy"))
    return spread.withColumn("j", F.explode(rows))


def _turn(ax: Column, ay: Column, bx: Column, by: Column, x: Column, y: Column) -> Column:
    """Positive where (x, y) lies left of a -> b."""
    return (bx - ax) * (y - ay) - (by - ay) * (x - ax)


def _of(alias: str) -> list[Column]:
    return [F.col(f"{alias}.{c}") for c in ENDS]


def _cuts(edges: DataFrame, key: str) -> DataFrame:
    """Points at which edges are to be cut: id, x, y.

    Edges of a key meet in the cells they share. An edge is cut at a vertex of another that
    comes within ``NEAR`` of its inside, and where both cross inside.
    """
    cells = _cells(edges).select(key, "i", "j", "id", *ENDS)
    touch = [F.col(f"a.{lo}") <= F.col(f"b.{hi}") + NEAR for lo, hi in (("x0", "x1"),)]
    touch += [F.col("b.x0") <= F.col("a.x1") + NEAR]
    touch += [F.least("a.y0", "a.y1") <= F.greatest("b.y0", "b.y1") + NEAR, F.least("b.y0", "b.y1") <= F.greatest("a.y0", "a.y1") + NEAR]
    same = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    meet = same & (F.col("a.id") < F.col("b.id"))
    for t in touch:
        meet = meet & t
    pairs = cells.alias("a").join(cells.alias("b"), meet)

    def vertex_on(edge: str, x: Column, y: Column) -> Column:
        """The vertex, where it lies on the inside of the edge."""
        x0, y0, x1, y1 = _of(edge)
        dx, dy = x1 - x0, y1 - y0
        length = F.hypot(dx, dy)
        along = ((x - x0) * dx + (y - y0) * dy) / length
        off = F.abs(_turn(x0, y0, x1, y1, x, y)) / length
        on = (off <= NEAR) & (along > 0) & (along < length) & (F.hypot(x - x0, y - y0) > NEAR) & (F.hypot(x - x1, y - y1) > NEAR)
        return F.when(on, F.struct(F.col(f"{edge}.id").alias("id"), x.alias("x"), y.alias("y")))

    ax0, ay0, ax1, ay1 = _of("a")
    bx0, by0, bx1, by1 = _of("b")
    den = (ax1 - ax0) * (by1 - by0) - (ay1 - ay0) * (bx1 - bx0)
    t = F.try_divide((bx0 - ax0) * (by1 - by0) - (by0 - ay0) * (bx1 - bx0), den)
    u = F.try_divide((bx0 - ax0) * (ay1 - ay0) - (by0 - ay0) * (ax1 - ax0), den)
    px, py = F.round(ax0 + t * (ax1 - ax0), DECIMALS), F.round(ay0 + t * (ay1 - ay0), DECIMALS)
    inside = (t > 0) & (t < 1) & (u > 0) & (u < 1)
    for x, y in ((ax0, ay0), (ax1, ay1), (bx0, by0), (bx1, by1)):
        inside = inside & (F.hypot(px - x, py - y) > NEAR)
    crossing = [F.when(inside, F.struct(F.col(f"{e}.id").alias("id"), px.alias("x"), py.alias("y"))) for e in ("a", "b")]
    found = [vertex_on("a", bx0, by0), vertex_on("a", bx1, by1), vertex_on("b", ax0, ay0), vertex_on("b", ax1, ay1), *crossing]
    return pairs.select(F.explode(F.array_compact(F.array(*found))).alias("c")).select("c.*").distinct()


def touched(edges: DataFrame, key: str) -> DataFrame:
    """Ids of the edges (key, id, x0, y0, x1, y1) that another of their key crosses, or meets
    with an end anywhere but at their ends."""
    forward = F.struct("x0", "y0") < F.struct("x1", "y1")
    a = [F.when(forward, F.col(c)).otherwise(F.col(d)).alias(c) for c, d in zip(ENDS, ("x1", "y1", "x0", "y0"))]
    placed = _gridded(edges.filter("x0 <> x1 OR y0 <> y1").select(key, "id", *a), key)
    return _cuts(placed, key).select("id").distinct()


def pieces(edges: DataFrame, key: str, parity: bool = False) -> DataFrame:
    """Edges cut until they meet at their ends only: key, x0, y0, x1, y1, net, with an id and their grid.

    ``edges`` are directed, key, x0, y0, x1, y1. Pieces drawn twice merge, ``net`` counts them
    with their direction, and pieces that cancel are left out: of members that share borders
    only the outer ones are ever compared. Cutting moves a piece by ``NEAR`` at most, which may
    let it touch another, so cutting is repeated until nothing is cut.
    """
    found = cut_lineage(_merged(edges.select(key, *ENDS, F.lit(1).cast("long").alias("net")), key, parity))
    while True:
        # ids are those of a written table, so that a lost task numbers alike
        placed = cut_lineage(_gridded(found, key).withColumn("id", F.monotonically_increasing_id()))
        cuts = cut_lineage(_cuts(placed, key))
        if not cuts.limit(1).count():
            return placed
        along = F.abs(F.col("x") - F.col("x0")) + F.abs(F.col("y") - F.col("y0"))
        point = F.struct(along.alias("k"), "x", "y")
        cut = placed.select("id", key, *ENDS, "net").join(cuts, "id").groupBy("id", key, *ENDS, "net").agg(F.sort_array(F.collect_set(point)).alias("c"))
        listed = F.concat(
            F.array(F.struct(F.lit(0.0).alias("k"), F.col("x0").alias("x"), F.col("y0").alias("y"))),
            F.col("c"),
            F.array(F.struct(F.lit(0.0).alias("k"), F.col("x1").alias("x"), F.col("y1").alias("y"))),
        )
        steps = F.zip_with(
            F.slice(listed, 1, F.size(listed) - 1),
            F.slice(listed, 2, F.size(listed) - 1),
            lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")),
        )
        parts = cut.select(key, F.explode(steps).alias("s"), "net").select(key, "s.*", "net")
        whole = placed.join(cuts.select("id").distinct(), "id", "left_anti").select(key, *ENDS, "net")
        found = cut_lineage(_merged(whole.unionByName(parts), key, parity))


def sides(cut: DataFrame, key: str) -> DataFrame:
    """``pieces`` with how often the area left and right of them is covered.

    Coverage at the corner of a cell is the sum of what crosses its column's line below it, a
    running sum over the column. From there to the middle of a piece only the pieces of the
    cell can be crossed.
    """
    named = cut
    first, last = F.ceil((F.col("x0") - F.col("ox")) / F.col("w")), F.ceil((F.col("x1") - F.col("ox")) / F.col("w")) - 1
    line = F.col("ox") + F.col("i") * F.col("w")
    crossed = (
        named.filter(last >= first)
        .withColumn("i", F.explode(F.sequence(first, last)))
        .withColumn("j", _cell(_y_at(line), "oy"))
        .select(key, "i", "j", "net", F.lit(False).alias("wanted"))
    )
    mid = named.withColumns({"mx": (F.col("x0") + F.col("x1")) / 2, "my": (F.col("y0") + F.col("y1")) / 2})
    mid = mid.withColumns({"i": _cell(F.col("mx"), "ox"), "j": _cell(F.col("my"), "oy")})
    wanted = mid.select(key, "i", "j", F.lit(0).cast("long").alias("net"), F.lit(True).alias("wanted"))
    below = Window.partitionBy(key, "i").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    corners = (
        crossed.unionByName(wanted)
        .groupBy(key, "i", "j")
        .agg(F.sum("net").alias("net"), F.max("wanted").alias("wanted"))
        .withColumn("corner", F.coalesce(F.sum("net").over(below), F.lit(0)))
        .filter("wanted")
        .select(key, "i", "j", "corner")
    )
    cells = _cells(named).select(key, "i", "j", F.col("id").alias("other"), *(F.col(c).alias(f"o{c}") for c in ENDS), F.col("net").alias("onet"))
    cx, cy = F.col("ox") + F.col("i") * F.col("w"), F.col("oy") + F.col("j") * F.col("w")
    mx, my = F.col("mx"), F.col("my")
    ox0, oy0, ox1, oy1 = (F.col(f"o{c}") for c in ENDS)
    apart = (_turn(cx, cy, mx, my, ox0, oy0) >= 0) != (_turn(cx, cy, mx, my, ox1, oy1) >= 0)
    start, end = _turn(ox0, oy0, ox1, oy1, cx, cy) > 0, _turn(ox0, oy0, ox1, oy1, mx, my) > 0
    step = F.when((F.col("other") != F.col("id")) & apart & (start != end), F.when(end, F.col("onet")).otherwise(-F.col("onet"))).otherwise(0)
    reached = mid.join(cells, [key, "i", "j"]).groupBy("id").agg(F.sum(step).alias("step"))
    found = mid.join(corners, [key, "i", "j"]).join(reached, "id")
    came_left = _turn(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), cx, cy) > 0
    here = F.col("corner") + F.col("step")
    return found.select(
        key,
        *ENDS,
        F.when(came_left, here).otherwise(here + F.col("net")).alias("left"),
        F.when(came_left, here - F.col("net")).otherwise(here).alias("right"),
    )


def outline(edges: DataFrame, key: str, parity: bool = False) -> DataFrame:
    """Directed edges ``key, x0, y0, x1, y1`` of the covered area, which lies on their left.

    Covered is what the rings of ``edges`` run around more often left than right; with
    ``parity`` what they run around an odd number of times, the even-odd repair of a geometry.
    """
    found = sides(pieces(edges, key, parity), key)
    left, right = ((F.col(c) % 2 != 0) if parity else (F.col(c) > 0) for c in ("left", "right"))
    kept = found.filter(left != right)
    turned = dict(zip(ENDS, ("x1", "y1", "x0", "y0")))
    return kept.select(key, *(F.when(left, F.col(c)).otherwise(F.col(turned[c])).alias(c) for c in ENDS))
