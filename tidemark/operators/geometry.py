"""Dissolve, representative points and dataset statistics of boundary geometry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import geo, outlines
from tidemark.functions.text import let
from tidemark.operators import arrangement, overlap
from tidemark.operators.ranking import staged_rank
from tidemark.schemas import RINGS
from tidemark.session import cut_lineage


#: Edges of a key up to which its outline is found in one task, with others by the batch; the
#: edges of longer ones are rows.
SMALL_EDGES = 128


def _edges_of(members: DataFrame) -> Column:
    return geo.ring_edges(F.col("rings")) if "rings" in members.columns else F.col("edges")


def member_edges(members: DataFrame, key: str) -> DataFrame:
    """Directed edges of all members' rings."""
    return members.select(key, F.explode(_edges_of(members)).alias("e")).select(key, "e.x0", "e.y0", "e.x1", "e.y1")


def outline(members: DataFrame, key: str) -> DataFrame:
    """Edges of the union of members, whether they share borders, overlap or repeat. Rings must
    be valid each; `repaired` makes them so."""
    return arrangement.outline(member_edges(members, key), key)


def _successors(edges: DataFrame, key: str) -> DataFrame:
    """``edges`` with the ``next`` edge of each: where several leave a point, the sharpest left
    turn keeps to the same area. An edge that ends where none begins has no ``next``."""
    leaving = edges.select(
        F.col(key).alias("_k"), F.col("id").alias("_id"), F.col("x0").alias("_x"), F.col("y0").alias("_y"),
        F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")).alias("_h"),
    )
    heading = F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    turn = F.pmod(F.col("_h") - heading + F.lit(math.pi), F.lit(2 * math.pi))
    meet = (F.col(key) == F.col("_k")) & (F.col("x1") == F.col("_x")) & (F.col("y1") == F.col("_y"))
    best = F.max(F.when(F.col("_id").isNotNull(), F.struct(turn.alias("turn"), "_id")))
    return edges.join(leaving, meet, "left").groupBy(key, "id", *arrangement.ENDS).agg(best["_id"].alias("next"))


def _walked(edges: DataFrame) -> DataFrame:
    """``edges`` (id, next, ...) with the smallest id of their ring, the steps to it, and whether
    the chain is open.

    Every edge knows the smallest id among the next 2**n edges and how far it is. A round asks
    the edge 2**n ahead, so that rounds grow with the logarithm of the longest ring. They end
    when no smallest id changes: then it is that of the whole ring.
    """
    state = edges.select("id", "next", F.col("id").alias("ring"), F.lit(0).cast("long").alias("steps"), F.lit(False).alias("open"))
    reach = 1
    while True:
        ahead = state.select(*(F.col(c).alias(f"_{c}") for c in ("id", "next", "ring", "steps", "open")))
        nearer = F.coalesce(F.col("_ring") < F.col("ring"), F.lit(False))
        opened = F.col("next").isNull() | F.coalesce("_open", F.lit(False))
        new = cut_lineage(
            state.join(ahead, F.col("next") == F.col("_id"), "left").select(
                "id",
                F.col("_next").alias("next"),
                F.when(nearer, F.col("_ring")).otherwise(F.col("ring")).alias("ring"),
                F.when(nearer, F.col("_steps") + reach).otherwise(F.col("steps")).alias("steps"),
                (F.col("open") | opened).alias("open"),
                (nearer | (opened & ~F.col("open"))).alias("moved"),
            )
        )
        moved = new.filter("moved").limit(1).count()
        state, reach = new.drop("moved"), reach * 2
        if not moved:
            return edges.join(state.drop("next"), "id")


def _loops(walked: DataFrame, key: str) -> DataFrame:
    """``id, next`` that close a ring's loops where it comes back to a point: each edge into the
    point goes on with the edge that left it one visit earlier."""
    visits = walked.filter("NOT open").select("id", "ring", "steps", "x0", "y0", key)
    turn = Window.partitionBy(key, "ring", "x0", "y0").orderBy(F.col("steps").desc())
    again = F.count(F.lit(1)).over(Window.partitionBy(key, "ring", "x0", "y0"))
    left = visits.withColumn("n", again).filter("n > 1").select(
        "id",
        F.lag("id").over(turn).alias("before"),
        F.last("id").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("latest"),
    )
    return left.select(F.col("id").alias("next"), F.coalesce("before", "latest").alias("_new"))


def ring_rows(edges: DataFrame, key: str) -> DataFrame:
    """Rows of directed edges with their ring: key, id, x0, y0, x1, y1, ring, steps, open.

    Rings come from pointer doubling over rows of edges, so that a long outline is spread over
    tasks. A ring that comes back to a point is cut there into rings that touch in it.
    """
    named = cut_lineage(edges.withColumn("id", F.monotonically_increasing_id()))
    linked = cut_lineage(_successors(named, key))
    walked = cut_lineage(_walked(linked))
    turned = cut_lineage(_loops(walked, key))
    if not turned.limit(1).count():
        return walked
    split = linked.join(turned, "next", "left").withColumn("next", F.coalesce("_new", "next")).drop("_new")
    return cut_lineage(_walked(cut_lineage(split)))


def closed_rings(rows: DataFrame, key: str) -> DataFrame:
    """``key, ring, pts, area`` of every closed ring of `ring_rows`, from its smallest id on;
    ``area`` is twice the signed one. Open chains give no ring."""
    point = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y"))
    listed = F.sort_array(F.collect_list(F.struct((-F.col("steps")).alias("k"), point.alias("p"))))
    pts = F.transform(listed, lambda q: q["p"])
    rings = rows.filter("NOT open").groupBy(key, "ring").agg(pts.alias("pts")).withColumn("pts", F.concat("pts", F.array(F.col("pts")[0])))
    return rings.withColumn("area", geo.twice_ring_area(F.col("pts")))


def hole_homes(rows: DataFrame, sized: DataFrame, key: str) -> DataFrame:
    """``key, hole, shell`` for rings of negative area.

    Left of a hole's leftmost vertex lies the area it is cut from, up to that area's next
    border: its shell, or another of its holes, whose shell it is then. Edges and holes meet in
    bands of rows, and holes that point at holes are followed by doubling.
    """
    holes = sized.filter("area < 0").select(F.col("ring"))
    low = rows.join(holes, "ring", "left_semi").groupBy(key, "ring").agg(F.min(F.struct("x0", "y0")).alias("p"))
    band = rows.groupBy(key).agg((F.avg(F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))) * 2).alias("band"))
    at = low.join(band, key).select(
        key, F.col("ring").alias("hole"), F.col("p.x0").alias("px"), F.col("p.y0").alias("py"), F.floor(F.col("p.y0") / F.col("band")).alias("j")
    )
    lower, upper = F.least("y0", "y1"), F.greatest("y0", "y1")
    spans = rows.filter("NOT open AND y0 <> y1").join(band, key).withColumn(
        "j", F.explode(F.sequence(F.floor(lower / F.col("band")), F.floor(upper / F.col("band"))))
    )
    x = F.col("x0") + (F.col("py") - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    met = at.join(spans.drop("band", "id", "steps", "open"), [key, "j"]).filter((F.col("ring") != F.col("hole")) & ((F.col("y0") <= F.col("py")) != (F.col("y1") <= F.col("py"))))
    next_ = met.withColumn("x", x).filter(F.col("x") <= F.col("px")).groupBy(key, "hole").agg(F.max_by("ring", "x").alias("home"))
    state = cut_lineage(next_.join(holes.select(F.col("ring").alias("home"), F.lit(True).alias("again")), "home", "left"))
    while state.filter("again").limit(1).count():
        ahead = state.select(F.col("hole").alias("home"), F.col("home").alias("_home"), F.col("again").alias("_again"))
        state = cut_lineage(
            state.join(ahead, "home", "left").select(key, "hole", F.coalesce(F.when(F.col("again"), F.col("_home")), F.col("home")).alias("home"), F.when(F.col("again"), F.col("_again")).alias("again"))
        )
    return state.select(key, "hole", F.col("home").alias("shell"))


def shapes(rows: DataFrame, key: str) -> DataFrame:
    """``key, rings`` from `ring_rows`: shells by area, each with its holes by area."""
    sized = cut_lineage(closed_rings(rows, key))
    light = sized.select(key, "ring", "area", F.array_min("pts").alias("corner"))
    if light.filter("area < 0").limit(1).count():
        homes = hole_homes(rows, light, key)
    else:
        homes = light.select(key, F.col("ring").alias("hole"), F.col("ring").alias("shell")).limit(0)
    shells = staged_rank(light.filter("area > 0"), [key], [F.floor(F.log2("area"))], [F.col("area"), F.col("corner")], "part")
    cut = homes.join(light.select(F.col("ring").alias("hole"), "area", "corner"), "hole").join(shells.select(F.col("ring").alias("shell"), "part"), "shell")
    inner = staged_rank(cut, [key, "shell", "part"], [F.floor(F.log2(-F.col("area")))], [F.col("area").desc(), F.col("corner")], "nth")
    placed = shells.select("ring", (F.col("part") - 1).alias("part"), F.lit(0).cast("long").alias("nth")).unionByName(
        inner.select(F.col("hole").alias("ring"), (F.col("part") - 1).alias("part"), "nth")
    )
    row = F.struct(F.col("part").cast("int").alias("part"), F.col("nth").cast("int").alias("ring"), "pts")
    listed = sized.select(key, "ring", "pts").join(placed, "ring")
    return listed.groupBy(key).agg(F.sort_array(F.collect_list(row)).cast(RINGS).alias("rings"))


def dissolve_with_rejects(members: DataFrame, key: str = "target_code") -> tuple[DataFrame, DataFrame]:
    """``key, rings`` of the union per key, and ``key, reason`` of keys that have none.

    A key is rejected if its members have no area (``no area``), or if an outline doesn't close
    (``open outline``), which sound rings can't give; its closed rings aren't published then.
    """
    drawn = cut_lineage(members.select(key, _edges_of(members).alias("edges")))
    long = drawn.groupBy(key).agg(F.sum(F.size("edges")).alias("n")).filter(F.col("n") > SMALL_EDGES)
    long = cut_lineage(long.filter(F.col(key).isNotNull()).select(key))
    some = long.limit(1).count() > 0
    short = drawn.join(long, key, "left_anti") if some else drawn
    # a null key names no outline
    listed = F.when(F.col(key).isNotNull(), F.flatten(F.collect_list("edges")))
    near = cut_lineage(short.groupBy(key).agg(listed.alias("edges")).select(key, outlines.union_outline("edges").alias("g")))
    none, broken = F.lit("no area"), F.lit("open outline")
    reason = F.when(F.col("g.open"), broken).when(F.size("g.rings") == 0, none)
    near = near.select(key, "g.rings", reason.alias("reason"))
    found, rejects = near.filter("reason IS NULL").select(key, "rings"), near.filter("reason IS NOT NULL").select(key, "reason")
    if not some:
        return found, rejects
    rows = ring_rows(outline(drawn.join(long, key, "left_semi"), key), key)
    opened = cut_lineage(rows.filter("open").select(key).distinct())
    far = cut_lineage(shapes(rows.join(opened, key, "left_anti"), key))
    empty = long.join(far, key, "left_anti").join(opened, key, "left_anti")
    rejects = rejects.unionByName(opened.withColumn("reason", broken)).unionByName(empty.withColumn("reason", none))
    return found.unionByName(far), rejects


def dissolve(members: DataFrame, key: str = "target_code") -> DataFrame:
    """``key, rings`` of the union of the members of each key."""
    return dissolve_with_rejects(members, key)[0]


def repaired(rows: DataFrame, valid: str = "valid") -> DataFrame:
    """``rows`` with the rings of those that aren't ``valid`` replaced by the outline of what
    they run around an odd number of times, shells with holes. Rings without such area become
    empty. ``rows`` should be a written table, as it is read twice."""
    sound = F.coalesce(F.col(valid), F.lit(False))
    edges = F.aggregate("rings", F.lit(0), lambda n, r: n + F.coalesce(F.size(r["pts"]), F.lit(0)))
    long = F.coalesce(edges > SMALL_EDGES, F.lit(False))
    drawn = outlines.even_odd_outline(geo.ring_edges(F.col("rings")))["rings"]
    near = cut_lineage(rows.filter(~sound & ~long).withColumn("rings", drawn))
    done = rows.filter(sound).unionByName(near)
    wrong = cut_lineage(rows.filter(~sound & long).withColumn("_row", F.monotonically_increasing_id()))
    if not wrong.limit(1).count():
        return done
    found = shapes(ring_rows(arrangement.outline(member_edges(wrong, "_row"), "_row", parity=True), "_row"), "_row")
    mended = wrong.drop("rings").join(found, "_row", "left").withColumn("rings", F.coalesce("rings", F.array().cast(RINGS)))
    return done.unionByName(mended.select(*rows.columns))


def sibling_overlaps(units: DataFrame) -> DataFrame:
    """Pairs of units of one level that overlap, with the shared area, lower code first."""
    own = units.withColumn("row_id", F.col("code")).withColumn("own_level", F.col("level"))
    pairs = overlap.overlap(own, overlap.unit_fragments(units), carry=("own_level",))
    return pairs.filter("own_level = level AND row_id < code").select(
        "level", F.col("row_id").alias("code_a"), F.col("code").alias("code_b"), "intersection_area_km2"
    )


def _scanline(rings: Column) -> Column:
    """Midway between the vertices next above and below the middle of the extent."""
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r["pts"], lambda p: p["y"])))

    def middle(v: Column) -> Column:
        c = (F.array_min(v) + F.array_max(v)) / 2
        low = F.array_max(F.filter(v, lambda y: y <= c))
        high = F.array_min(F.filter(v, lambda y: y > c))
        return (low + F.coalesce(high, low)) / 2

    return let(ys, middle)


def _widest(rings: Column) -> Column:
    """Widest interior stretch of one part along its scan line."""

    def along(y: Column) -> Column:
        spanning = F.filter(geo.ring_edges(rings), lambda e: (e["y0"] > y) != (e["y1"] > y))
        xs = F.array_sort(
            F.transform(
                spanning,
                lambda e: e["x0"] + (y - e["y0"]) * (e["x1"] - e["x0"]) / (e["y1"] - e["y0"]),
            )
        )
        return F.struct(y.alias("y"), xs.alias("xs"))

    def widest(s: Column) -> Column:
        odd = F.filter(
            F.transform(
                s["xs"],
                lambda x, i: F.struct(
                    (F.get(s["xs"], i + 1) - x).alias("width"),
                    ((F.get(s["xs"], i + 1) + x) / 2).alias("x"),
                    s["y"].alias("y"),
                    (i % 2).alias("odd"),
                ),
            ),
            lambda v: (v["odd"] == 0) & v["width"].isNotNull(),
        )
        return F.array_max(odd)

    return let(let(_scanline(rings), along), widest)


def representative_point(rings: Column) -> Column:
    """``struct(width, x, y, ...)`` of the widest stretch over all parts; x and y are a point
    inside the geometry."""
    return F.array_max(F.transform(geo.parts_of(rings), _widest))


def with_centroids(units: DataFrame) -> DataFrame:
    p = representative_point(F.col("rings"))
    return units.withColumn("_p", p).select(
        *units.columns, F.col("_p.y").alias("centroid_lat"), F.col("_p.x").alias("centroid_lng")
    )


def dataset_stats(units: DataFrame, *keys: str) -> DataFrame:
    """Extent and sorted geometry types of a dataset, for the geo sidecar."""
    b = units.select(*keys, geo.bounds(F.col("rings")).alias("b"), geo.geometry_type(F.col("rings")).alias("t"))
    return b.groupBy(*keys).agg(
        F.min("b.xmin").alias("xmin"),
        F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"),
        F.max("b.ymax").alias("ymax"),
        F.array_join(F.sort_array(F.collect_set("t")), ",").alias("geometry_types"),
    )
