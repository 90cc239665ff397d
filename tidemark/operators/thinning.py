"""Thinning of rings to a tolerance, vertex rows at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import wkb
from tidemark.operators import arrangement
from tidemark.schemas import RINGS
from tidemark.session import cut_lineage

PLACE = ["part", "ring"]


def _distance(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Distance of a point from a segment."""
    dx, dy = x1 - x0, y1 - y0
    along = F.coalesce(F.try_divide((x - x0) * dx + (y - y0) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(x - x0 - t * dx, y - y0 - t * dy)


def kept_vertices(vertices: DataFrame, ring: Sequence[str], tolerance: float) -> DataFrame:
    """Rows ``ring``, pos, x, y of the vertices that stay.

    A ring keeps its start, its end and the vertex farthest from them. In each round every
    stretch between kept vertices keeps its farthest vertex if that lies beyond the tolerance,
    all stretches of all rings at once; rounds end when none does. A vertex carries the ends of
    its stretch, so that a ring is dealt by stretch: farthest vertices are maxima combined on the
    map side, and a stretch that keeps none is done with.
    """
    ring = list(ring)
    start = vertices.filter("pos = 0").select(*ring, F.struct("pos", "x", "y").alias("o"))
    here = F.struct("pos", "x", "y")
    far_off = F.hypot(F.col("x") - F.col("o.x"), F.col("y") - F.col("o.y"))
    ends = (
        vertices.join(start, ring)
        .groupBy(*ring)
        .agg(F.first("o").alias("o"), F.max_by(here, "pos").alias("z"), F.max(F.struct(far_off.alias("d"), (-F.col("pos")).alias("p"), "x", "y")).alias("m"))
        .select(*ring, "o", "z", F.struct((-F.col("m.p")).alias("pos"), "m.x", "m.y").alias("m"))
    )
    ends = cut_lineage(ends)
    kept = ends.select(*ring, F.explode(F.array_distinct(F.array("o", "m", "z"))).alias("v")).select(*ring, "v.*")
    first = F.col("pos") < F.col("m.pos")
    state = cut_lineage(
        vertices.join(ends, ring)
        .filter("pos <> o.pos AND pos <> m.pos AND pos <> z.pos")
        .select(*ring, "pos", "x", "y", F.when(first, F.col("o")).otherwise(F.col("m")).alias("a"), F.when(first, F.col("m")).otherwise(F.col("z")).alias("b"))
    )
    while state.limit(1).count():
        d = _distance(*(F.col(c) for c in ("x", "y", "a.x", "a.y", "b.x", "b.y")))
        far = cut_lineage(
            state.withColumn("at", F.col("a.pos"))
            .groupBy(*ring, "at")
            .agg(F.max(F.struct(d.alias("d"), (-F.col("pos")).alias("p"), "x", "y")).alias("m"))
            .filter(F.col("m.d") > tolerance)
            .select(*ring, "at", F.struct((-F.col("m.p")).alias("pos"), "m.x", "m.y").alias("m"))
        )
        kept = kept.unionByName(far.select(*ring, "m.*"))
        before = F.col("pos") < F.col("m.pos")
        state = cut_lineage(
            state.withColumn("at", F.col("a.pos"))
            .join(far, [*ring, "at"])
            .filter("pos <> m.pos")
            .select(*ring, "pos", "x", "y", F.when(before, F.col("a")).otherwise(F.col("m")).alias("a"), F.when(before, F.col("m")).otherwise(F.col("b")).alias("b"))
        )
    return kept


def untangled(kept: DataFrame, vertices: DataFrame, keys: Sequence[str], ring: Sequence[str]) -> DataFrame:
    """The kept vertices, and all vertices of the stretches that meet others of their geometry
    somewhere else than at their ends, until no such stretch has a vertex left to put back."""
    keys, ring = list(keys), list(ring)
    kept = cut_lineage(kept)
    while True:
        next_ = F.lead(F.struct("pos", "x", "y")).over(Window.partitionBy(*ring).orderBy("pos"))
        stretches = cut_lineage(
            kept.withColumn("n", next_)
            .filter("n IS NOT NULL")
            .select(*ring, "pos", F.col("n.pos").alias("upto"), F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("n.x").alias("x1"), F.col("n.y").alias("y1"), F.struct(*keys).alias("_key"))
            .withColumn("id", F.monotonically_increasing_id())
        )
        met = arrangement.touched(stretches, "_key")
        tangled = cut_lineage(stretches.filter("upto > pos + 1").join(met, "id", "left_semi").select(*ring, F.col("pos").alias("_from"), "upto"))
        if not tangled.limit(1).count():
            return kept
        back = vertices.join(tangled, ring).filter("pos > _from AND pos < upto").select(*ring, "pos", "x", "y")
        kept = cut_lineage(kept.unionByName(back))


def simplify(df: DataFrame, tolerance: float, keys: Sequence[str] = ("level", "code")) -> DataFrame:
    """``df`` with its ``rings`` thinned to a tolerance in their own units; zero or less disables.

    ``keys`` name a row; rows of one name are told apart by their rings. Where thinned stretches
    cross, their vertices are put back and the rest stays thinned. A ring that would fall below
    four points, and a geometry that is not simple even so, as a hole may come to lie outside
    its shell, keep their points.
    """
    if tolerance <= 0:
        return df
    named = df.withColumn("_shape", F.xxhash64("rings"))
    keys = [*keys, "_shape"]
    ring = [*keys, *PLACE]
    vertices = cut_lineage(
        named.select(*keys, "rings").dropDuplicates(keys).select(*keys, F.explode("rings").alias("r")).select(*keys, "r.part", "r.ring", F.posexplode("r.pts").alias("pos", "p")).select(
            *ring, "pos", "p.x", "p.y"
        )
    )
    listed = F.sort_array(F.collect_list(F.struct("pos", F.struct("x", "y").alias("p"))))
    kept = untangled(kept_vertices(vertices, ring, tolerance), vertices, keys, ring)
    thin = kept.groupBy(*ring).agg(F.transform(listed, lambda v: v["p"]).alias("pts"))
    row = F.struct(*PLACE, "pts")
    rings = (
        thin.filter(F.size("pts") >= 4).groupBy(*keys).agg(F.collect_list(row).cast(RINGS).alias("_thin"))
    )

    def lighter(r: Column) -> Column:
        """The thinned ring of the same place, or the ring itself."""
        own = F.filter("_thin", lambda t: (t["part"] == r["part"]) & (t["ring"] == r["ring"]))
        return F.coalesce(F.get(own, F.lit(0)), r)

    met = named.join(rings, keys, "left").withColumn("_new", F.when(F.col("_thin").isNotNull(), F.transform("rings", lighter)).otherwise(F.col("rings")))
    checked = met.withColumn("_ok", wkb.is_simple("_new"))
    return checked.withColumn("rings", F.when(F.col("_ok"), F.col("_new")).otherwise(F.col("rings"))).select(*df.columns)
