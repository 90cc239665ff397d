"""Planar geometry as column expressions: projection, extents, areas, edge lists."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS 84 ellipsoid and the 30 degree standard parallel of the
# equal-area cylindrical projection (EPSG:6933).
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
STANDARD_PARALLEL_DEG = 30.0

E2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(E2)
_phi1 = math.radians(STANDARD_PARALLEL_DEG)
K0 = math.cos(_phi1) / math.sqrt(1 - E2 * math.sin(_phi1) ** 2)
X_SCALE = SEMI_MAJOR_M * K0
Y_SCALE = SEMI_MAJOR_M / (2 * K0)


def project_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(X_SCALE)


def project_y(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    q = F.lit(1 - E2) * (
        s / (1 - F.lit(E2) * s * s)
        - F.lit(1 / (2 * ECC)) * F.log((1 - F.lit(ECC) * s) / (1 + F.lit(ECC) * s))
    )
    return F.lit(Y_SCALE) * q


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def single_ring(*pts: Column) -> Column:
    """One-part, one-ring geometry; the points must be closed and counter-clockwise."""
    return F.array(
        F.struct(F.lit(0).alias("part"), F.lit(0).alias("ring"), F.array(*pts).alias("pts"))
    )


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return single_ring(
        point(xmin, ymin),
        point(xmax, ymin),
        point(xmax, ymax),
        point(xmin, ymax),
        point(xmin, ymin),
    )


def steps(pts: Column) -> Column:
    """Consecutive point pairs of one ring."""
    n = F.greatest(F.size(pts) - 1, F.lit(0))
    return F.zip_with(
        F.slice(pts, F.lit(1), n),
        F.slice(pts, F.lit(2), n),
        lambda a, b: F.struct(
            a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")
        ),
    )


def twice_ring_area(pts: Column) -> Column:
    """Signed shoelace sum about the ring's first point; positive when counter-clockwise."""
    ox, oy = pts[0]["x"], pts[0]["y"]
    return F.aggregate(
        steps(pts),
        F.lit(0.0),
        lambda acc, e: acc
        + (e["x0"] - ox) * (e["y1"] - oy)
        - (e["x1"] - ox) * (e["y0"] - oy),
    )


def orient(rings: Column) -> Column:
    """Shells counter-clockwise, holes clockwise, as the overlap integral expects."""
    return F.transform(
        rings,
        lambda r: F.struct(
            r["part"].alias("part"),
            r["ring"].alias("ring"),
            F.when(
                (twice_ring_area(r["pts"]) < 0) == (r["ring"] == 0), F.reverse(r["pts"])
            )
            .otherwise(r["pts"])
            .alias("pts"),
        ),
    )


def project_rings(rings: Column) -> Column:
    return F.transform(
        rings,
        lambda r: F.struct(
            r["part"].alias("part"),
            r["ring"].alias("ring"),
            F.transform(r["pts"], lambda p: point(project_x(p["x"]), project_y(p["y"]))).alias(
                "pts"
            ),
        ),
    )


def area_km2(rings: Column) -> Column:
    """Area of oriented lon/lat rings on the ellipsoid's equal-area plane."""
    total = F.aggregate(
        F.transform(project_rings(rings), lambda r: twice_ring_area(r["pts"])),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )
    return F.abs(total) / F.lit(2e6)


def ring_edges(rings: Column) -> Column:
    """Directed edges of all rings."""
    return F.flatten(F.transform(rings, lambda r: steps(r["pts"])))


def _axis(rings: Column, axis: str) -> Column:
    return F.flatten(F.transform(rings, lambda r: F.transform(r["pts"], lambda p: p[axis])))


def bounds(rings: Column) -> Column:
    """Extent of one geometry; null sides when it has no points."""
    return F.struct(
        F.array_min(_axis(rings, "x")).alias("xmin"),
        F.array_min(_axis(rings, "y")).alias("ymin"),
        F.array_max(_axis(rings, "x")).alias("xmax"),
        F.array_max(_axis(rings, "y")).alias("ymax"),
    )


def is_empty(rings: Column) -> Column:
    return F.coalesce(F.size(rings), F.lit(0)) <= 0


def geometry_type(rings: Column) -> Column:
    parts = F.array_max(F.transform(rings, lambda r: r["part"]))
    return F.when(parts > 0, F.lit("MultiPolygon")).otherwise(F.lit("Polygon"))


def coordinates_to_rings(path: Column) -> Column:
    """Coordinate text of nesting 4 (parts) or 3 (one part), ``[lat, lng]`` pairs, to rings.

    Any other nesting gives null, which callers route to a reject table.
    """
    deep = F.from_json(path, "array<array<array<array<double>>>>", {"mode": "PERMISSIVE"})
    flat = F.from_json(path, "array<array<array<double>>>", {"mode": "PERMISSIVE"})
    nested = F.regexp_extract(path, r"^([\[\s]+)", 1)
    depth = F.length(F.regexp_replace(nested, r"\s", ""))
    parts = F.when(depth == 4, deep).when(depth == 3, F.array(flat))
    return F.flatten(
        F.transform(
            parts,
            lambda part, pi: F.transform(
                part,
                lambda ring, ri: F.struct(
                    pi.cast("int").alias("part"),
                    ri.cast("int").alias("ring"),
                    F.transform(ring, lambda c: point(c[1], c[0])).alias("pts"),
                ),
            ),
        )
    )


def parts_of(rings: Column) -> Column:
    """Rings of each part. Rings in the order of their parts are cut where a part begins, one
    look at each; those in another order are looked through for every part."""

    def cut(starts: Column) -> Column:
        stops = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(rings) + 1))
        return F.zip_with(starts, F.slice(stops, 1, F.size(starts)), lambda a, b: F.slice(rings, a, b - a))

    before = lambda i: F.get(rings, i - 2)["part"]
    part = lambda i: F.get(rings, i - 1)["part"]
    # no sequence counts down to an empty array's size
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(rings), F.lit(1))), lambda i: i <= F.size(rings))
    ordered = F.forall(places, lambda i: F.coalesce((i == 1) | (before(i) <= part(i)), F.lit(False)) & part(i).isNotNull())
    starts = F.filter(places, lambda i: (i == 1) | (before(i) != part(i)))
    parts = F.array_distinct(F.transform(rings, lambda r: r["part"]))
    searched = F.transform(parts, lambda p: F.filter(rings, lambda r: r["part"] == p))
    return F.when(rings.isNotNull() & ordered, F.transform(F.array(starts), cut)[0]).otherwise(searched)


def geojson_geometry(rings: Column) -> Column:
    """MultiPolygon struct ready for ``to_json``."""
    coords = F.transform(
        parts_of(rings),
        lambda p: F.transform(p, lambda r: F.transform(r["pts"], lambda c: F.array(c["x"], c["y"]))),
    )
    return F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates"))
