"""Unions and repairs against coverage of a fine grid, and rings that must not be lost."""

import contextlib
import io
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import geo, wkb
from tidemark.operators import arrangement, geometry, thinning
from tidemark.schemas import RINGS


def ring(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in [*pts, pts[0]]]


def box(a, b, c, d):
    return ring((a, b), (c, b), (c, d), (a, d))


def hole(a, b, c, d):
    return ring((a, b), (a, d), (c, d), (c, b))


def shape(*parts):
    return [{"part": p, "ring": k, "pts": pts} for p, rings in enumerate(parts) for k, pts in enumerate(rings)]


def frame(spark, rows):
    schema = T.StructType([T.StructField("target_code", T.StringType()), T.StructField("rings", RINGS), T.StructField("valid", T.BooleanType())])
    return spark.createDataFrame([(k, g, ok) for k, g, ok in rows], schema)


def inside(x, y, pts):
    """Winding number of the points (x, y)."""
    found = np.zeros(len(x), int)
    for a, b in zip(pts, pts[1:]):
        up = (a["y"] <= y) & (b["y"] > y)
        down = (a["y"] > y) & (b["y"] <= y)
        side = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        found += (up & (side > 0)).astype(int) - (down & (side < 0)).astype(int)
    return found


def same_cover(rings, members, parity=False, n=20_000, seed=1):
    """Random points are inside the result where they are inside a member."""
    xs = [p["x"] for g in members for r in g for p in r["pts"]]
    ys = [p["y"] for g in members for r in g for p in r["pts"]]
    rng = np.random.default_rng(seed)
    x, y = rng.uniform(min(xs) - 0.1, max(xs) + 0.1, n), rng.uniform(min(ys) - 0.1, max(ys) + 0.1, n)
    want = np.zeros(n, bool)
    for g in members:
        turns = sum(inside(x, y, r["pts"]) for r in g)
        want |= (turns % 2 != 0) if parity else (turns > 0)
    got = sum((inside(x, y, r["pts"]) for r in rings), np.zeros(n, int))
    assert set(np.unique(got)) <= {0, 1}
    assert ((got == 1) == want).all()


def test_overlapping_doubled_and_nested_members(spark):
    cases = {
        "overlap": [shape([box(0, 0, 2, 2)]), shape([box(1, 1, 3, 3)])],
        "doubled": [shape([box(0, 0, 1, 1)]), shape([box(0, 0, 1, 1)]), shape([box(1, 0, 2, 1)])],
        "nested": [shape([box(0, 0, 4, 4)]), shape([box(1, 1, 2, 2)])],
        "filled hole": [shape([box(0, 0, 4, 4), hole(1, 1, 3, 3)]), shape([box(1, 1, 3, 3)])],
        "island in hole": [shape([box(0, 0, 9, 9), hole(1, 1, 8, 8)]), shape([box(3, 3, 5, 5), hole(3.5, 3.5, 4.5, 4.5)])],
        "two holes": [shape([box(0, 0, 9, 9), hole(1, 1, 2, 2), hole(4, 1, 5, 2), hole(4, 5, 8, 8)])],
        "frame of four": [shape([box(0, 0, 4, 1)]), shape([box(3, 0, 4, 4)]), shape([box(0, 3, 4, 4)]), shape([box(0, 0, 1, 4)])],
        "t junction": [shape([box(0, 0, 2, 1)]), shape([box(0, 1, 1, 2)]), shape([box(1, 1, 2, 3)])],
        "far apart": [shape([box(0, 0, 1, 1)]), shape([box(1000, 1000, 1001, 1001)])],
    }
    m = frame(spark, [(k, g, True) for k, gs in cases.items() for g in gs])
    found, rejects = geometry.dissolve_with_rejects(m)
    got = {r["target_code"]: [x.asDict(recursive=True) for x in r["rings"]] for r in found.collect()}
    assert rejects.count() == 0 and set(got) == set(cases)
    for k, gs in cases.items():
        same_cover(got[k], gs)
    shells = {k: sorted((r["part"], r["ring"]) for r in g) for k, g in got.items()}
    assert shells["island in hole"] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert shells["two holes"] == [(0, 0), (0, 1), (0, 2), (0, 3)]
    assert shells["frame of four"] == [(0, 0), (0, 1)] and shells["filled hole"] == [(0, 0)]
    assert all(r["valid"] for r in found.select(wkb.repair("rings").alias("g")).select("g.valid").collect())


def test_random_shapes(spark):
    """Overlapping triangles and slanted quadrilaterals, some on shared vertices."""
    rng = random.Random(4)
    members = {}
    for k in range(12):
        gs = []
        for _ in range(rng.randint(2, 14)):
            x, y, n = rng.randint(0, 6), rng.randint(0, 6), rng.choice([3, 4, 5])
            turn, size = rng.random() * 6, rng.choice([1.0, 2.5, 0.3])
            pts = [(x + size * np.cos(turn + 2 * np.pi * i / n), y + size * np.sin(turn + 2 * np.pi * i / n)) for i in range(n)]
            gs.append(shape([ring(*pts)]))
        members[f"k{k}"] = gs
    m = frame(spark, [(k, g, True) for k, gs in members.items() for g in gs])
    found, rejects = geometry.dissolve_with_rejects(m)
    got = {r["target_code"]: [x.asDict(recursive=True) for x in r["rings"]] for r in found.collect()}
    assert rejects.count() == 0
    for k, gs in members.items():
        same_cover(got[k], gs, n=5000)


def test_border_drawn_with_other_vertices(spark):
    """Neighbours whose common border has vertices of one only, off the line by rounding."""
    third = 1 / 3
    a = shape([ring((0, 0), (1, 0.1), (1 + third, 0.1 + third / 10), (2, 0.2), (1, 2))])
    b = shape([ring((2, 0.2), (0, 0), (1, -2))])
    found, _ = geometry.dissolve_with_rejects(frame(spark, [("x", a, True), ("x", b, True)]))
    rings = found.first()["rings"]
    assert len(rings) == 1
    same_cover([r.asDict(recursive=True) for r in rings], [a, b])


def test_rejects(spark):
    schema = "target_code string, edges array<struct<x0 double, y0 double, x1 double, y1 double>>"
    square = [(0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0)]
    rows = [("good", square), ("open", square[:3]), ("flat", [(0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 0.0, 0.0)]), ("empty", [])]
    found, rejects = geometry.dissolve_with_rejects(spark.createDataFrame(rows, schema))
    assert [r["target_code"] for r in found.collect()] == ["good"]
    assert dict(rejects.collect()) == {"open": "open outline", "flat": "no area", "empty": "no area"}


def test_repair_gives_valid_rings_of_the_same_area(spark):
    wrong = {
        "bow tie": shape([ring((0, 0), (2, 2), (2, 0), (0, 2))]),
        "star": shape([ring(*[(np.sin(4 * np.pi * i / 5), np.cos(4 * np.pi * i / 5)) for i in range(5)])]),
        "overlapping parts": shape([box(0, 0, 2, 2)], [box(1, 1, 3, 3)]),
        "hole outside": shape([box(0, 0, 2, 2), hole(5, 5, 6, 6)]),
        "hole across": shape([box(0, 0, 2, 2), hole(1, 1, 3, 1.5)]),
        "spike": shape([ring((0, 0), (2, 0), (2, 2), (2, 4), (2, 2), (0, 2))]),
        "line": shape([ring((0, 0), (1, 1), (2, 2), (1, 1))]),
    }
    m = frame(spark, [(k, g, False) for k, g in wrong.items()] + [("right", shape([box(0, 0, 1, 1)]), True)])
    got = {r["target_code"]: [x.asDict(recursive=True) for x in r["rings"]] for r in geometry.repaired(m).collect()}
    assert set(got) == {*wrong, "right"} and got["line"] == []
    for k, g in wrong.items():
        if k != "line":
            same_cover(got[k], [g], parity=True)
    checked = geometry.repaired(m).filter("size(rings) > 0").select("target_code", wkb.repair("rings").alias("g")).select("target_code", "g.valid").collect()
    assert {r["target_code"] for r in checked if not r["valid"]} == set()


def test_ring_that_comes_back_to_a_point(spark):
    """A hole that touches its shell's corner is a ring of its own."""
    members = [shape([box(i, j, i + 1, j + 1)]) for i in range(3) for j in range(3) if (i, j) not in ((1, 1), (2, 2))]
    found, _ = geometry.dissolve_with_rejects(frame(spark, [("x", g, True) for g in members]))
    rings = [r.asDict(recursive=True) for r in found.first()["rings"]]
    same_cover(rings, members)
    assert sorted((r["part"], r["ring"]) for r in rings) == [(0, 0), (0, 1)]
    for r in rings:
        pts = [(p["x"], p["y"]) for p in r["pts"][:-1]]
        assert len(set(pts)) == len(pts)


def test_long_ring(spark):
    n = 3000
    pts = [(np.cos(2 * np.pi * i / n) * (1 + 0.1 * (i % 2)), np.sin(2 * np.pi * i / n) * (1 + 0.1 * (i % 2))) for i in range(n)]
    found, rejects = geometry.dissolve_with_rejects(frame(spark, [("x", shape([ring(*pts)]), True)]))
    assert len(found.first()["rings"][0]["pts"]) == n + 1 and rejects.count() == 0


def test_pieces_meet_at_ends_only(spark):
    rows = [("x", 0.0, 0.0, 4.0, 4.0), ("x", 4.0, 0.0, 0.0, 4.0), ("x", 2.0, -1.0, 2.0, 5.0), ("x", 0.0, 1.0, 5.0, 1.0), ("x", 1.0, 1.0, 3.0, 3.0)]
    cut = arrangement.pieces(spark.createDataFrame(rows, "key string, x0 double, y0 double, x1 double, y1 double"), "key").collect()
    crossings = {(2.0, 2.0), (1.0, 1.0), (3.0, 1.0), (2.0, 1.0)}
    ends = {(r["x0"], r["y0"]) for r in cut} | {(r["x1"], r["y1"]) for r in cut}
    assert crossings <= ends
    doubled = {(r["x0"], r["y0"], r["x1"], r["y1"]): r["net"] for r in cut}
    assert doubled[(1.0, 1.0, 2.0, 2.0)] == 2 and doubled[(0.0, 0.0, 1.0, 1.0)] == 1


@pytest.mark.parametrize("parity", [False, True])
def test_empty(spark, parity):
    none = spark.createDataFrame([], "key string, x0 double, y0 double, x1 double, y1 double")
    assert arrangement.outline(none, "key", parity).count() == 0


def test_thinning_puts_back_only_what_crosses(spark):
    """A narrow neck that thinning would close keeps its points, all else is thinned."""
    rng = np.random.default_rng(7)

    def wavy(a, b, n, amplitude):
        t = np.linspace(0, 1, n, endpoint=False)
        side = np.array([-(b[1] - a[1]), b[0] - a[0]]) / np.hypot(b[0] - a[0], b[1] - a[1])
        off = rng.uniform(-amplitude, amplitude, n)
        off[0] = 0
        return [(a[0] + (b[0] - a[0]) * s + side[0] * o, a[1] + (b[1] - a[1]) * s + side[1] * o) for s, o in zip(t, off)]

    # a channel whose two banks bend together, 0.01 apart, with a bend of 0.04
    low = [(2 + i * 0.1, 1 + 0.04 * np.sin(i * np.pi / 10)) for i in range(1, 20)]
    high = [(x, y + 0.01) for x, y in reversed(low)]
    pts = wavy((0, 0), (4, 0), 60, 0.01) + [(4, 0), (4, 1)] + [(x, y) for x, y in reversed(low)] + [(2, 1), (2, 1.01)] + list(reversed(high)) + [(4, 1.01), (4, 2)] + wavy((4, 2), (0, 2), 60, 0.01)[1:] + [(0, 2)]
    df = frame(spark, [("x", shape([ring(*pts)]), True)]).withColumnRenamed("target_code", "code")
    assert df.select(wkb.is_simple("rings").alias("ok")).first()["ok"]
    thin = thinning.simplify(df, 0.03, ["code"])
    out = thin.select("rings", wkb.is_simple("rings").alias("ok")).first()
    n = len(out["rings"][0]["pts"])
    assert out["ok"] and 8 < n < len(pts) - 100


def test_thinning_matches_plain_recursion(spark):
    rng = np.random.default_rng(3)
    pts = [(np.cos(a) * r, np.sin(a) * r) for a, r in zip(np.linspace(0, 2 * np.pi, 400, endpoint=False), rng.uniform(0.98, 1.02, 400))]
    closed = ring(*pts)
    xy = np.array([(p["x"], p["y"]) for p in closed])

    def far(i, j, tolerance):
        if j - i < 2:
            return []
        a, b, p = xy[i], xy[j], xy[i + 1 : j]
        v = b - a
        t = np.clip(((p - a) @ v) / (v @ v), 0, 1) if v @ v else np.zeros(len(p))
        d = np.hypot(*(p - a - t[:, None] * v).T)
        k = int(d.argmax())
        return [*far(i, i + 1 + k, tolerance), i + 1 + k, *far(i + 1 + k, j, tolerance)] if d[k] > tolerance else []

    m = int(np.hypot(*(xy - xy[0]).T).argmax())
    last = len(xy) - 1
    want = [0, *far(0, m, 0.01), m, *far(m, last, 0.01), last]
    vertices = spark.createDataFrame([("x", i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "r string, pos int, x double, y double")
    assert sorted(v["pos"] for v in thinning.kept_vertices(vertices, ["r"], 0.01).collect()) == want


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def random_ring(rng, n, whole):
    return ring(*(rng.integers(0, 9, (n, 2)) if whole else rng.uniform(0, 9, (n, 2))))


def test_repairs_of_short_rings_are_not_shuffled(spark):
    rng = np.random.default_rng(7)
    rows = [(str(k), shape([random_ring(rng, int(rng.integers(3, 9)), k % 2)], [random_ring(rng, 5, k % 3)]), False) for k in range(60)]
    found = geometry.repaired(frame(spark, rows))
    assert "Exchange" not in plan(found)
    got = {r["target_code"]: [x.asDict(recursive=True) for x in r["rings"]] for r in found.collect()}
    for k, g, _ in rows:
        if got[k]:
            same_cover(got[k], [g], parity=True, n=3000)


def areas(df):
    total = F.aggregate("rings", F.lit(0.0), lambda s, r: s + geo.twice_ring_area(r["pts"]))
    lists = df.select("target_code", F.round(total, 6).alias("area"), F.transform("rings", lambda r: F.struct(r["part"], r["ring"], F.size(r["pts"]))).alias("r"))
    return {r[0]: (r[1], [tuple(x) for x in r[2]]) for r in lists.collect()}


def test_unions_of_few_edges_like_those_of_many(spark, monkeypatch):
    """Groups taken whole and groups as rows of edges give the same rings; few jobs suffice for the first."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(40):
        for _ in range(int(rng.integers(1, 7))):
            a, b, w, h = rng.integers(0, 12, 4)
            rows.append((f"k{k}", shape([box(a, b, a + w + 1, b + h + 1)] + ([hole(a + 0.25, b + 0.25, a + 0.5, b + 0.5)] if w % 2 else [])), True))
    rows.append((None, shape([box(0, 0, 1, 1)]), True))
    m = frame(spark, rows)
    monkeypatch.setattr(arrangement, "outline", None)
    found, rejects = geometry.dissolve_with_rejects(m)
    short = areas(found)
    assert [tuple(r) for r in rejects.collect()] == [(None, "no area")]
    monkeypatch.undo()
    monkeypatch.setattr(geometry, "SMALL_EDGES", 0)
    found, rejects = geometry.dissolve_with_rejects(m)
    assert areas(found) == short and rejects.count() == 1


def test_many_parts_are_checked_in_time():
    """Nesting of many parts is checked in one pass, not part by part."""
    def parts(inner):
        return [[np.array(pts, float)] for pts in ([(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)] for x, y, w in [*((i % 70, i // 70, 0.5) for i in range(4900)), *inner])]

    start = time.process_time()
    found = wkb._decoded([parts([]), parts([(0.1, 0.1, 0.2)])], [None, None]).field("valid").to_pylist()
    assert found == [True, False] and time.process_time() - start < 20


def test_many_bow_ties_are_repaired_in_time():
    tie = np.array([(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)], float)
    start = time.process_time()
    found = wkb._decoded([[[tie + k]] for k in range(100_000)], [None] * 100_000)
    assert time.process_time() - start < 6
    assert set(found.field("valid").to_pylist()) == {False} and len(found.field("edges").flatten()) == 400_000


def test_representative_point_of_many_parts(spark):
    """Linear in the parts; parts out of order are found as well."""
    many = shape(*([box(i, 0, i + 0.5 + (i == 1234) * 0.25, 1)] for i in range(4000)))
    mixed = [{**r, "part": p} for r, p in zip(shape([box(0, 0, 1, 1)], [box(5, 0, 9, 1)], [box(2, 0, 3, 1)]), (2, 0, 1))]
    start = time.time()
    df = frame(spark, [("many", many, True), ("mixed", mixed, True), ("none", [], True), ("null", None, True)])
    points = {r[0]: r[1] for r in df.select("target_code", geometry.representative_point(F.col("rings")).alias("p")).collect()}
    assert (points["many"]["x"], points["mixed"]["x"], points["none"]) == (1234.375, 7.0, None)
    assert time.time() - start < 20
    back = df.select("target_code", F.size(geo.geojson_geometry(F.col("rings"))["coordinates"]).alias("n")).collect()
    assert {r[0]: r[1] for r in back} == {"many": 4000, "mixed": 3, "none": 0, "null": None}
