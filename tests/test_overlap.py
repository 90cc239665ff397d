"""Overlap areas: hand-computed cases, brute force, invariants. The projection is replaced
by a plain scale so that one square unit is one square kilometre."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, wkb
from tidemark.operators import facts, geometry, overlap, thinning
from tidemark.schemas import RINGS


@pytest.fixture(autouse=True)
def flat(monkeypatch):
    monkeypatch.setattr(geo, "project_x", lambda c: c * F.lit(1000.0))
    monkeypatch.setattr(geo, "project_y", lambda c: c * F.lit(1000.0))


def ring(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in [*pts, pts[0]]]


def box(a, b, c, d):
    return ring((a, b), (c, b), (c, d), (a, d))


def shape(*parts):
    """Parts as lists of rings, the first one the shell."""
    return [
        {"part": p, "ring": k, "pts": pts} for p, rings in enumerate(parts) for k, pts in enumerate(rings)
    ]


def frame(spark, shapes, key):
    rows = [(k, g) for k, g in shapes.items()]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("rings", RINGS)])
    df = spark.createDataFrame(rows, schema).withColumn("g", wkb.repair("rings"))
    return df.select(key, "g.rings", "g.edges", "g.valid", geo.bounds(F.col("g.rings")).alias("extent"))


def pairs(spark, a, b, **options):
    fp = frame(spark, a, "row_id")
    units = frame(spark, b, "code").withColumn("level", F.lit("district"))
    cell = options.pop("cell_m", 1500.0)
    fr = overlap.unit_fragments(units, cell_m=cell)
    out = overlap.overlap(fp, fr, carry=(), cell_m=cell, **options).collect()
    return {(r["row_id"], r["code"]): r["intersection_area_km2"] for r in out}


TRIANGLE = shape([ring((0, 0), (4, 0), (0, 4))])
CASES = {
    "shifted squares": (shape([box(0, 0, 2, 2)]), shape([box(1, 1, 3, 3)]), 1.0),
    "shared edge": (shape([box(0, 0, 2, 2)]), shape([box(2, 0, 4, 2)]), None),
    "hole": (shape([box(0, 0, 4, 4), box(1, 1, 3, 3)]), shape([box(0, 0, 4, 4)]), 12.0),
    "hole as unit": (shape([box(0, 0, 4, 4)]), shape([box(0, 0, 4, 4), box(1, 1, 3, 3)]), 12.0),
    "triangle corner": (TRIANGLE, shape([box(0, 0, 2, 2)]), 4.0),
    "triangle cut": (TRIANGLE, shape([box(1, 1, 3, 3)]), 2.0),
    "two parts": (shape([box(0, 0, 1, 1)], [box(2, 0, 3, 1)]), shape([box(0, 0, 3, 1)]), 2.0),
    "bow tie": (shape([ring((0, 0), (2, 2), (2, 0), (0, 2))]), shape([box(0, 0, 2, 2)]), 2.0),
}


@pytest.mark.parametrize("cell_m", [700.0, 1500.0, 40000.0])
def test_hand_computed_areas(spark, cell_m):
    for i, (name, (a, b, want)) in enumerate(CASES.items()):
        if cell_m != 1500.0 and i % 2:
            continue
        got = pairs(spark, {"a": a}, {"b": b}, cell_m=cell_m)
        assert got.get(("a", "b")) == (None if want is None else pytest.approx(want, abs=1e-9)), name


def star(rng, n, cx, cy, r):
    t = np.sort(rng.uniform(0, 2 * np.pi, n))
    d = rng.uniform(0.3, 1.0, n) * r
    return shape([ring(*zip(cx + d * np.cos(t), cy + d * np.sin(t)))])


def inside(px, py, pts):
    x = np.array([p["x"] for p in pts])
    y = np.array([p["y"] for p in pts])
    hit = np.zeros(px.shape, bool)
    for x0, y0, x1, y1 in zip(x[:-1], y[:-1], x[1:], y[1:]):
        if y0 != y1:
            hit ^= ((y0 > py) != (y1 > py)) & (px < x0 + (py - y0) * (x1 - x0) / (y1 - y0))
    return hit


def test_random_stars_match_grid_count_in_all_forms(spark):
    rng = np.random.default_rng(3)
    a = {f"a{i}": star(rng, 17, rng.uniform(-1, 1), rng.uniform(-1, 1), 2.5) for i in range(6)}
    b = {f"b{i}": star(rng, 25, rng.uniform(-2, 2), rng.uniform(-2, 2), 4.0) for i in range(4)}
    got = pairs(spark, a, b)
    shuffled = pairs(spark, a, b, broadcast_bytes=0, salt=3)
    other = pairs(spark, a, b, cell_m=433.0)
    mirrored = pairs(spark, b, a)
    g = np.arange(-6, 6, 0.02) + 0.01
    px, py = np.meshgrid(g, g)
    for ka, sa in a.items():
        for kb, sb in b.items():
            count = (inside(px, py, sa[0]["pts"]) & inside(px, py, sb[0]["pts"])).sum() * 0.02**2
            v = got.get((ka, kb), 0.0)
            assert v == pytest.approx(count, abs=0.05)
            assert shuffled.get((ka, kb), 0.0) == pytest.approx(v, abs=1e-9)
            assert other.get((ka, kb), 0.0) == pytest.approx(v, abs=1e-9)
            assert mirrored.get((kb, ka), 0.0) == pytest.approx(v, abs=1e-9)


def test_self_overlap_is_the_area_and_a_tiling_adds_up(spark):
    rng = np.random.default_rng(5)
    s = star(rng, 40, 0, 0, 3.0)
    tiles = {f"t{i}{j}": shape([box(i, j, i + 1, j + 1)]) for i in range(-4, 4) for j in range(-4, 4)}
    area = frame(spark, {"s": s}, "k").select(
        overlap.plane_area_km2(F.col("edges"), F.col("extent.ymin")).alias("a")
    ).first()["a"]
    assert pairs(spark, {"s": s}, {"s": s})[("s", "s")] == pytest.approx(area, abs=1e-9)
    assert sum(pairs(spark, {"s": s}, tiles).values()) == pytest.approx(area, abs=1e-9)


def test_only_hot_cells_are_salted(spark):
    rng = np.random.default_rng(9)
    a = {f"a{i}": star(rng, 12, 0, 0, 1.0) for i in range(40)} | {"far": star(rng, 12, 9, 9, 1.0)}
    b = {"u": star(rng, 30, 0, 0, 3.0), "v": shape([box(7, 7, 11, 11)])}
    fp = frame(spark, a, "row_id")
    hot = overlap.hot_cells(fp, cell_m=1500.0, rows_per_task=60)
    salts = {r["cell"]: r["salt"] for r in hot.collect()}
    assert salts and all(s > 1 for s in salts.values())
    plain = pairs(spark, a, b)
    spread = pairs(spark, a, b, broadcast_bytes=0, hot=hot)
    assert spread.keys() == plain.keys()
    assert all(spread[k] == pytest.approx(plain[k], abs=1e-9) for k in plain)


def test_valid_and_invalid_geometry_are_told_apart(spark):
    cases = {
        "square": (shape([box(0, 0, 4, 4)]), True, 16),
        "hole": (shape([box(0, 0, 4, 4), box(1, 1, 3, 3)]), True, 12),
        "parts": (shape([box(0, 0, 1, 1)], [box(2, 0, 3, 1)]), True, 2),
        "bow tie": (shape([ring((0, 0), (2, 2), (2, 0), (0, 2))]), False, 2),
        "overlapping parts": (shape([box(0, 0, 2, 2)], [box(1, 1, 3, 3)]), False, 6),
        "nested parts": (shape([box(0, 0, 4, 4)], [box(1, 1, 2, 2)]), False, 15),
        "figure eight": (shape([ring((0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4))]), False, 8),
        "spike": (shape([ring((0, 0), (4, 0), (2, 0), (2, 3))]), False, 3),
        "on an edge": (shape([ring((0, 0), (2, 0), (4, 0), (4, 4), (0, 4))]), True, 16),
    }
    df = frame(spark, {k: v[0] for k, v in cases.items()}, "k")
    area = overlap.plane_area_km2(F.col("edges"), F.col("extent.ymin")).alias("a")
    got = {r["k"]: (r["valid"], r["a"]) for r in df.select("k", "valid", area).collect()}
    for k, (_, valid, want) in cases.items():
        assert got[k] == (valid, pytest.approx(want)), k


def test_large_rings_take_the_exact_test(spark):
    rng = np.random.default_rng(1)
    big = star(rng, 200, 0, 0, 3.0)
    crossed = [dict(big[0], pts=[big[0]["pts"][0], *big[0]["pts"][100:0:-1], *big[0]["pts"][101:]])]
    df = frame(spark, {"ok": big, "bad": crossed}, "k")
    assert {r["k"]: r["valid"] for r in df.collect()} == {"ok": True, "bad": False}


def test_interior_cells_hold_one_fragment(spark):
    units = frame(spark, {"u": shape([box(0, 0, 10, 10)])}, "code").withColumn("level", F.lit("district"))
    per_cell = overlap.unit_fragments(units, cell_m=1000.0).groupBy("cell").count()
    assert per_cell.agg(F.max("count")).first()[0] == 1


def test_broadcast_plan_moves_no_footprints_before_the_sum(spark):
    fp = frame(spark, {"a": CASES["hole"][0]}, "row_id")
    units = frame(spark, {"b": CASES["hole"][1]}, "code").withColumn("level", F.lit("district"))
    fr = spark.createDataFrame(overlap.unit_fragments(units).collect(), overlap.unit_fragments(units).schema)
    plan = overlap.overlap(fp, fr, carry=())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_duplicate_uuids_count_as_pairs(spark):
    b = spark.createDataFrame(
        [(1, "u", "2024-01-05", "village", "1", 1.0, 0.5), (2, "u", "2024-01-05", "village", "1", 2.0, 0.25)],
        "row_id long, uuid string, start_date string, level string, code string, intersection_area_km2 double, coverage_ratio double",
    )
    day = facts.daily_facts(b).first()
    assert (day["unique_event_count"], day["sum_intersection_area_km2"], day["max_coverage_ratio"]) == (2, 3.0, 0.5)
    postal = spark.createDataFrame([("1", "40111")], "village_code string, postal_code string")
    v = facts.village_day(b.withColumnRenamed("coverage_ratio", "coverage_ratio_of_unit"), postal).first()
    assert (v["event_count"], v["unique_event_count"], v["postal_code"]) == (2, 1, "40111")


def test_dissolve_keeps_holes_and_touching_parts(spark):
    members = {f"{i}{j}": shape([box(i, j, i + 1, j + 1)]) for i in range(3) for j in range(3) if (i, j) != (1, 1)}
    members["far"] = shape([box(3, 3, 4, 4)])
    m = frame(spark, members, "code").withColumn("target_code", F.lit("x"))
    out = geometry.dissolve(m).first()["rings"]
    assert sorted((r["part"], r["ring"]) for r in out) == [(0, 0), (1, 0), (1, 1)]
    df = frame(spark, {"x": [r.asDict(recursive=True) for r in out]}, "k")
    row = df.select("valid", overlap.plane_area_km2(F.col("edges"), F.col("extent.ymin")).alias("a")).first()
    assert row["a"] == pytest.approx(9.0)


def test_representative_point_of_a_ring_with_a_hole_is_inside(spark):
    g = shape([box(0, 0, 10, 10), box(1, 1, 8, 9)])
    p = geometry.with_centroids(frame(spark, {"x": g}, "k")).first()
    assert (p["centroid_lng"], p["centroid_lat"]) == (9.0, 5.0)


def test_simplify_respects_tolerance_and_minimum(spark):
    wavy = ring((0, 0), (1, 0.0001), (2, 0), (2, 2), (1, 2.5), (0, 2))
    df = frame(spark, {"x": shape([wavy])}, "k")
    n = [len(thinning.simplify(df, t, ["k"]).first()["rings"][0]["pts"]) for t in (0.001, 0.0, 100.0)]
    assert n[:2] == [6, 7] and n[2] >= 4


def test_wkb_of_both_byte_orders_and_types(spark):
    import struct

    pts = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)]
    big = struct.pack(">BIII", 0, 3, 1, 5) + b"".join(struct.pack(">dd", *p) for p in pts)
    little = struct.pack("<BII", 1, 6, 1) + struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in pts)
    point = struct.pack("<BIdd", 1, 1, 0.0, 0.0)
    df = spark.createDataFrame([("b", big), ("l", little), ("p", point)], "k string, w binary")
    got = {r["k"]: r for r in df.select("k", wkb.decode_wkb("w").alias("g")).select("k", "g.*").collect()}
    assert got["b"]["rings"] == got["l"]["rings"] and got["p"]["rings"] == []
    assert got["b"]["rings"][0]["pts"][1]["x"] == 1.0  # clockwise input turned


def test_dense_cell_is_divided(spark):
    """Thousands of units inside one cell: no part holds more than its share, nothing changes."""
    units = {f"u{i:05d}": shape([box(i % 100 * 0.01, i // 100 * 0.01, i % 100 * 0.01 + 0.01, i // 100 * 0.01 + 0.01)]) for i in range(10_000)}
    prints = {f"f{i}": shape([box(0.1 * i + 0.005, 0.105, 0.1 * i + 0.045, 0.145)]) for i in range(8)}
    fp = frame(spark, prints, "row_id")
    fragments = overlap.unit_fragments(frame(spark, units, "code").withColumn("level", F.lit("district")), cell_m=1500.0)
    dense = overlap.dense_cells(fragments, 500).collect()
    assert len(dense) == 1 and dense[0]["parts"] >= 20
    base = overlap.overlap(fp, fragments, carry=(), cell_m=1500.0).collect()
    cut = overlap.overlap(fp, fragments, carry=(), cell_m=1500.0, broadcast_bytes=0, salt=2, unit_rows=500)
    found = {(r["row_id"], r["code"]): r["intersection_area_km2"] for r in cut.collect()}
    assert found == pytest.approx({(r["row_id"], r["code"]): r["intersection_area_km2"] for r in base}) and len(found) == 8 * 25
    assert "ShuffledHashJoin" not in cut._jdf.queryExecution().toString()
    part = F.pmod(F.xxhash64("level", "code", "l", "hl"), F.lit(dense[0]["parts"]))
    assert fragments.groupBy(part.alias("p")).count().agg(F.max("count").alias("n")).first()["n"] < 1000


def test_cells_shrink_with_the_units(spark):
    """A cell holds as many units however small they are, and areas don't depend on it."""
    held = []
    for n in (12, 48):
        side = 4.0 / n
        tiles = spark.range(n * n).select(
            F.lit("district").alias("level"), F.col("id").cast("string").alias("code"),
            (F.col("id") % n * side + 100).alias("xmin"), (F.floor(F.col("id") / n) * side).alias("ymin"),
        )
        a, b = F.col("xmin"), F.col("ymin")
        rings = geo.box(a, b, a + side, b + side)
        units = tiles.select("level", "code", rings.alias("rings"), geo.ring_edges(rings).alias("edges"), geo.bounds(rings).alias("extent"))
        fragments = overlap.unit_fragments(units)
        per_cell = fragments.groupBy("cell").agg(F.countDistinct("code").alias("n")).agg(F.max("n")).first()[0]
        held.append(per_cell)
        own = units.limit(40).withColumn("row_id", F.col("code").cast("long"))
        areas = {r["row_id"]: r["intersection_area_km2"] for r in overlap.overlap(own, fragments, carry=()).collect() if str(r["row_id"]) == r["code"]}
        small = overlap.overlap(own, fragments, carry=(), broadcast_bytes=0).collect()
        fixed = overlap.overlap(own, overlap.unit_fragments(units, cell_m=20_000.0), carry=(), cell_m=20_000.0).collect()
        for found in (small, fixed):
            again = {r["row_id"]: r["intersection_area_km2"] for r in found if str(r["row_id"]) == r["code"]}
            assert again.keys() == areas.keys() and all(abs(again[k] - areas[k]) < 1e-6 for k in areas)
    assert held[1] <= held[0] + 2
