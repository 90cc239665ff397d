"""Ledger of folded files, pruning of batches, collection documents, forms of WKB."""

import json
import struct
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.functions import geo, wkb
from tidemark.sinks import writers
from tidemark.streaming import refresh


def rows_of(spark, files):
    schema = f"a long, b string, c string, {refresh.FILE} string"
    return spark.createDataFrame([(*r, f) for f, rs in files.items() for r in rs], schema)


def test_ledger_knows_files_by_their_rows(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    one, two = [(1, "x", None), (2, None, "y"), (2, None, "y")], [(1, "x", None), (2, "y", None), (2, "y", None)]
    first = refresh.unseen(rows_of(spark, {"f1": one, "f2": two, "copy of f1": list(reversed(one))}), 0, ledger)
    assert {r[refresh.FILE] for r in first.collect()} == {"copy of f1", "f2"} and first.count() == 6
    later = rows_of(spark, {"f3": one, "f4": two[:2], "f5": [*two, (3, "z", "z")]})
    assert {r[refresh.FILE] for r in refresh.unseen(later, 1, ledger).collect()} == {"f4", "f5"}
    # run again, a batch decides alike
    assert {r[refresh.FILE] for r in refresh.unseen(later, 1, ledger).collect()} == {"f4", "f5"}
    assert refresh.unseen(later, 2, ledger).count() == 0


def test_prune_keeps_what_is_read(spark, tmp_path):
    partials, base = str(tmp_path / "partials"), str(tmp_path / "base")

    def batch(n):
        day = spark.createDataFrame([("2024-01-01", "district", f"c{n}", 1, 1, 2.0, 0.5)], "event_date string, level string, code string, unique_event_count long, flood_days long, sum_intersection_area_km2 double, max_coverage_ratio double")
        day.write.parquet(f"{partials}/batch={n}")

    for n in (0, 1):
        batch(n)
        refresh.compact(spark, partials, base)
    batch(2)
    before = sorted(map(tuple, refresh.combined(spark, partials, base).collect()))
    gone = refresh.prune(spark, partials, base)
    assert {Path(g).name for g in gone} == {"upto=0", "batch=0", "batch=1"}
    assert sorted(map(tuple, refresh.combined(spark, partials, base).collect())) == before and len(before) == 3
    assert refresh.prune(spark, partials, str(tmp_path / "none")) == []


def test_collection_files_make_a_document(spark, tmp_path):
    box = geo.box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    df = spark.range(500).select(
        F.when(F.col("id") < 3, "province").otherwise("district").alias("level"), F.lpad((F.col("id") % 400).cast("string"), 4, "0").alias("code"), box.alias("rings")
    )
    path = tmp_path / "out"
    writers.write_feature_collections(df.repartition(7), str(path))
    for level, n in (("province", 3), ("district", 497)):
        text = "".join(p.read_text() for p in sorted((path / f"level={level}").glob("part-*")))
        found = json.loads(text)
        codes = [f["properties"]["code"] for f in found["features"]]
        assert found["type"] == "FeatureCollection" and len(codes) == n and codes == sorted(codes)


def test_forms_of_wkb(spark):
    def polygon(order, code, extra, system=b""):
        pts = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
        body = b"".join(struct.pack(f"{order}{2 + extra}d", *p, *[9.0] * extra) for p in pts)
        return struct.pack(order + "BI", order == "<", code) + system + struct.pack(order + "II", 1, 5) + body

    plain = polygon("<", 3, 0)
    line = struct.pack("<BII", 1, 2, 2) + struct.pack("<4d", 0, 0, 1, 1)
    forms = {
        "z": polygon("<", 1003, 1),
        "zm": polygon(">", 3003, 2),
        "flags": polygon("<", 0xE0000003, 2, struct.pack("<I", 4326)),
        "many z": struct.pack("<BII", 1, 1006, 1) + polygon("<", 1003, 1),
        "collection": struct.pack("<BII", 1, 7, 2) + line + plain,
        "nested": struct.pack("<BII", 1, 7, 1) + struct.pack("<BII", 1, 7, 1) + plain,
        "line": line,
        "lines": struct.pack("<BII", 1, 5, 1) + line,
        "curve": struct.pack("<BII", 1, 10, 0),
        "cut": plain[:50],
        "short": b"\x01\x03",
        "none": struct.pack("<BII", 1, 3, 0),
    }
    df = spark.createDataFrame(list(forms.items()), "k string, w binary")
    got = {r["k"]: r for r in df.select("k", wkb.decode_wkb("w").alias("g")).select("k", "g.*").collect()}
    for k in ("z", "zm", "flags", "many z", "collection", "nested"):
        assert got[k]["reason"] is None and got[k]["valid"]
        assert [(p["x"], p["y"]) for p in got[k]["rings"][0]["pts"]] == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    reasons = {k: got[k]["reason"] for k in forms if got[k]["reason"]}
    assert reasons == {"line": "line string", "lines": "multi line string", "curve": "type 10", "cut": "broken", "short": "broken", "none": "empty"}
