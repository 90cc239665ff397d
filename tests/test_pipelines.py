"""All stages on a two-village fixture, and the checks on what they publish."""

import struct

import pytest

from tidemark.operators import validation
from tidemark.plans import pipelines
from tidemark.schemas import FOOTPRINT, REPORT_COLUMNS

STAMP = "2024-01-01T00:00:00+00:00"


def _wkb(a, b, c, d):
    pts = [(a, b), (c, b), (c, d), (a, d), (a, b)]
    return bytearray(struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in pts))


def _path(a, b, c, d):
    return f"[[[[{b},{a}],[{b},{c}],[{d},{c}],[{d},{a}],[{b},{a}]]]]"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    (root / "admin").mkdir()
    (root / "admin" / "units.sql").write_text(
        "INSERT INTO u VALUES ('11','Aceh'),('11.71','Banda'),('11.71.01','Old'),('11.71.01.1001','A'),('11.71.01.1002','B'),"
        "('11.71.01','Kec');\n"
    )
    (root / "postal").mkdir()
    (root / "postal" / "p.sql").write_text("INSERT INTO p VALUES ('11.71.01.1001',23111),('11.71.01.1001',23112);\n")
    d = root / "boundaries" / "kel"
    d.mkdir(parents=True)
    (d / "v.sql").write_text(
        f"INSERT INTO b VALUES ('11.71.01.1001','x',0.5,100.5,'{_path(100, 0, 101, 1)}'),"
        f"('11.71.01.1002','x',0.5,101.5,'{_path(101, 0, 102, 1)}'),('99.99.99.9999','x',1,1,'{_path(101, 0, 102, 1)}');\n"
    )
    rows = [
        ("u1", None, _wkb(100.5, 0.2, 101.5, 0.4), "2024-01-05", None),
        ("u2", 3.0, _wkb(100.1, 0.1, 100.2, 0.2), "2024-03-05", "2024-03-06"),
        ("far", 1.0, _wkb(10.0, 10.0, 11.0, 11.0), "2024-03-05", None),
        (None, 1.0, _wkb(100.1, 0.1, 100.2, 0.2), "2024-03-05", None),
    ]
    spark.createDataFrame(rows, FOOTPRINT).coalesce(1).write.parquet(str(root / "footprints"))
    (root / "reviewed").mkdir()
    values = dict(event_id="e1", event_date="2024-01-15", admin_level="regency", admin_code="11.71", source_name="s", review_status="reviewed", match_confidence="publishable", published="1", summary_id="teks")
    for name, lines in (("aceh__banda", [",".join(values.get(c, "") for c in REPORT_COLUMNS)]), ("aceh__none", [])):
        (root / "reviewed" / f"{name}_inputs.reviewed.csv").write_text("\n".join([",".join(REPORT_COLUMNS), *lines]) + "\n")
    return root


def test_stages_end_to_end(spark, raw, tmp_path):
    ref, built, rep, out = (str(tmp_path / n) for n in ("ref", "built", "rep", "out"))
    pipelines.build_reference(spark, f"{raw}/admin", f"{raw}/postal", str(raw), ref, STAMP)
    b = {r["code"]: r for r in spark.read.parquet(f"{ref}/boundary_shapes").collect()}
    assert set(b) == {"11", "11.71", "11.71.01", "11.71.01.1001", "11.71.01.1002"}
    assert (b["11"]["boundary_source"], b["11.71.01"]["name"], b["11.71.01"]["level"]) == ("derived", "Kec", "district")
    assert b["11.71.01.1001"]["postal_code"] == "23112" and b["11.71.01"]["postal_code"] is None
    assert len(b["11"]["edges"]) == 6 and 100 < b["11"]["centroid_lng"] < 102
    # The duplicate admin row counts twice in the totals, so one boundary covers half of them.
    gate = spark.read.parquet(f"{ref}/coverage/gate").first()
    assert gate["warning_code"] == "district_threshold_not_met"
    with pytest.raises(RuntimeError):
        pipelines.build_facts(spark, f"{raw}/footprints", ref, built, STAMP)


def test_release_of_a_complete_reference(spark, raw, tmp_path):
    ref, built, rep, out = (str(tmp_path / n) for n in ("ref", "built", "rep", "out"))
    clean = tmp_path / "admin"
    clean.mkdir()
    (clean / "u.sql").write_text((raw / "admin" / "units.sql").read_text().replace("('11.71.01','Old'),", ""))
    pipelines.build_reference(spark, str(clean), f"{raw}/postal", str(raw), ref, STAMP)
    pipelines.build_facts(spark, f"{raw}/footprints", ref, built, STAMP, include_village=True)
    day = {(r["level"], r["code"], r["event_date"]): r for r in spark.read.parquet(f"{built}/fact_day").collect()}
    assert day[("province", "11", "2024-01-05")]["unique_event_count"] == 1
    halves = [day[("village", f"11.71.01.100{i}", "2024-01-05")]["sum_intersection_area_km2"] for i in (1, 2)]
    whole = day[("district", "11.71.01", "2024-01-05")]["sum_intersection_area_km2"]
    assert halves[0] == pytest.approx(halves[1]) and sum(halves) == pytest.approx(whole)
    m = spark.read.parquet(f"{built}/facts_manifest_table").first()
    assert (m["status"], m["source_rows"], m["intersecting_events"], m["event_sample_size"]) == ("ok", 4, 2, 2)
    assert m["built_levels"] == ["province", "regency", "district", "village"] and m["warnings"] == []
    postal = spark.read.parquet(f"{built}/fact_postal_day").orderBy("event_date").collect()
    assert [(r["postal_code"], r["unique_event_count"]) for r in postal] == [("23112", 1), ("23112", 1)]

    pipelines.build_facts(spark, f"{raw}/footprints", ref, built, STAMP)
    pipelines.build_reports(spark, f"{raw}/reviewed", rep, STAMP)
    a = pipelines.package_release(spark, ref, built, rep, out, "v1", STAMP)
    assert [tuple(r) for r in validation.validate_release(a).collect()] == []
    assert [r["slug"] for r in a["registry"].collect()] == ["aceh__banda"]
    assert spark.read.text(f"{out}/boundaries").count() == 3


def test_absent_footprints_leave_a_status(spark, tmp_path):
    pipelines.build_facts(spark, str(tmp_path / "none"), str(tmp_path), str(tmp_path / "b"), STAMP)
    assert "missing_source" in spark.read.text(str(tmp_path / "b" / "facts_manifest")).first()["value"]
