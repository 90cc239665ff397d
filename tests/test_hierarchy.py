import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import codes, geo
from tidemark.operators import admin
from tidemark.sources import dumps


def test_code_hierarchy(spark):
    df = spark.createDataFrame([("31",), ("31.74",), ("31.74.08",), ("31.74.08.1001",), ("1.2.3.4.5",)], "code string")
    h = codes.hierarchy(F.col("code"))
    rows = df.select("code", *(c.alias(n) for n, c in h.items())).collect()
    assert [r["level"] for r in rows] == ["province", "regency", "district", "village", None]
    assert tuple(rows[3])[1:] == ("village", "31", "31.74", "31.74.08", "31.74.08.1001")
    assert rows[0]["regency_code"] is None
    with pytest.raises(PySparkException):
        df.select(codes.checked_level(F.col("code"))).collect()
    with pytest.raises(ValueError):
        codes.parent_code("planet")


def test_insert_tuples_with_quotes_and_nulls(spark, tmp_path):
    text = (
        "-- head\nINSERT INTO t (code, name) VALUES ('31','Jakarta'),('31.01','Kep. Seribu');\n"
        "INSERT INTO t VALUES\n('31.01.01','Test''s (a; b), x'),\n('31.01.02', NULL);\n"
    )
    (tmp_path / "units.sql").write_text(text)
    rows = dumps.insert_tuples(dumps.read_statements(spark, str(tmp_path))).select("fields").collect()
    got = sorted([list(r["fields"]) for r in rows], key=lambda r: r[0])
    assert got == [["31", "Jakarta"], ["31.01", "Kep. Seribu"], ["31.01.01", "Test's (a; b), x"], ["31.01.02", None]]
    assert dumps.read_admin(spark, str(tmp_path)).count() == 4


def test_boundaries_from_folders(spark, tmp_path):
    for folder, code, path in (
        ("prov", "31", "[[[[1,2],[1,3],[2,3],[1,2]]]]"),
        ("kab", "31.01", "[[[1,2],[1,3],[2,3],[1,2]]]"),
        ("kab", "31.02", "[[1,2],[1,3]]"),
    ):
        d = tmp_path / "boundaries" / folder / "sub"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{code}.sql").write_text(f"INSERT INTO b VALUES ('{code}','n',1.5,2.5,'{path}'),('x','y');\n")
    got = {r["code"]: r for r in dumps.read_boundaries(spark, str(tmp_path)).collect()}
    assert set(got) == {"31", "31.01"} and got["31"]["level"] == "province"
    assert got["31"]["extent"]["xmin"] == 2.0 and got["31.01"]["centroid_lat"] == 1.5
    assert [r["code"] for r in dumps.rejected_boundaries(spark, str(tmp_path)).collect()] == ["31.02"]


def test_projection_constants(spark):
    r = spark.range(1).select(
        geo.project_x(F.lit(180.0)).alias("x"),
        (4 * geo.project_x(F.lit(180.0)) * geo.project_y(F.lit(90.0)) / 1e6).alias("globe"),
    ).first()
    assert r["x"] == pytest.approx(17367530.445, abs=1e-3)
    assert r["globe"] == pytest.approx(510065621.7, abs=0.1)


UNITS = [("11",), ("11.01",), ("11.01.01",), ("11.01.02",), ("11.01.01.1001",)]


def _units(spark):
    return admin.classify(spark.createDataFrame([(c[0], "n" + c[0]) for c in UNITS], "code string, name string"))


def test_gate_closed_at_half_district_coverage(spark):
    u = _units(spark)
    rows = [("province", "11", "raw"), ("regency", "11.01", "raw"), ("district", "11.01.01", "raw"), ("village", "11.01.01.1001", "raw")]
    b = spark.createDataFrame(rows, "level string, code string, boundary_source string")
    gate = admin.release_gate(admin.coverage(u, b)).first()
    assert (gate["district_release_ready"], gate["warning_code"]) == (False, "district_threshold_not_met")
    with pytest.raises(RuntimeError):
        admin.assert_release_ready(admin.release_gate(admin.coverage(u, b)))
    none = admin.release_gate(admin.coverage(u, b.filter("level <> 'regency'"))).first()
    assert none["warning_code"] == "missing_required_levels"
    full = b.union(spark.createDataFrame([("district", "11.01.02", "raw")], b.schema))
    assert admin.release_gate(admin.coverage(u, full)).first()["district_release_ready"]


def test_raw_rows_suppress_derivation(spark):
    present = spark.createDataFrame([("district",), ("village",)], "level string")
    got = {r["level"]: r["source_level"] for r in admin.level_sources(present).collect()}
    assert got == {"province": "district", "regency": "district", "district": "district", "village": "village"}


def test_members_stop_at_an_unknown_level_between(spark):
    u = _units(spark).filter("code <> '11.01.01'")
    raw = _units(spark).filter("level = 'village'").withColumn("edges", F.lit(1))
    _, members = admin.choose_levels(raw, u)
    assert members.count() == 0
    _, members = admin.choose_levels(raw, _units(spark))
    assert sorted(r["target_level"] for r in members.collect()) == ["district", "province", "regency"]


def test_long_keys_stay_distinct(spark):
    keys = [1, 9_999_999, 12_345_678, 123_456_789_012]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r["c"] for r in df.select(codes.padded(F.col("k"), 7).alias("c")).collect()]
    assert got == ["0000001", "9999999", "12345678", "123456789012"]


def test_statements_on_one_line_and_across_literals(spark, tmp_path):
    (tmp_path / "a.sql").write_bytes(
        b"INSERT INTO t (kode, nama) VALUES ('31','A');INSERT INTO t (kode, nama) VALUES ('32','B');\r\n"
        b"INSERT INTO t (kode, nama) VALUES\r\n('33','C''s ;\n VALUES (''x''), y'),\r\n('34','D');\r\n"
        b"insert into t values ('35', null);\n"
    )
    rows = dumps.insert_tuples(dumps.read_statements(spark, str(tmp_path))).select("fields").collect()
    got = sorted([list(r["fields"]) for r in rows])
    assert got == [["31", "A"], ["32", "B"], ["33", "C's ;\n VALUES ('x'), y"], ["34", "D"], ["35", None]]


def test_the_last_file_wins(spark, tmp_path):
    for name, value in (("a", "first"), ("b", "second"), ("c", "last")):
        filler = "".join(f"INSERT INTO t VALUES ('{name}{i}','x');\n" for i in range(50 if name == "a" else 1))
        (tmp_path / f"{name}.sql").write_text(f"{filler}INSERT INTO t VALUES ('31','{value}');\n")
    got = {r["code"]: r["name"] for r in dumps.read_units(spark, str(tmp_path)).collect()}
    assert got["31"] == "last" and len(got) == 53
