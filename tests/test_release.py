import pytest
from pyspark.sql import functions as F

from tidemark.operators import explore, facts, release, validation
from tidemark.schemas import ADMIN_COLUMNS, METRICS, PUBLIC_LEVELS
from tidemark.sinks import writers
from tidemark.sources import assets, footprints
from tidemark.streaming import refresh

DAY = "event_date string, level string, code string, unique_event_count long, flood_days long, sum_intersection_area_km2 double, max_coverage_ratio double"


@pytest.fixture
def built(spark):
    """A minimal valid release."""
    rows = [(f"2024-0{m}-1{k}", lv, c, 1, 1, 2.0, 0.5) for m in (1, 3) for k in (0, 1) for lv, c in (("province", "11"), ("regency", "11.71"), ("district", "11.71.01"))]
    daily = spark.createDataFrame(rows, DAY)
    monthly = facts.monthly_facts(daily)
    total = facts.all_time(monthly)
    units = spark.createDataFrame(
        [("11", "Aceh", "province", "11", None, None, None), ("11.71", "Banda", "regency", "11", "11.71", None, None), ("11.71.01", "Kec", "district", "11", "11.71", "11.71.01", None)],
        ", ".join(f"{c} string" for c in ADMIN_COLUMNS),
    )
    b = units.withColumn("boundary_source", F.lit("raw"))
    overall = spark.createDataFrame([(lv, 1, 1, 1.0) for lv in (*PUBLIC_LEVELS, "village")], "level string, admin_total long, boundary_total long, coverage_ratio double")
    gate = spark.createDataFrame([(0.98, True, None)], "district_threshold double, district_release_ready boolean, warning_code string")
    months = release.metric_assets(monthly)
    manifest_in = spark.createDataFrame([("ok", 4, list(PUBLIC_LEVELS), 4)], "status string, intersecting_events long, built_levels array<string>, event_sample_size long")
    manifest = release.release_manifest(explore.available_levels(b, monthly), months, manifest_in, gate, "v", "t")
    registry = spark.createDataFrame([("11.71", "regency", "11", "aceh", "r/e", "r/s")], ", ".join(f"{c} string" for c in validation.REGISTRY_FIELDS))
    return {
        "assets": spark.createDataFrame([(n,) for n in validation.ROOT_ASSETS], "name string"),
        "manifest": manifest, "coverage": overall, "coverage_by_province": overall, "gate": gate,
        "methodology": release.methodology(spark), "methodology_texts": release.methodology_texts(spark), "search_index": explore.search_index(units), "boundaries": b,
        "metric_assets": months, "month_shards": writers.month_shards(monthly), "trend_shards": writers.trend_shards(monthly),
        "summary": total, "daily": daily, "monthly": monthly, "registry": registry,
        "events": spark.createDataFrame([("11.71", "regency", "n", "2024-01-01", "s")], ", ".join(f"{c} string" for c in validation.EVENT_FIELDS)),
        "states": spark.createDataFrame([("11.71", "regency", "not_reviewed_yet")], ", ".join(f"{c} string" for c in validation.STATE_FIELDS)),
        "files": spark.createDataFrame([("r/e",), ("r/s",)], "path string"),
    }


def _messages(a):
    return [r["message"] for r in validation.validate_release(a).collect()]


def test_valid_release_has_no_messages(built):
    assert _messages(built) == []


def test_broken_releases_are_flagged(built):
    a = dict(built)
    a["month_shards"] = a["month_shards"].filter("NOT (level = 'province' AND month = '2024-01')")
    a["files"] = a["files"].filter("path <> 'r/e'")
    a["registry"] = a["registry"].union(a["registry"])
    a["states"] = a["states"].withColumn("public_state", F.lit("odd"))
    a["assets"] = a["assets"].filter("name <> 'methodology'")
    a["summary"] = a["summary"].withColumn("unique_event_count", F.col("unique_event_count") + 1)
    got = _messages(a)
    for part in ("no shard for month 2024-01", "names a file that was not written: r/e", "repeats admin_code 11.71", "repeats slug aceh", "public_state outside its domain: odd", "not among the published files", "month and all-time facts differ"):
        assert any(part in m for m in got), part


def test_gap_months_are_in_the_spine_but_not_listed(built):
    spine = {(r["level"], r["month"]): r["observed"] for r in release.month_spine(built["monthly"]).collect()}
    assert spine[("province", "2024-02")] is False and len(spine) == 9
    assert built["metric_assets"].filter("level = 'district'").first()["months"] == ["2024-01", "2024-03"]


def test_shards_prune_and_missing_ones_are_empty(spark, built, tmp_path):
    writers.write_month_shards(built["monthly"], str(tmp_path / "m"))
    writers.write_trend_shards(built["monthly"], str(tmp_path / "t"))
    s = assets.read_month_shards(spark, str(tmp_path / "m"))
    w = explore.window_rollup(s, "district", "2024-03", "2024-03")
    row = w.first()
    assert (row["mode"], row["unique_event_count"], row["flood_days"]) == ("date_window", 2, 2)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(level" in plan and "month" in plan.split("PartitionFilters")[1][:200]
    assert explore.window_rollup(s, "district", "2024-02", "2024-02").first()["mode"] == "summary_all_time"
    t = assets.read_trend(spark, str(tmp_path / "t"), str(tmp_path / "m"))
    series = explore.trend(t, "district", "11.71.01", "2024-02", "")
    assert [r["month_start"] for r in series.collect()] == ["2024-03-01"]
    assert "shard_key" in series._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:300]
    assert assets.read_month_shards(spark, str(tmp_path / "none")).count() == 0


def test_search_orders_limits_and_skips_blanks(built, spark):
    rows = [(f"11.{i:02d}", f"Kota {i:02d}", "regency", "11", f"11.{i:02d}", None, None) for i in range(12)]
    units = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ADMIN_COLUMNS))
    got = explore.search(explore.search_index(units), [" KOTA ", "", "11.05"]).orderBy("query", "position").collect()
    assert [r["code"] for r in got if r["query"] == "kota"] == [f"11.{i:02d}" for i in range(8)]
    assert [r["code"] for r in got if r["query"] == "11.05"] == ["11.05"]
    assert explore.search(explore.search_index(units), [" "]).count() == 0


def test_documents_written_and_replaced(spark, built, tmp_path):
    path = str(tmp_path / "manifest")
    for _ in range(2):
        writers.write_document(built["manifest"].select(F.struct("*").alias("doc")), path)
    text = spark.read.text(path).collect()
    assert len(text) == 1 and '"available_levels":["province","regency","district"]' in text[0]["value"]
    writers.write_bundles(
        built["states"].withColumn("slug", F.lit("a")), spark.createDataFrame([("a",), ("b",)], "slug string"), str(tmp_path / "b")
    )
    assert spark.read.json(str(tmp_path / "b" / "slugs")).count() == 2


def test_missing_footprints_are_empty(spark, tmp_path):
    f = footprints.read_footprints(spark, str(tmp_path / "none"))
    assert f.count() == 0 and {"rings", "edges", "footprint_area_km2"} <= set(f.columns)
    m = release.missing_source_manifest(spark, "x", "t").first()
    assert m["status"] == "missing_source" and m["built_levels"] == []


def test_refresh_adds_only_new_files(spark, tmp_path):
    schema = "row_id long, start_date string, level string, code string, intersection_area_km2 double, coverage_ratio double"
    src, part, state = (str(tmp_path / n) for n in ("in", "part", "state"))

    def feed(row_id):
        spark.createDataFrame([(row_id, "2024-01-01", "district", "c", 1.5, 0.1 * row_id)], schema).write.mode("append").parquet(src)
        df = spark.read.parquet(src)
        refresh.start(spark, src, df.schema, lambda b: b, part, state).awaitTermination()

    feed(1)
    feed(2)
    row = refresh.combined(spark, part).first()
    assert (row["unique_event_count"], row["sum_intersection_area_km2"], row["flood_days"]) == (2, 3.0, 1)
    assert row["max_coverage_ratio"] == pytest.approx(0.2)
    base = str(tmp_path / "day")
    refresh.compact(spark, part, base)
    assert refresh.latest_base(spark, base) == 1
    feed(3)
    row = refresh.combined(spark, part, base).first()
    assert (row["unique_event_count"], row["sum_intersection_area_km2"], row["flood_days"]) == (3, 4.5, 1)


def test_evidence_month_rules(spark):
    m = spark.createDataFrame([("regency", "c", "2024-01", 0.5, "p1"), ("regency", "c", "2024-02", 0.5, "p2"), ("regency", "c", "2024-03", 0.1, "p3")], "level string, code string, month string, internal_score double, path string")
    sel = spark.createDataFrame([("regency", "c"), ("regency", "none")], "level string, code string")
    assert explore.pick_evidence(m, sel).first()["month"] == "2024-02"
    assert explore.pick_evidence(m, sel, "2024-03", "2024-03").first()["path"] == "p3"
    assert explore.pick_evidence(m, sel, "2025-01", "2025-01").count() == 0


def test_metric_contract_names():
    assert METRICS[0] == "unique_event_count" and len(METRICS) == 4


def test_collection_sides_are_limited_before_they_are_shuffled(spark, tmp_path):
    """No task gets a level's lines whole: the first and last ones are picked in each task."""
    import contextlib
    import io

    from tidemark.plans.catalog import release as queries

    spark.sql("SELECT 0L AS r_regionkey, 'A' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    spark.sql("SELECT 0L AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT id AS c_custkey, 'c' AS c_name, 0L AS c_nationkey, 1D AS c_acctbal FROM range(30)").write.parquet(f"{tmp_path}/customer.parquet")
    found = queries.collection_features(spark, str(tmp_path))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        found.explain()
    assert out.getvalue().count("WindowGroupLimit") == 4
    rows = {r["level"]: r for r in found.collect()}
    assert {k: (r["commas"], r["features"], r["first_without"], r["foot"]) for k, r in rows.items()} == {
        "province": (0, 1, True, "]}"), "regency": (0, 1, True, "]}"), "district": (29, 30, True, "]}"),
    }
    assert {r["head"] for r in rows.values()} == {'{"type":"FeatureCollection","features":['}
