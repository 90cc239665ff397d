import csv
import io
import json
import random

from pyspark.sql import functions as F

from tidemark.functions import media, text
from tidemark.operators import qualitative as q
from tidemark.operators.ranking import staged_rank
from tidemark.schemas import EVENT, REPORT_COLUMNS, STATE
from tidemark.sources import assets
from tidemark.sources.reports import read_reports, report_slugs

HEADER = ",".join(c for c in REPORT_COLUMNS if not c.startswith("time_window"))


def _line(**values):
    return ",".join(str(values.get(c, "")) for c in HEADER.split(","))


BASE = dict(
    event_date="2024-01-15", admin_level="regency", admin_code="11.71", review_status="reviewed",
    match_confidence="publishable", published="yes", canonical_event_group="ceg-1", headline="h",
)


def test_reviewed_files_to_events_and_states(spark, tmp_path):
    rows = [
        _line(**BASE, event_id="b", source_date="2024-01-17"),
        _line(**BASE, event_id="a", source_date="2024-01-16"),
        _line(**{**BASE, "is_supporting_evidence": "1"}, event_id="c", source_date="2024-01-01"),
        _line(**{**BASE, "admin_code": "11.72", "review_status": "Reviewed", "match_confidence": "low"}, event_id="d") + ",2024-02,2024-03-31",
    ]
    (tmp_path / "aceh__x_inputs.reviewed.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    (tmp_path / "empty_inputs.reviewed.csv").write_text(HEADER + "\n")
    raw = read_reports(spark, str(tmp_path))
    reports = q.normalize_reports(raw)
    ranked = q.rank_reports(reports)
    e = q.build_events(ranked)
    row = e.first()
    assert e.count() == 1 and (row["event_id"], row["supporting_count"], row["slug"]) == ("a", 2, "aceh__x")
    assert row["period_start"] == "2024-01-01"
    order = [r["event_id"] for r in q.supporting_records(ranked).orderBy("position").collect()]
    assert order == ["b", "c"]
    st = {r["admin_code"]: r for r in q.build_states(reports, e, "now").collect()}
    assert st["11.71"]["public_state"] == "has_featured_report_and_more"
    assert st["11.71"]["supporting_event_count"] == 2
    assert (st["11.72"]["public_state"], st["11.72"]["period_end"]) == ("reviewed_but_no_publishable_report", "2024-03-31")
    assert {r["slug"] for r in report_slugs(spark, str(tmp_path)).collect()} == {"aceh__x", "empty"}


def test_fix_ups_run_in_order(spark):
    row = dict.fromkeys(REPORT_COLUMNS, "") | {
        "event_id": "e1", "event_date": "2024-03", "admin_code": "12.01", "claim_type": "dup-9", "source_family_id": "fam",
        "headline": "News", "impact_tags": "", "canonical_event_group": "road|house", "evidence_scope": "Y",
        "review_status": "manual_match", "duplicate_group": "reviewed", "match_confidence": "Publishable ",
    }
    df = spark.createDataFrame([("s", 1, *(row[c] for c in REPORT_COLUMNS))], ["slug", "source_row", *REPORT_COLUMNS])
    r = q.normalize_reports(df).first()
    assert (r["claim_type"], r["impact_tags"], r["published"], r["review_status"]) == ("fam", "road|house", "true", "reviewed")
    assert r["canonical_event_group"] == "ceg-12-01-2024-03-e1" and r["source_date"] == "2024-03-01"
    assert r["headline"] == "News"


def test_rank_splits_a_crowded_group(spark):
    df = spark.range(3000).select(
        F.lit("hot").alias("g"), (F.col("id") % 7).cast("string").alias("d"), F.col("id")
    )
    out = staged_rank(df, ["g"], [F.col("d")], [F.col("id").desc()], descending=[True]).collect()
    want = sorted(((str(i % 7), i) for i in range(3000)), reverse=True)
    got = [(r["d"], r["id"]) for r in sorted(out, key=lambda r: r["position"])]
    assert got == want and [r["position"] for r in sorted(out, key=lambda r: r["position"])] == list(range(1, 3001))


def test_supporting_pages_keep_every_record(spark):
    rows = [("s", i, *(dict(BASE, event_id=f"e{i:04d}", source_date="2024-01-16").get(c, "") for c in REPORT_COLUMNS)) for i in range(25)]
    ranked = q.rank_reports(q.normalize_reports(spark.createDataFrame(rows, ["slug", "source_row", *REPORT_COLUMNS])))
    pages = q.nest_supporting(q.build_events(ranked), q.supporting_records(ranked), page_size=10)
    got = {r["page"]: [x["event_id"] for x in r["supporting_records"]] for r in pages.collect()}
    assert [len(got[p]) for p in sorted(got)] == [10, 10, 4]
    assert sum((got[p] for p in sorted(got)), []) == [f"e{i:04d}" for i in range(1, 25)]


def test_bundle_replaces_global_rows(spark):
    e = spark.createDataFrame([("11.71", "regency", "g1"), ("11.72", "regency", "g2"), ("11.71", "province", "g3")], "admin_code string, admin_level string, event_id string")
    b = spark.createDataFrame([("11.71", "11.71", "regency", "b1"), ("11.71", "99", "regency", "other")], "bundle_code string, admin_code string, admin_level string, event_id string")
    sel = spark.createDataFrame([("regency", "11.71"), ("regency", "11.72"), ("regency", "11.73"), ("province", "11.71")], "level string, code string")
    codes = spark.createDataFrame([("11.71",), ("11.73",)], "code string")
    got = {(r["level"], r["code"], r["event_id"]) for r in q.effective_rows(sel, e, b, codes).collect()}
    assert got == {("regency", "11.71", "b1"), ("regency", "11.72", "g2"), ("province", "11.71", "g3")}


def test_documents_in_both_forms(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"admin_code": "1", "public_state": "x"}, 5]))
    (tmp_path / "b.json").write_text(json.dumps({"states": [{"admin_code": "2"}]}))
    (tmp_path / "c.json").write_text(json.dumps({"other": 1}))
    rows = assets.read_documents(spark, str(tmp_path), "states", STATE).select("file_name", "admin_code").collect()
    assert sorted(map(tuple, rows)) == [("a.json", "1"), ("b.json", "2")]


def test_optional_inputs_fall_back_alone(spark, tmp_path):
    (tmp_path / "geography_review_states").mkdir()
    (tmp_path / "geography_review_states" / "p.json").write_text('{"admin_code":"11"}\n')
    got = assets.read_qualitative(spark, str(tmp_path))
    assert (got["events"].count(), got["states"].count(), got["index"].count()) == (0, 1, 0)
    assert assets.first_existing(spark, [str(tmp_path / "no"), str(tmp_path / "geography_review_states")], STATE).count() == 1
    raw = spark.createDataFrame([], EVENT)
    assert q.fill_events(raw).columns[-1] == "supporting_records" and q.fill_states(got["states"]).first()["admin_level"] == ""


def _one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first()["r"]


def test_video_forms(spark):
    e = media.EMBED_PREFIX
    for raw, want in {
        "https://youtu.be/abc123?t=1": "abc123",
        "<https://www.youtube.com/watch?a=1&v=abc123>": "abc123",
        "[x](https://m.youtube.com/watch?v=abc123)": "abc123",
        "youtube.com/live/abc123": "abc123",
        "//youtube-nocookie.com/embed/abc123/x": "abc123",
        "https://other.org/r?u=youtu.be/abc1234": "abc1234",
        "https://www.youtube.com/@channel": "",
        "https://site.org/a": "",
    }.items():
        assert _one(spark, raw, media.video_embed_url) == (e + want if want else ""), raw


def test_public_urls(spark):
    for raw, want in {
        "HTTP://WWW.Site.ORG": "http://www.site.org/",
        "//a.b/c?d#e": "https://a.b/c?d#e",
        "youtu.be/x": "https://youtu.be/x",
        "ftp://a.b/c": "",
        "site.org/x": "",
        "https://sub.example.org/x": "",
        "http://localhost:80/": "",
        "https://box.local": "",
        "https://a.b:443/x y": "https://a.b/x%20y",
        "": "",
    }.items():
        assert _one(spark, raw, media.public_url) == want, raw


def test_text_rules(spark):
    assert _one(spark, " a | b,,c ; ", text.normalize_tags) == ["a", "b", "c"]
    assert _one(spark, " YES ", text.parse_bool) and not _one(spark, None, text.parse_bool)
    long = "word " * 30
    assert _one(spark, long, text.headline_from_summary) == long[:89].rstrip() + "..."
    assert _one(spark, "One. Two", text.headline_from_summary) == "One."
    assert _one(spark, "Flood update: during march", lambda c: text.consistent_language(c, "id")) is False
    assert _one(spark, "Banjir besar", lambda c: text.consistent_language(c, "id")) is True
    match = lambda c: text.summary_matches_headline(c, F.lit("a big flood..."))
    assert _one(spark, "A big, flood hits town", match) is True


def test_missing_columns_get_their_defaults(spark, tmp_path):
    from tidemark.sources import reports

    (tmp_path / "kota_inputs.reviewed.csv").write_text('"event_id","admin_code","odd, name"\n"e1","11.01","x"\n')
    r = reports.read_reports(spark, str(tmp_path)).first()
    assert (r["slug"], r["event_id"], r["admin_code"], r["admin_level"]) == ("kota", "e1", "11.01", "regency")


def test_latest_row_names_a_bundle(spark):
    rows = spark.createDataFrame(
        [("s", 1, "11.01"), ("s", 2, "11.02"), ("s", 3, "")], "slug string, position int, admin_code string"
    )
    assert q.first_values(rows, {"admin_code": ("admin_code",)}).first()["admin_code"] == "11.02"


def test_numbers_round_away_from_zero(spark):
    from tidemark.functions import metrics

    for value, want in ((0.125, "0.13"), (-0.125, "-0.13"), (0.375, "0.38"), (1234.5, "1,234.5"), (0.001, "0")):
        assert _one(spark, str(value), lambda c: metrics.display_number(c.cast("double"))) == want


def test_records_over_splits_equal_the_csv_module(spark, tmp_path):
    """Quoted line ends, commas and quotes, quotes inside bare values, line ends of both kinds and
    files cut into splits of a few bytes; rows come in the order of the file."""
    rng = random.Random(8)
    pieces = ["a", "b c", ",", "\n", '"', '""', '",', ',"', '\n"', "é", "x" * 40, "\n\n"]
    names = ["event_id", "headline", "summary_en", "claim_type", "source_name"]
    want = {}
    for slug, end in (("one", "\n"), ("two", "\r\n"), ("three", "\n")):
        mine = rng.sample(names[1:], 4)[: rng.randint(2, 4)]
        text = io.StringIO()
        writer = csv.writer(text, lineterminator=end, quoting=rng.choice((csv.QUOTE_MINIMAL, csv.QUOTE_ALL)))
        writer.writerow(["event_id", *mine])
        for i in range(60):
            writer.writerow([f"e{i}", *("".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in mine)])
            if i % 9 == 0:
                text.write(f'e{i}b,5" pipe' + end + end)
        (tmp_path / f"{slug}_inputs.reviewed.csv").write_text(text.getvalue(), newline="")
        found = csv.reader(io.StringIO(text.getvalue(), newline=""))
        head, *rows = [r for r in found if r]
        want[slug] = [tuple(dict(zip(head, r)).get(n) or "" for n in names) for r in rows]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    try:
        raw = read_reports(spark, str(tmp_path))
        rows = raw.select("slug", "source_row", *names).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for slug, lines in want.items():
        own = sorted((r for r in rows if r["slug"] == slug), key=lambda r: r["source_row"])
        assert len({r["source_row"] for r in own}) == len(own)
        assert [tuple(r[n] or "" for n in names) for r in own] == lines


def test_long_texts_are_compared_once(spark):
    """A headline needs a text's start only, a summary's comparison its comparable form once."""
    from pyspark.sql import functions as F

    from tidemark.functions import text

    assert str(text.show_summary(F.col("whole"), F.col("h"), F.col("l"))).count("whole") == 2
    assert str(text.headline_from_summary(F.col("whole"))).count("substring(whole") == 1
    words = "word " * 600
    rows = [
        ("First one. " + words, "First one."), (words, words[:89].strip() + "..."), ("a" + " " * 1500 + "b. c", "a b."),
        (None, ""), ("One. " + words + "\u0085 x", ("One. " + words)[:89].strip() + "..."), ("Short", "Short"),
    ]
    df = spark.createDataFrame(rows, "t string, want string").withColumn("got", text.headline_from_summary(F.col("t")))
    assert [(r["want"], r["got"]) for r in df.collect() if r["want"] != r["got"]] == []


def test_optional_inputs_count_records_of_all_pages(spark, tmp_path):
    """A group of more records than a page holds, beside one of a page and an event alone."""
    from tidemark.plans.catalog.reports import optional_inputs

    sizes = {"crowded": 2300, "full": 1001, "alone": 1}
    docs = [(s, n) for s, k in sizes.items() for n in range(k)]
    d = str(tmp_path)
    spark.createDataFrame(
        [(i, "t", "en", s, 5) for i, (s, _) in enumerate(docs)], "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(len(docs))], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, "n", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{d}/nation.parquet")
    got = {r["canonical_event_group"]: r["records"] for r in optional_inputs(spark, d).collect()}
    assert got == {f"ceg-{s}": k - 1 for s, k in sizes.items()}


def test_pages_of_a_release_are_counted_once(spark, tmp_path):
    """Rows that repeat an event, slugs with the same event, and a row of a release without pages."""
    def page(slug, number, size):
        return {"slug": slug, "event_id": "e", "page": number, "supporting_records": [{"event_id": f"{number}-{i}"} for i in range(size)]}

    rows = [page("a", 0, 3), page("a", 0, 3), page("a", 1, 3), page("a", 1, 3), page("a", 2, 3), page("a", 2, 3)]
    rows += [page("b", 0, 3), page("b", 1, 1), page(None, 0, 2), page(None, 1, 2), {"event_id": "old", "slug": "a"}]
    (tmp_path / "qualitative_events").mkdir()
    (tmp_path / "qualitative_events" / "p.json").write_text("\n".join(json.dumps(r) for r in rows))
    out = q.whole_events(q.fill_events(assets.read_qualitative(spark, str(tmp_path))["events"]))
    got = sorted((r["slug"], r["event_id"], r["records"]) for r in out.collect())
    assert got == [("", "e", 4), ("a", "e", 9), ("a", "e", 9), ("a", "old", 0), ("b", "e", 4)]
