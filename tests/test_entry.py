"""Registered queries against their SQL on the smallest tables."""

import importlib.util
import math
import os
from pathlib import Path

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

spec = importlib.util.spec_from_file_location("spark_entry", Path(__file__).resolve().parents[1] / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

CHECKED = (
    "daily_facts", "daily_facts_shuffled", "daily_facts_from_wkb", "event_sample", "repaired_bow_ties",
    "dissolved_regencies", "line_monthly_facts", "window_rollup", "timeline", "map_features", "search",
    "coverage_overall", "enriched_boundaries", "featured_events", "review_states", "qualitative_summary",
    "summaries", "media_candidates", "dump_rows", "month_spine", "unit_files", "postal_files", "boundary_files",
    "footprint_files", "gap_shards", "fact_positions", "publication_positions",
    "related_positions", "level_extent", "number_display", "regency_registry", "refreshed_daily_facts",
    "outline_edges", "release_manifest", "facts_manifest", "report_files", "bundle_times", "optional_inputs",
    "footprint_manifest", "gated_builds", "derived_regencies", "replaced_table", "reference_manifest",
)


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return repr(v) if isinstance(v, float) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="tables not present")
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = entry.queries()[name](spark, DATA)
    got = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, df.collect()) == _rows(names, got.fetchall())


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
