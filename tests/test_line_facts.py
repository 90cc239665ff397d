from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import explore
from tidemark.operators import facts as fact_ops
from tidemark.plans import star
from tidemark.plans.catalog import admin, facts
from tidemark.schemas import PUBLIC_LEVELS


@pytest.fixture
def tables(spark, tmp_path):
    """Lines of two regencies; keys are missing and repeat."""
    lines = [(o, s, float(q), q / 100, datetime(2024, 1 + m, 1 + q)) for o in (1, 2, 3, 9, None) for s, m in ((1, 0), (2, 0), (2, 1), (None, 1)) for q in (1, 2)]
    made = {
        "region": ([(0, "A"), (1, "B")], "r_regionkey int, r_name string"),
        "nation": ([(0, "n0", 0), (1, "n1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c1", 0, 10.0), (2, "c2", 1, 9500.0), (2, "c2", 1, 9500.0), (None, "c", 1, 5.0)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
        "supplier": ([(1, 0, 9900.0), (2, 1, 9900.0)], "s_suppkey long, s_nationkey int, s_acctbal double"),
        "orders": ([(1, 1, "F", "p"), (2, 2, "F", "p"), (3, 2, "O", "p"), (None, 1, "F", "p"), (4, None, "F", "p")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_suppkey long, l_quantity double, l_discount double, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_facts_are_those_of_the_operators(spark, tables):
    day, month, total = facts.written(spark, tables)
    assert day.count() > 0
    assert _rows(day) == _rows(facts.daily(spark, tables))
    assert _rows(month) == _rows(facts.monthly(spark, tables))
    assert _rows(total) == _rows(facts.all_time(spark, tables))
    assert _rows(facts.written_bridge(spark, tables)) == _rows(facts.line_bridge(spark, tables))


def test_written_facts_fold_without_a_shuffle(spark, tables):
    day, month, _ = facts.written(spark, tables)
    for folded in (fact_ops.monthly_facts(day), fact_ops.all_time(month), explore.window_rollup(month, "district", "2024-01", "2024-02")):
        assert "Exchange" not in _plan(folded)


def test_public_units_are_found_before_villages_are_joined(spark, tables):
    """An order without a key has the code of its district and stays."""
    for all_of, public in (
        (admin.admin_units(spark, tables), admin.admin_units(spark, tables, public=True)),
        (star.admin_units(spark, tables), admin.admin_units(spark, tables, public=True)),
    ):
        kept = all_of.filter(F.col("level").isin(*PUBLIC_LEVELS)).select(*public.columns)
        assert _rows(kept) == _rows(public)
    b = admin.boundaries(spark, tables)
    assert _rows(b.filter("size(split(code, '[.]')) < 4")) == _rows(admin.boundaries(spark, tables, public=True))
    assert b.filter("level = 'village' AND size(split(code, '[.]')) = 3").count() == 1
