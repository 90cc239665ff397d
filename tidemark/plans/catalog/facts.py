"""Exact fact rollups over line items read as footprint x unit pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codes import prefix
from tidemark.functions.dates import month_start
from tidemark.operators import facts
from tidemark.plans import star
from tidemark.plans.catalog import sql


def located_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with their supplier's regency and their customer's district. Orders, fewer and
    narrower than lines, get their customer's regency first, so that lines move once, without text."""
    li = star.table(spark, d, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_quantity", "l_discount", F.col("l_shipdate").cast("date").alias("day")
    )
    sup = star.table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    reg = star.regencies(spark, d).select("n_nationkey", F.col("code").alias("regency"))
    orders = star.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    dis = star.customer_regencies(spark, d).select("c_custkey", "_r")
    homes = orders.join(dis, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey", "_r")
    return (
        li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(homes, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(reg, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "day",
            F.col("l_quantity").alias("intersection_area_km2"),
            F.col("l_discount").alias("coverage_ratio"),
            "regency",
            star.district_code(F.col("_r"), F.col("c_custkey")).alias("district"),
        )
    )


def _bridge(lines: DataFrame, *levels: str) -> DataFrame:
    units = {"province": prefix(F.col("regency"), 1), "regency": F.col("regency"), "district": F.col("district")}
    structs = F.array(*(F.struct(F.lit(lv).alias("level"), units[lv].alias("code")) for lv in levels))
    return lines.select(F.col("day").cast("string").alias("start_date"), "intersection_area_km2", "coverage_ratio", F.inline(structs))


def line_bridge(spark: SparkSession, d: str) -> DataFrame:
    """One bridge row per line item and level: quantity as area, discount as coverage."""
    return _bridge(located_lines(spark, d), "province", "regency", "district")


def daily(spark: SparkSession, d: str) -> DataFrame:
    return facts.daily_facts(line_bridge(spark, d))


def monthly(spark: SparkSession, d: str) -> DataFrame:
    return facts.monthly_facts(daily(spark, d))


def all_time(spark: SparkSession, d: str) -> DataFrame:
    return facts.all_time(monthly(spark, d))


def _written_lines(spark: SparkSession, d: str) -> DataFrame:
    return star.prepared("located_lines", spark, d, lambda: located_lines(spark, d))


def written_bridge(spark: SparkSession, d: str) -> DataFrame:
    """`line_bridge` over written lines."""
    return _bridge(_written_lines(spark, d), "province", "regency", "district")


def _written_daily(spark: SparkSession, d: str) -> DataFrame:
    """`daily` over written lines. Districts have about a row per line, which no combining before
    the shuffle makes fewer: their lines are dealt by code as they are, and no task holds a hash
    table of what it sends."""
    lines = _written_lines(spark, d)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    districts = (
        lines.select("day", "intersection_area_km2", "coverage_ratio", F.col("district").alias("code"))
        .repartition(parts, "code")
        .withColumns({"level": F.lit("district"), "start_date": F.col("day").cast("string")})
    )
    return facts.daily_facts(_bridge(lines, "province", "regency")).unionByName(facts.daily_facts(districts))


def written(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Day, month and all-time facts as the build stage leaves them for later stages, bucketed by
    code: a unit's rows lie together, so that months and windows are folded where they are."""
    day = star.prepared("line_daily", spark, d, lambda: _written_daily(spark, d), "code")
    month = star.prepared("line_monthly", spark, d, lambda: facts.monthly_facts(day), "code")
    total = star.prepared("line_all_time", spark, d, lambda: facts.all_time(month))
    return day, month, total


def fact_row_counts(spark, d):
    return facts.row_counts(daily(spark, d), monthly(spark, d))


def observed_months(spark, d):
    from tidemark.operators.explore import observed_months as months

    return months(monthly(spark, d))


def reconciliation(spark, d):
    """Sums per level through day, month and all-time facts; equal by construction."""
    frames = (("day", daily(spark, d)), ("month", monthly(spark, d)), ("all_time", all_time(spark, d)))
    out = None
    for name, f in frames:
        s = f.groupBy("level").agg(
            F.lit(name).alias("grain"),
            F.sum("unique_event_count").cast("long").alias("events"),
            F.sum("flood_days").cast("long").alias("flood_days"),
            F.sum("sum_intersection_area_km2").alias("area"),
            F.max("max_coverage_ratio").alias("ratio"),
        )
        out = s if out is None else out.unionByName(s)
    return out


def month_keys(spark, d):
    """Sliced month keys and the count of unusable dates, over the order status as well."""
    o = star.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("start_date")
    )
    bad = F.count_if(F.expr("try_cast(start_date AS DATE) IS NULL"))
    return o.groupBy(month_start(F.col("start_date")).alias("month_start")).agg(
        F.count(F.lit(1)).alias("rows"), bad.alias("bad_start_dates")
    )


def fact_positions(spark: SparkSession, d: str) -> DataFrame:
    """Place of every month fact in the published order."""
    _, month, _ = written(spark, d)
    return facts.fact_positions(month).select("level", "month_start", "code", "position")


QUERIES = {
    "fact_positions": fact_positions,
    "line_daily_facts": daily,
    "line_monthly_facts": monthly,
    "line_all_time": all_time,
    "fact_row_counts": fact_row_counts,
    "observed_months": observed_months,
    "fact_reconciliation": reconciliation,
    "month_keys": month_keys,
}

_BASE = sql.with_(sql.ADMIN, sql.LINES)

ORACLES = {
    "line_daily_facts": _BASE + "SELECT * FROM day",
    "fact_positions": _BASE
    + "SELECT level, month_start, code, row_number() OVER (ORDER BY level, month_start, code) AS position FROM mon",
    "line_monthly_facts": _BASE + "SELECT * FROM mon",
    "line_all_time": _BASE + "SELECT * FROM alltime",
    "fact_row_counts": _BASE
    + """
SELECT level, day_rows, month_rows
FROM (SELECT level, count(*) AS day_rows FROM day GROUP BY level)
JOIN (SELECT level, count(*) AS month_rows FROM mon GROUP BY level) USING (level)""",
    "observed_months": _BASE + "SELECT DISTINCT level, month_start[1:7] AS month FROM mon",
    "fact_reconciliation": _BASE
    + " UNION ALL ".join(
        f"""
SELECT level, '{g}' AS grain, count(*) AS events,
       (SELECT count(*) FROM day x WHERE x.level = bri.level) AS flood_days,
       sum(area) AS area, max(ratio) AS ratio FROM bri GROUP BY level"""
        for g in ("day", "month", "all_time")
    ),
    "month_keys": """
WITH o AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_date FROM orders)
SELECT start_date[1:7] || '-01' AS month_start, count(*) AS rows,
       count(*) FILTER (WHERE start_date[5:5] <> '-') AS bad_start_dates
FROM o GROUP BY 1""",
}
