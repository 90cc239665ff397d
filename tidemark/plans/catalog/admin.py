"""Hierarchy, level choice, coverage and gate over region, nation, customer and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import codes
from tidemark.operators import admin, explore, facts
from tidemark.plans import star
from tidemark.plans.catalog import sql
from tidemark.schemas import ADMIN_COLUMNS


def boundaries(spark, d, public=False):
    """Boundary rows present per level, by plain predicates on the star tables; with ``public``
    those whose code is of a public level."""
    rich = star.table(spark, d, "supplier").filter("s_acctbal > 9000").select("s_nationkey")
    reg = star.table(spark, d, "region").select(
        F.lit("province").alias("level"),
        star.province_code(F.col("r_regionkey")).alias("code"),
        F.lit("derived").alias("boundary_source"),
    )
    nat = (
        star.regencies(spark, d)
        .join(rich, F.col("n_nationkey") == F.col("s_nationkey"), "left_semi")
        .select(F.lit("regency").alias("level"), "code", F.lit("raw").alias("boundary_source"))
    )
    dis = star.district_codes(spark, d)

    def district(where, source):
        return dis.filter(where).select(
            F.lit("district").alias("level"), "code", F.lit(source).alias("boundary_source")
        )

    o = star.table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    vil = star.village_orders(o, dis.select("c_custkey", "code"), public).select(
        F.lit("village").alias("level"), "code", F.lit("raw").alias("boundary_source")
    )
    return (
        reg.unionByName(nat)
        .unionByName(district("c_acctbal > 0", "raw"))
        .unionByName(district("c_acctbal > 9000", "derived"))
        .unionByName(vil)
        .withColumn("province_code", codes.prefix(F.col("code"), 1))
    )


def postal(spark, d):
    """Order lines as postal rows of their order's village; the last line of an order wins."""
    li = star.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = li.select(
        F.col("l_orderkey").alias("village"),
        codes.padded(F.col("l_suppkey"), 5).alias("postal_code"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    return admin.last_wins(rows, ["village"], ["l_linenumber", "l_partkey", "l_suppkey"])


def admin_units(spark, d, public=False):
    return admin.classify(star.admin_codes(spark, d, public=public))


def parent_codes(spark, d):
    a = admin.classify(star.admin_codes(spark, d))
    return a.select("code", *(codes.parent_code(lv).alias(f"at_{lv}") for lv in ("province", "regency", "district", "village")))


def rejected_codes(spark, d):
    """Village codes extended by the order status have five segments and no level."""
    a = star.admin_codes(spark, d)
    longer = a.select(F.concat_ws(".", "code", "name").alias("code"), "name")
    return admin.rejected_codes(longer)


def postal_last_wins(spark, d):
    return postal(spark, d).select("village", "postal_code")


def enriched_boundaries(spark, d):
    p = postal(spark, d)
    o = star.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    dis = star.district_codes(spark, d)
    villages = o.join(dis, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.concat_ws(".", "code", codes.padded(F.col("o_orderkey"), 9)).alias("village_code"),
    )
    post = p.join(villages, F.col("village") == F.col("o_orderkey")).select("village_code", "postal_code")
    b = boundaries(spark, d).select("code", "boundary_source")
    return admin.enrich_boundaries(b, admin_units(spark, d), post)


def level_choice(spark, d):
    """Without province rows the province level is dissolved from its regencies."""
    present = boundaries(spark, d).filter("level <> 'province'").select("level").distinct()
    return admin.level_sources(present)


def dissolve_members(spark, d):
    """Villages only: every higher level takes its members from below."""
    a = admin_units(spark, d)
    raw = boundaries(spark, d).filter("level = 'village'").select("code", "boundary_source").join(a, "code")
    kept, members = admin.choose_levels(raw, a)
    m = members.groupBy("target_level", "target_code").agg(F.count(F.lit(1)).alias("members"))
    return m.unionByName(
        kept.groupBy(F.col("level").alias("target_level"), F.col("code").alias("target_code")).agg(
            F.count(F.lit(1)).alias("members")
        )
    )


def admin_totals(spark, d):
    return admin.admin_totals(admin_units(spark, d))


def coverage_overall(spark, d):
    return admin.coverage(admin_units(spark, d), boundaries(spark, d))


def coverage_by_province(spark, d):
    return admin.coverage_by_province(admin_units(spark, d), boundaries(spark, d))


def boundary_source_mix(spark, d):
    return admin.source_mix(boundaries(spark, d))


def release_gate(spark, d):
    return admin.release_gate(coverage_overall(spark, d))


def reference_summary(spark, d):
    return admin.reference_summary(admin_units(spark, d), postal(spark, d), boundaries(spark, d))


def coverage_banner(spark, d):
    return explore.coverage_banner(release_gate(spark, d))


def village_gate(spark, d):
    """Levels to build and the reason for leaving villages out."""
    cov = coverage_overall(spark, d)
    out = None
    for asked in (False, True):
        g = facts.enabled_levels(asked, cov).select(
            F.lit(asked).alias("include_village"), F.array_join("levels", ",").alias("levels"), "warning"
        )
        out = g if out is None else out.unionByName(g)
    return out


QUERIES = {
    "admin_units": admin_units,
    "parent_codes": parent_codes,
    "rejected_codes": rejected_codes,
    "postal_last_wins": postal_last_wins,
    "enriched_boundaries": enriched_boundaries,
    "level_choice": level_choice,
    "dissolve_members": dissolve_members,
    "admin_totals": admin_totals,
    "coverage_overall": coverage_overall,
    "coverage_by_province": coverage_by_province,
    "boundary_source_mix": boundary_source_mix,
    "release_gate": release_gate,
    "reference_summary": reference_summary,
    "coverage_banner": coverage_banner,
    "village_gate": village_gate,
}

_BASE = sql.with_(sql.ADMIN)
_BND = sql.with_(sql.ADMIN, sql.BOUNDARIES)

_COVERAGE = """
cov AS (
  SELECT l.level, coalesce(t.n, 0) AS admin_total, coalesce(b.n, 0) AS boundary_total,
         CASE WHEN coalesce(t.n, 0) > 0 THEN round_even(coalesce(b.n, 0) / t.n, 6) ELSE 0.0 END AS coverage_ratio
  FROM (VALUES ('province'), ('regency'), ('district'), ('village')) l(level)
  LEFT JOIN (SELECT level, count(*) AS n FROM adm GROUP BY level) t ON l.level = t.level
  LEFT JOIN (SELECT level, count(DISTINCT code) AS n FROM bnd GROUP BY level) b ON l.level = b.level)
"""

_GATE = """
gate AS (
  SELECT 0.98::DOUBLE AS district_threshold,
         min(boundary_total) FILTER (WHERE level <> 'village') > 0
           AND max(coverage_ratio) FILTER (WHERE level = 'district') >= 0.98 AS district_release_ready,
         CASE WHEN min(boundary_total) FILTER (WHERE level <> 'village') = 0 THEN 'missing_required_levels'
              WHEN max(coverage_ratio) FILTER (WHERE level = 'district') < 0.98 THEN 'district_threshold_not_met'
         END AS warning_code
  FROM cov)
"""

_COV = sql.with_(sql.ADMIN, sql.BOUNDARIES, _COVERAGE, _GATE)

_POSTAL = """
pst AS (
  SELECT l_orderkey AS village, printf('%05d', l_suppkey) AS postal_code
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1)
"""

ORACLES = {
    "admin_units": _BASE + f"SELECT {', '.join(ADMIN_COLUMNS)} FROM adm",
    "parent_codes": _BASE
    + """
SELECT code, province_code AS at_province, regency_code AS at_regency, district_code AS at_district,
       coalesce(village_code, code) AS at_village FROM adm""",
    "rejected_codes": _BASE + "SELECT code || '.' || name AS code, name FROM vil",
    "postal_last_wins": sql.with_(_POSTAL) + "SELECT village, postal_code FROM pst",
    "enriched_boundaries": sql.with_(sql.ADMIN, sql.BOUNDARIES, _POSTAL)
    + """
SELECT adm.*, pst.postal_code, bnd.boundary_source
FROM bnd JOIN adm ON bnd.code = adm.code
LEFT JOIN vil ON vil.code = adm.code
LEFT JOIN pst ON pst.village = vil.o_orderkey""",
    "level_choice": """
SELECT * FROM (VALUES ('province', 'regency'), ('regency', 'regency'), ('district', 'district'),
  ('village', 'village')) t(level, source_level)
WHERE (SELECT count(*) FROM supplier WHERE s_acctbal > 9000) > 0""",
    "dissolve_members": _BASE
    + """
, v AS (SELECT code FROM vil WHERE o_orderstatus = 'F')
SELECT 'province' AS target_level, split_part(code, '.', 1) AS target_code, count(*) AS members FROM v GROUP BY 2
UNION ALL
SELECT 'regency', array_to_string(string_split(code, '.')[1:2], '.'), count(*) FROM v GROUP BY 2
UNION ALL
SELECT 'district', array_to_string(string_split(code, '.')[1:3], '.'), count(*) FROM v GROUP BY 2
UNION ALL
SELECT 'village', code, count(*) FROM v GROUP BY 2""",
    "admin_totals": _BASE
    + """
SELECT level, province_code, count(*) AS admin_total, grouping(province_code) = 0 AS per_province
FROM adm GROUP BY GROUPING SETS ((level), (level, province_code))""",
    "coverage_overall": _COV + "SELECT * FROM cov",
    "coverage_by_province": _BND
    + """
SELECT p.province_code, l.level, coalesce(t.n, 0) AS admin_total, coalesce(b.n, 0) AS boundary_total,
       CASE WHEN coalesce(t.n, 0) > 0 THEN round_even(coalesce(b.n, 0) / t.n, 6) ELSE 0.0 END AS coverage_ratio
FROM (SELECT DISTINCT province_code FROM adm) p
CROSS JOIN (VALUES ('province'), ('regency'), ('district'), ('village')) l(level)
LEFT JOIN (SELECT level, province_code, count(*) AS n FROM adm GROUP BY ALL) t
  ON t.level = l.level AND t.province_code = p.province_code
LEFT JOIN (SELECT level, split_part(code, '.', 1) AS province_code, count(DISTINCT code) AS n
           FROM bnd GROUP BY ALL) b
  ON b.level = l.level AND b.province_code = p.province_code""",
    "boundary_source_mix": _BND
    + "SELECT level, boundary_source, count(*) AS rows FROM bnd GROUP BY ALL",
    "release_gate": _COV + "SELECT * FROM gate",
    "reference_summary": sql.with_(sql.ADMIN, sql.BOUNDARIES, _POSTAL)
    + """
SELECT 'admin_units' AS item, count(*) AS rows FROM adm
UNION ALL SELECT 'postal_rows', count(*) FROM pst
UNION ALL SELECT level || '_boundaries', count(*) FROM bnd GROUP BY level""",
    "coverage_banner": _COV
    + """
SELECT CASE WHEN district_release_ready THEN 'panel.coverage_ready' ELSE 'panel.coverage_blocked' END AS banner_key,
       coalesce('warning.' || warning_code, 'panel.coverage_reason') AS warning_key
FROM gate""",
    "village_gate": _COV
    + """
SELECT a AS include_village,
       CASE WHEN a AND ratio >= 0.95 THEN 'province,regency,district,village' ELSE 'province,regency,district' END AS levels,
       CASE WHEN NOT a THEN 'village_metrics_skipped_by_default'
            WHEN ratio < 0.95 THEN 'village_metrics_skipped_low_coverage' END AS warning
FROM (SELECT coverage_ratio AS ratio FROM cov WHERE level = 'village') CROSS JOIN (VALUES (true), (false)) f(a)""",
}
