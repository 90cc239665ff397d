"""Dumps, documents, registries, shards and profiles derived from the star tables."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codes, geo, wkb
from tidemark.operators import explore, overlap, release
from tidemark.operators.admin import classify
from tidemark.plans import star
from tidemark.plans.catalog import facts, sql
from tidemark.schemas import ADMIN_COLUMNS, METRICS
from tidemark.session import work_path
from tidemark.sinks import writers
from tidemark.sources import assets, dumps, footprints


def dump_rows(spark, d):
    """Customers through an insert dump with quotes, commas, brackets and semicolons."""
    c = star.table(spark, d, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("'s ("), "c_mktsegment", F.lit("), x; y")).alias("name")
    )
    back = dumps.insert_tuples(dumps.to_statements(c, "units", ["c_custkey", "name"]))
    return dumps.pairs(back, "code", "name").select("code", "name")


def dump_admin(spark, d):
    text = dumps.to_statements(star.admin_codes(spark, d, village=False), "units", ["code", "name"])
    return classify(dumps.pairs(dumps.insert_tuples(text), "code", "name"))


def _boundary_text(spark, d):
    """Tiles as columns of a boundary dump, coordinates as nested lists of latitude, longitude."""
    def pair(y, x):
        return F.format_string("[%s,%s]", y.cast("string"), x.cast("string"))

    a, b, c, e = (F.col(n) for n in ("xmin", "ymin", "xmax", "ymax"))
    ring = F.concat(F.lit("[[["), F.concat_ws(",", pair(b, a), pair(b, c), pair(e, c), pair(e, a), pair(b, a)), F.lit("]]]"))
    return star.tiles(spark, d).select("level", "code", F.lit("n").alias("name"), b.alias("lat"), a.alias("lng"), ring.alias("path"))


def boundary_dump(spark, d):
    """Tiles through boundary dumps: level from the folder, lat/lng text to shapes."""
    t = _boundary_text(spark, d)
    folders = F.create_map(*(F.lit(x) for f, lv in dumps.BOUNDARY_FOLDERS.items() for x in (lv, f)))
    path = F.concat(F.lit("file:/raw/boundaries/"), folders[F.col("level")], F.lit("/all.sql"))
    out = dumps.to_statements(
        t.withColumn("file_path", path), "b", ["code", "name", "lat", "lng", "path"], keys=("file_path",)
    )
    return _shape_columns(dumps.with_shapes(dumps.boundary_rows(dumps.insert_tuples(out))))


def _shape_columns(shapes):
    return shapes.select(
        "level", "code", F.round("centroid_lat", 6).alias("lat"), F.round("extent.xmax", 6).alias("xmax"),
        F.size("edges").alias("edges"), F.round(geo.area_km2(F.col("rings")), 3).alias("area_km2"), "boundary_source",
    )


def _conversation_docs(spark, d):
    """A conversation per document: assistants' openings as an object, others as a bare list."""
    c = star.table(spark, d, "conversations").select("conv_id", F.struct("turn", "role").alias("r"))
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list("r")).alias("rows"))
    wrapped = F.to_json(F.struct(F.col("rows").alias("events")))
    return g.select("conv_id", F.when(F.size("rows") > 3, wrapped).otherwise(F.to_json("rows")).alias("value"))


def document_rows(spark, d):
    from pyspark.sql import types as T

    row = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType())])
    return assets.document_rows(_conversation_docs(spark, d), "events", row)


def registry_forms(spark, d):
    """One registry document per region: a map for those with an A in their name, else a list."""
    n = star.table(spark, d, "nation")
    r = star.table(spark, d, "region")
    reg = star.regencies(spark, d).select("n_nationkey", "code")
    j = n.join(reg, "n_nationkey").join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    row = F.struct(
        F.col("code").alias("admin_code"), F.col("n_name").alias("slug"),
        F.concat(F.lit("regencies/"), "n_name").alias("events_path"),
    )
    g = j.groupBy("r_name").agg(
        F.map_from_entries(F.collect_list(F.struct("code", row))).alias("m"), F.collect_list(row).alias("l")
    )
    docs = g.select(F.when(F.contains("r_name", F.lit("A")), F.to_json("m")).otherwise(F.to_json("l")).alias("value"))
    return assets.registry_rows(docs).drop("public_state_summary")


def source_profile(spark, d):
    columns = ["l_quantity", "l_extendedprice"]
    return footprints.whole_profile(footprints.profile(spark, f"{d}/lineitem.parquet", columns), columns)


def source_fields(spark, d):
    """Field list of the events source with its row count."""
    n = star.table(spark, d, "events").agg(F.count(F.lit(1)).alias("n")).scalar()
    return footprints.fields(spark, f"{d}/events.parquet").select("name", n.alias("rows"))


def filled_areas(spark, d):
    """Source areas with missing, NaN and infinite values filled from the geometry."""
    f = star.footprints(spark, d)
    a = star.table(spark, d, "events").select(
        F.col("event_id").alias("row_id"),
        F.when(F.col("event_type") == "click", F.lit(float("nan")))
        .when(F.col("event_type") == "error", F.lit(float("inf")))
        .when(F.col("event_type") == "view", F.lit(None).cast("double"))
        .otherwise(F.col("value"))
        .alias("area_km2"),
    )
    return f.join(a, "row_id").select(
        "row_id", F.round(footprints.filled_area(F.col("area_km2"), geo.area_km2(F.col("rings"))), 4).alias("area_km2")
    )


#: Spark's text writer names its files so.
_WRITTEN = "part-*"


def _dumped(df, path, table, columns):
    """A table as dump files: the writer ends each statement's line, the text its statement."""
    text = dumps.to_statements(df, table, columns)
    text.select(F.concat("value", F.lit(";")).alias("value")).write.text(path)
    return path


def unit_files(spark, d):
    """Units through dump files, a statement break inside every district's name."""
    u = star.admin_codes(spark, d, village=False)
    name = F.when(F.length("code") > 5, F.concat("name", F.lit(";\n'x'); VALUES ("))).otherwise(F.col("name"))
    path = _dumped(u.select("code", name.alias("name")), work_path(spark, "unit-files"), "units", ["code", "name"])
    return dumps.read_units(spark, path, _WRITTEN).select("code", "name", "level")


def postal_files(spark, d):
    """Postal codes of suppliers' nations through dump files; missing ones are NULL."""
    s = star.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("village_code"),
        F.when(F.col("s_acctbal") > 0, codes.padded(F.col("s_nationkey"), 5)).alias("postal_code"),
    )
    path = _dumped(s, work_path(spark, "postal-files"), "postal", ["village_code", "postal_code"])
    return dumps.read_postal(spark, path, _WRITTEN).select("village_code", "postal_code")


def boundary_files(spark, d):
    """Tiles through one folder of boundary dump files per level."""
    root = work_path(spark, "boundary-files")
    t = _boundary_text(spark, d)
    columns = ["code", "name", "lat", "lng", "path"]
    for folder, level in dumps.BOUNDARY_FOLDERS.items():
        if level != "village":
            _dumped(t.filter(F.col("level") == level).select(*columns), f"{root}/boundaries/{folder}/all", "b", columns)
    return _shape_columns(dumps.read_boundaries(spark, root, _WRITTEN))


def _footprint_files(spark, d):
    """Footprints through a Parquet source with null fields, an empty geometry, an invalid one
    and areas to fill."""
    x, y, h, k = F.col("lon"), F.col("lat"), F.col("half"), F.col("row_id")
    a, b, c, e = (geo.point(x + dx * h, y + dy * h) for dx, dy in ((-1, -1), (1, 1), (1, -1), (-1, 1)))
    bow_tie = geo.single_ring(a, b, c, e, a)
    square = geo.box(x - h, y - h, x + h, y + h)
    none = F.filter(square, lambda r: F.lit(False))
    rings = F.when(k % 11 == 0, bow_tie).when(k % 13 == 0, none).otherwise(square)
    rows = star.squares(spark, d).withColumn("rings", rings).withColumn("geometry", wkb.encode_wkb("rings")).select(
        F.when(k % 17 != 0, F.concat("uuid", F.lit("-"), k.cast("string"))).alias("uuid"),
        F.when(k % 3 == 0, F.lit(None).cast("double")).when(k % 3 == 1, F.lit(float("nan"))).otherwise(F.lit(1.5)).alias("area_km2"),
        F.when(k % 19 != 0, F.col("geometry")).alias("geometry"),
        F.when(k % 23 != 0, F.col("start_date")).alias("start_date"),
        "end_date",
    )
    path = work_path(spark, "footprint-files")
    rows.write.parquet(path)
    return footprints.read_footprints(spark, path)


def footprint_files(spark, d):
    """What a Parquet source keeps, and the area of each."""
    back = _footprint_files(spark, d)
    return back.select("uuid", "start_date", F.round("footprint_area_km2", 3).alias("area_km2"))


def written_repairs(spark, d):
    """Bow-ties, crossed rings and overlapping parts, written and decoded again: valid, in as
    many parts as their repair has, and of its area."""
    x, y, h, k = F.col("lon"), F.col("lat"), F.col("half"), F.col("row_id")

    def at(i, j):
        return geo.point(x + i * h, y + j * h)

    bow_tie = geo.single_ring(at(-1, -1), at(1, 1), at(1, -1), at(-1, 1), at(-1, -1))
    crossed = geo.single_ring(at(0, 1), at(2, 1), at(2, 2), at(1, 2), at(1, 0), at(0, 0), at(0, 1))
    square = geo.box(x - h, y - h, x + h, y + h)
    over = F.concat(geo.box(x, y, x + 2 * h, y + 2 * h), F.transform(geo.box(x + h, y + h, x + 3 * h, y + 3 * h), lambda r: r.withField("part", F.lit(1))))
    rings = F.when(k % 4 == 0, bow_tie).when(k % 4 == 1, crossed).when(k % 4 == 2, over).otherwise(square)
    path = work_path(spark, "repairs")
    source = star.squares(spark, d).select("row_id", rings.alias("rings"))
    writers.write_geo(source, path)
    back = spark.read.parquet(f"{path}/data").select("row_id", wkb.decode_wkb("geometry").alias("g"))
    area = overlap.plane_area_km2(F.col("edges"), F.col("floor"))
    was = source.select("row_id", (F.col("rings")[0]["pts"][0]["y"]).alias("floor"), wkb.repair("rings").alias("g"))
    was = was.select("row_id", "floor", F.col("g.edges").alias("edges")).withColumn("was", area).select("row_id", "floor", "was")
    found = back.join(was, "row_id").withColumn("edges", F.col("g.edges")).withColumn("now", area)
    return found.select(
        "row_id", "g.valid", F.size(F.array_distinct(F.transform("g.rings", lambda r: r["part"]))).alias("parts"),
        (F.abs(F.col("now") - F.col("was")) < 1e-4).alias("same_area"),
    )


@F.arrow_udf(T.BinaryType())
def _wkb_form(kind: pa.Array, x: pa.Array, y: pa.Array, h: pa.Array) -> pa.Array:
    """A square as WKB of a form: plain, with height, measure or both, with flags and a system's
    number, in a collection; or a line, an unknown type, a broken polygon."""

    def one(kind: int, x: float, y: float, h: float) -> bytes:
        flat = [(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]
        order = ">" if kind == 4 else "<"
        code, extra = {1: (1003, 1), 2: (2003, 1), 3: (3003, 2), 4: (0xA0000003, 1)}.get(kind, (3, 0))
        head = struct.pack(order + "BI", order == "<", code) + (struct.pack(order + "I", 4326) if kind == 4 else b"")
        points = b"".join(struct.pack(f"{order}{2 + extra}d", *p, *[7.0] * extra) for p in flat)
        polygon = head + struct.pack(order + "II", 1, 5) + points
        if kind == 5:
            return struct.pack("<BII", 1, 7, 2) + struct.pack("<BIdd", 1, 1, x, y) + polygon
        if kind == 6:
            return struct.pack("<BII", 1, 2, 5) + points
        if kind == 7:
            return struct.pack("<BI", 1, 17) + polygon[5:]
        return polygon[:40] if kind == 8 else polygon

    return pa.array([one(*r) for r in zip(*(c.to_pylist() for c in (kind, x, y, h)))], pa.binary())


def _forms(spark, d):
    path = work_path(spark, "forms")
    geometry = _wkb_form((F.col("row_id") % 9).cast("int"), "lon", "lat", "half")
    rows = star.squares(spark, d).select(
        F.concat("uuid", F.lit("-"), F.col("row_id").cast("string")).alias("uuid"), F.lit(None).cast("double").alias("area_km2"),
        geometry.alias("geometry"), "start_date", "end_date",
    )
    rows.write.parquet(path)
    return footprints.scan_footprints(spark, path)


def wkb_forms(spark, d):
    """Squares in all forms that have an area."""
    return _forms(spark, d)[0].select("uuid", "valid", F.round("footprint_area_km2", 3).alias("area_km2"))


def wkb_rejects(spark, d):
    """Rows of other forms, counted by reason."""
    return _forms(spark, d)[1]


def bridged_files(spark, d):
    """The same footprints over the provinces: shared areas add up to the repaired shape, whatever
    area the source gives."""
    provinces = star.unit_fragments(spark, d).filter("level = 'province'")
    rows = overlap.bridge(_footprint_files(spark, d), provinces)
    share = F.sum(F.col("coverage_ratio_of_footprint") * F.col("footprint_area_km2"))
    return rows.groupBy("uuid").agg(
        F.round(F.sum("intersection_area_km2"), 2).alias("shared_km2"), F.round(share, 2).alias("by_ratio_km2")
    )


def month_shards(spark, d):
    """Shards written per month; the window prunes folders."""
    path = work_path(spark, "month-shards")
    writers.write_month_shards(facts.written(spark, d)[1], path)
    s = assets.read_month_shards(spark, path)
    listed = star.prepared("metric_assets", spark, d, lambda: release.metric_assets(facts.written(spark, d)[1]))
    return explore.window_rollup(s, "district", "1996-03", "1998-07", months=listed)


def trend_shards(spark, d):
    """A district series from its two-segment bundle."""
    path = work_path(spark, "trend-shards")
    writers.write_trend_shards(facts.written(spark, d)[1], path)
    s = assets.read_trend(spark, path, f"{path}-none")
    return explore.trend(s, "district", "13.03.0000000", "1996-03", "")


def trend_from_months(spark, d):
    """The same series scanned from month shards when there are no trend shards."""
    path = work_path(spark, "month-shards")
    writers.write_month_shards(facts.written(spark, d)[1], path)
    s = assets.read_trend(spark, f"{path}-none", path)
    return explore.trend(s, "district", "13.03.0000000", "1996-03", "")


def geo_table(spark, d):
    """Tiles written with WKB and read back as footprints would be."""
    path = work_path(spark, "geo")
    writers.write_geo(star.unit_shapes(spark, d), path)
    back = spark.read.parquet(f"{path}/data").select(
        "level", "code", F.lit("u").alias("uuid"), F.lit("2024-01-01").alias("start_date"),
        F.lit(None).cast("double").alias("area_km2"), "geometry",
    )
    return footprints.decode_footprints(back).select("level", "code", F.round("footprint_area_km2", 3).alias("area_km2"))


def geo_sidecar(spark, d):
    path = work_path(spark, "geo")
    writers.write_geo(star.unit_shapes(spark, d), path)
    doc = F.from_json(
        "value",
        "struct<version string, primary_column string, columns struct<geometry struct<encoding string, geometry_types array<string>, bbox array<double>>>>",
    )
    g = spark.read.text(f"{path}/geo").select(doc.alias("d")).select("d.version", "d.primary_column", "d.columns.geometry.*")
    return g.select(
        "version", "primary_column", "encoding", F.array_join("geometry_types", ",").alias("types"),
        *(F.round(F.col("bbox")[i], 6).alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))),
    )


def missing_source(spark, d):
    """Rows of an absent source next to those of a present one."""
    gone = assets.read_month_shards(spark, f"{d}/absent")
    monthly = facts.written(spark, d)[1]
    both = gone.select(*METRICS).withColumn("src", F.lit("absent")).unionByName(
        monthly.select(*METRICS).withColumn("src", F.lit("present"))
    )
    return both.groupBy("src").agg(F.count(F.lit(1)).alias("rows"))


QUERIES = {
    "dump_rows": dump_rows,
    "dump_admin": dump_admin,
    "boundary_dump": boundary_dump,
    "unit_files": unit_files,
    "postal_files": postal_files,
    "boundary_files": boundary_files,
    "footprint_files": footprint_files,
    "written_repairs": written_repairs,
    "wkb_forms": wkb_forms,
    "wkb_rejects": wkb_rejects,
    "bridged_files": bridged_files,
    "document_rows": document_rows,
    "registry_forms": registry_forms,
    "source_profile": source_profile,
    "source_fields": source_fields,
    "filled_areas": filled_areas,
    "month_shards": month_shards,
    "trend_shards": trend_shards,
    "trend_from_months": trend_from_months,
    "geo_table": geo_table,
    "geo_sidecar": geo_sidecar,
    "missing_source": missing_source,
}

_TILES = sql.with_(sql.ADMIN, sql.TILES)
_LINES = sql.with_(sql.ADMIN, sql.LINES)
_AREA = (
    f"({sql.project_x('xmax')} - {sql.project_x('xmin')}) * "
    f"({sql.project_y('ymax')} - {sql.project_y('ymin')}) / 1e6"
)
_SQUARE = f"2 * {sql.project_x('half')} * ({sql.project_y('(lat + half)')} - {sql.project_y('(lat - half)')}) / 1e6"
# the diagonals cross in the middle of the projected square: two triangles, half of it
_BOW_TIE = f"({_SQUARE}) / 2"
_TREND = (
    _LINES
    + "SELECT * EXCLUDE (level) FROM mon WHERE level = 'district' AND code = '13.03.0000000' AND month_start >= '1996-03'"
)

ORACLES = {
    "dump_rows": "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name || '''s (' || c_mktsegment || '), x; y' AS name FROM customer",
    "dump_admin": sql.with_(sql.ADMIN) + f"SELECT {', '.join(ADMIN_COLUMNS)} FROM adm WHERE level <> 'village'",
    "boundary_dump": _TILES
    + f"""
SELECT level, code, round(ymin, 6) AS lat, round(xmax, 6) AS xmax, 4 AS edges, round({_AREA}, 3) AS area_km2,
       'raw' AS boundary_source FROM tile""",
    "unit_files": sql.with_(sql.ADMIN)
    + """
SELECT code, CASE WHEN length(code) > 5 THEN name || ';' || chr(10) || chr(39) || 'x' || chr(39) || '); VALUES ('
             ELSE name END AS name, level
FROM adm WHERE level <> 'village'""",
    "postal_files": """
SELECT CAST(s_suppkey AS VARCHAR) AS village_code,
       CASE WHEN s_acctbal > 0 THEN printf('%05d', s_nationkey) END AS postal_code FROM supplier""",
    "boundary_files": _TILES
    + f"""
SELECT level, code, round(ymin, 6) AS lat, round(xmax, 6) AS xmax, 4 AS edges, round({_AREA}, 3) AS area_km2,
       'raw' AS boundary_source FROM tile""",
    "footprint_files": sql.with_(sql.SQUARES)
    + f"""
SELECT uuid || '-' || row_id AS uuid, start_date,
       CASE WHEN row_id % 3 = 2 THEN 1.5
            WHEN row_id % 11 = 0 THEN round({_BOW_TIE}, 3)
            ELSE round({_SQUARE}, 3) END AS area_km2
FROM sq WHERE row_id % 17 <> 0 AND row_id % 19 <> 0 AND row_id % 23 <> 0 AND (row_id % 13 <> 0 OR row_id % 11 = 0)""",
    "written_repairs": sql.with_(sql.SQUARES)
    + "SELECT row_id, true AS valid, CASE WHEN row_id % 4 = 3 THEN 1 ELSE 2 END AS parts, true AS same_area FROM sq",
    "wkb_forms": sql.with_(sql.SQUARES)
    + f"SELECT uuid || '-' || row_id AS uuid, true AS valid, round({_SQUARE}, 3) AS area_km2 FROM sq WHERE row_id % 9 < 6",
    "wkb_rejects": sql.with_(sql.SQUARES)
    + """
SELECT CASE row_id % 9 WHEN 6 THEN 'line string' WHEN 7 THEN 'type 17' ELSE 'broken' END AS reason, count(*) AS rows
FROM sq WHERE row_id % 9 > 5 GROUP BY 1""",
    "bridged_files": sql.with_(sql.SQUARES)
    + f"""
SELECT uuid || '-' || row_id AS uuid, round(a, 2) AS shared_km2, round(a, 2) AS by_ratio_km2
FROM (SELECT *, CASE WHEN row_id % 11 = 0 THEN {_BOW_TIE} ELSE {_SQUARE} END AS a FROM sq)
WHERE row_id % 17 <> 0 AND row_id % 19 <> 0 AND row_id % 23 <> 0 AND (row_id % 13 <> 0 OR row_id % 11 = 0)""",
    "document_rows": """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS INTEGER) AS position, turn, role
FROM conversations""",
    "registry_forms": sql.with_(sql.ADMIN)
    + """
SELECT code AS admin_code, 'regency' AS admin_level, split_part(code, '.', 1) AS province_code, name AS slug,
       'regencies/' || name AS events_path, '' AS states_path, '' AS updated_at FROM nat""",
    "source_profile": """
SELECT 'lineitem.parquet' AS file_name, count(*) AS rows, min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
       min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice FROM lineitem""",
    "source_fields": """
SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS name, n AS rows
FROM (SELECT count(*) AS n FROM events)""",
    "filled_areas": sql.with_(sql.SQUARES)
    + f"""
SELECT row_id, CASE WHEN event_type IN ('click', 'error', 'view')
  THEN round(2 * {sql.project_x('half')} * ({sql.project_y('(lat + half)')} - {sql.project_y('(lat - half)')}) / 1e6, 4)
  ELSE value END AS area_km2
FROM sq JOIN events ON row_id = event_id""",
    "month_shards": _LINES
    + """
SELECT code, CAST(sum(unique_event_count) AS BIGINT) AS unique_event_count, CAST(sum(flood_days) AS BIGINT) AS flood_days,
       sum(sum_intersection_area_km2) AS sum_intersection_area_km2, max(max_coverage_ratio) AS max_coverage_ratio,
       'date_window' AS mode
FROM mon WHERE level = 'district' AND month_start[1:7] BETWEEN '1996-03' AND '1998-07' GROUP BY code""",
    "trend_shards": _TREND,
    "trend_from_months": _TREND,
    "geo_table": _TILES + f"SELECT level, code, round({_AREA}, 3) AS area_km2 FROM tile",
    "geo_sidecar": _TILES
    + """
SELECT '1.0.0' AS version, 'geometry' AS primary_column, 'WKB' AS encoding, 'Polygon' AS types,
       round(min(xmin), 6) AS xmin, round(min(ymin), 6) AS ymin, round(max(xmax), 6) AS xmax, round(max(ymax), 6) AS ymax
FROM tile""",
    "missing_source": _LINES + "SELECT 'present' AS src, count(*) AS rows FROM mon",
}
