"""Writers: Parquet, geo tables, GeoJSON, documents, shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import geo, wkb
from tidemark.functions.codes import prefix
from tidemark.operators.geometry import dataset_stats, repaired
from tidemark.operators.release import month_spine
from tidemark.operators.thinning import simplify
from tidemark.schemas import ADMIN_COLUMNS, BUNDLE_SEGMENTS, LEVELS, METRICS
from tidemark.session import cut_lineage

FEATURE_PROPERTIES = (*ADMIN_COLUMNS, "boundary_source")


def write_table(df: DataFrame, path: str, *partitions: str) -> None:
    """Full replacement of a Parquet table."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def write_geo(df: DataFrame, path: str, primary: str = "rings") -> None:
    """Parquet with a WKB ``geometry`` column and a sidecar document with the dataset's
    extent and geometry types; an empty input still writes its schema. Invalid geometry is
    written repaired."""
    df = valid_shapes(df, primary)
    rows = df.withColumn("geometry", wkb.encode_wkb(primary)).drop(primary, "edges", "extent")
    write_table(rows, f"{path}/data")
    s = dataset_stats(df.withColumnRenamed(primary, "rings"))
    column = F.struct(
        F.lit("WKB").alias("encoding"),
        F.lit("EPSG:4326").alias("crs"),
        F.filter(F.split("geometry_types", ","), lambda t: t != "").alias("geometry_types"),
        F.array("xmin", "ymin", "xmax", "ymax").alias("bbox"),
    )
    doc = F.struct(
        F.lit("1.0.0").alias("version"),
        F.lit("geometry").alias("primary_column"),
        F.struct(column.alias("geometry")).alias("columns"),
    )
    write_document(s.select(doc.alias("doc")), f"{path}/geo", "doc")


def valid_shapes(df: DataFrame, primary: str = "rings") -> DataFrame:
    """``df`` with rings that are valid, invalid ones as their even-odd repair."""
    own = [c for c in df.columns if c not in (primary, "edges", "extent", "valid")]
    found = df.withColumn("_g", wkb.repair(primary)).select(*own, F.col("_g.rings").alias("rings"), F.col("_g.valid").alias("valid"))
    return repaired(cut_lineage(found)).drop("valid").withColumnRenamed("rings", primary)


def write_document(df: DataFrame, path: str, column: str = "doc") -> None:
    """A one-row JSON document."""
    df.select(F.to_json(column).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def geojson_feature(columns: Sequence[str]) -> Column:
    props = F.struct(*(n for n in FEATURE_PROPERTIES if n in columns))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        props.alias("properties"),
        geo.geojson_geometry(F.col("rings")).alias("geometry"),
    )
    return F.to_json(feature, {"ignoreNullFields": "false"})


def write_geojson(df: DataFrame, path: str, tolerance: float = 0.0) -> None:
    """One feature per line and a partition per level, so files split and append; geometry
    is thinned when a tolerance is given."""
    thinned = simplify(df, tolerance)
    lines = thinned.select("level", geojson_feature(df.columns).alias("value"))
    lines.write.mode("overwrite").partitionBy("level").text(path)


def feature_collections(df: DataFrame, tolerance: float = 0.0, levels: Sequence[str] | None = None) -> DataFrame:
    """``level, part, code, nth, value``: the lines of one collection document per level.

    A document is its lines in the order of ``part``, ``code`` and ``nth``: a header, a feature a
    line, each but the first behind a comma, and a footer. No row holds more than a feature, so
    that a level may have any number of them.
    """
    thinned = simplify(df.filter(F.col("level").isin(*levels)) if levels else df, tolerance)
    text = geojson_feature(df.columns).alias("value")
    rows = cut_lineage(thinned.select("level", "code", text).withColumn("nth", F.monotonically_increasing_id()))
    first = rows.groupBy("level").agg(F.min(F.struct("code", "nth"))["nth"].alias("_first"))
    head, foot = '{"type":"FeatureCollection","features":[', "]}"
    ends = F.explode(F.array(*(F.struct(F.lit(p).alias("part"), F.lit(v).alias("value")) for p, v in ((0, head), (2, foot)))))
    line = F.when(F.col("nth") == F.col("_first"), F.col("value")).otherwise(F.concat(F.lit(","), F.col("value")))
    features = rows.join(first, "level").select("level", F.lit(1).alias("part"), "code", "nth", line.alias("value"))
    outer = first.select("level", ends.alias("e")).select("level", "e.part", F.lit("").alias("code"), F.lit(0).cast("long").alias("nth"), "e.value")
    return features.unionByName(outer)


def write_feature_collections(df: DataFrame, path: str, tolerance: float = 0.0, levels: Sequence[str] | None = None) -> None:
    """A folder per level whose files, one after the other by name, are the document."""
    order = ["level", "part", "code", "nth"]
    rows = feature_collections(df, tolerance, levels).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select("level", "value").write.mode("overwrite").partitionBy("level").text(path)


def month_shards(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "level", F.substring("month_start", 1, 7).alias("month"), "code", "month_start", *METRICS
    )


def write_month_shards(monthly: DataFrame, path: str) -> None:
    """One folder per (level, month). Rows are ranged on code as well, so a crowded month
    spreads over several files. Months without rows between the ends of a level, few by
    nature, get an empty shard each."""
    shards = month_shards(monthly).repartitionByRange("level", "month", "code")
    shards.write.mode("overwrite").partitionBy("level", "month").json(path)
    spark = monthly.sparkSession
    for r in month_spine(monthly).filter("NOT observed").select("level", "month").collect():
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/level={r['level']}/month={r['month']}/empty.json")
        out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
        out.write(10)  # one line end: readers skip files without a byte
        out.close()


def trend_shards(monthly: DataFrame) -> DataFrame:
    """Series keyed by unit, districts bundled by their first two segments."""
    key = F.col("code")
    for level, k in BUNDLE_SEGMENTS.items():
        key = F.when(F.col("level") == level, prefix(F.col("code"), k)).otherwise(key)
    return monthly.select("level", key.alias("shard_key"), "code", "month_start", *METRICS)


def write_trend_shards(monthly: DataFrame, path: str) -> None:
    order = ["level", "shard_key", "code", "month_start"]
    shards = trend_shards(monthly).repartitionByRange(*order).sortWithinPartitions(*order)
    shards.write.mode("overwrite").partitionBy("level", "shard_key").json(path)


def write_bundles(rows: DataFrame, slugs: DataFrame, path: str) -> None:
    """Documents per slug; the written slug list keeps slugs without rows."""
    rows.write.mode("overwrite").partitionBy("slug").json(f"{path}/rows")
    slugs.select("slug").distinct().write.mode("overwrite").json(f"{path}/slugs")


def level_order(level: Column) -> Column:
    return F.array_position(F.array(*(F.lit(v) for v in LEVELS)), level)
