"""Footprint scans and source profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import geo, wkb
from tidemark.operators.overlap import plane_area_km2
from tidemark.schemas import FOOTPRINT
from tidemark.session import cut_lineage
from tidemark.sources.assets import path_exists


def read_footprints(spark: SparkSession, path: str) -> DataFrame:
    """Decoded, repaired, non-empty footprints.

    Five columns are read; rows without uuid, start date or geometry are filtered before
    decoding. ``row_id`` is the place of a source row (hashed file, row in file), the same in
    every job over the source; ``source_file`` and ``source_row`` give it in order. Missing
    areas are filled from the geometry.
    """
    return decode_footprints(_placed(spark, path))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], FOOTPRINT)
    raw = spark.read.schema(FOOTPRINT).parquet(path)
    place = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row")]
    at = F.struct(F.xxhash64("source_file").alias("file"), F.col("source_row").alias("row"))
    return raw.select("*", *place).withColumn("row_id", at)


def decode_footprints(raw: DataFrame) -> DataFrame:
    """The same for rows at hand; without ``row_id`` rows are numbered within the job."""
    return accepted(decoded(raw))


def decoded(raw: DataFrame) -> DataFrame:
    """All rows with uuid, start date and geometry, decoded: ``g`` holds rings, edges, whether
    they are valid, and the ``reason`` if there are no rings."""
    kept = raw.filter("uuid IS NOT NULL AND start_date IS NOT NULL AND geometry IS NOT NULL")
    if "row_id" not in kept.columns:
        kept = kept.withColumn("row_id", F.monotonically_increasing_id())
    return kept.withColumn("g", wkb.decode_wkb("geometry")).drop("geometry")


def accepted(rows: DataFrame) -> DataFrame:
    """Decoded rows that have an area."""
    own = [c for c in rows.columns if c != "g"]
    dec = rows.filter(~geo.is_empty(F.col("g.rings")))
    shaped = dec.select(*own, "g.rings", "g.edges", "g.valid", geo.bounds(F.col("g.rings")).alias("extent"))
    own_area = plane_area_km2(F.col("edges"), F.col("extent.ymin"))
    return shaped.withColumn("footprint_area_km2", filled_area(F.col("area_km2"), own_area))


def rejected(rows: DataFrame) -> DataFrame:
    """``reason, rows`` of decoded rows without an area."""
    return rows.filter(geo.is_empty(F.col("g.rings"))).groupBy(F.col("g.reason").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def scan_footprints(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Footprints of a source and the counts of its rejected rows by reason, from one decoding
    that is written for all jobs over it."""
    rows = cut_lineage(decoded(_placed(spark, path)))
    return accepted(rows), rejected(rows)


def filled_area(area: Column, own: Column) -> Column:
    """The source's area when finite, else that of the repaired geometry."""
    infinite = F.lit(float("inf"))
    finite = area.isNotNull() & ~F.isnan(area) & (F.abs(area) < infinite)
    return F.when(finite, area).otherwise(own)


def profile(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows, minimum and maximum per input split, the scan's unit of work."""
    df = spark.read.parquet(path)
    names = {"file_path": "file_path", "file_name": "file_name", "file_block_start": "block_start"}
    where = [F.col(f"_metadata.{k}").alias(v) for k, v in names.items()]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.select(*columns, *where).groupBy(*names.values()).agg(*aggs)


def whole_profile(parts: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, minimum and maximum per file, from the profiles of its splits."""
    aggs = [F.sum("rows").alias("rows")]
    for c in columns:
        aggs += [F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
    return parts.groupBy("file_name").agg(*aggs)


def fields(spark: SparkSession, path: str) -> DataFrame:
    """Field list of a source."""
    schema = spark.read.parquet(path).schema
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")
