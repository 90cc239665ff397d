"""Published documents and shards: JSON rows, registry forms, optional inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import EVENT_PAGE, METRIC_FIELDS, REGISTRY_ROW, STATE

MONTH_SHARD = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("month_start", T.StringType()),
        *METRIC_FIELDS,
        T.StructField("level", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)

TREND_SHARD = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("month_start", T.StringType()),
        *METRIC_FIELDS,
        T.StructField("level", T.StringType()),
        T.StructField("shard_key", T.StringType()),
    ]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


CODE_PATTERN = r"^[0-9]+([.][0-9]+)*$"


def folder_names(spark: SparkSession, root: str) -> DataFrame:
    """``name`` of each asset folder written under ``root``, from the file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return spark.createDataFrame([(n,) for n in names], "name string")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """``level, properties`` of written feature lines, one folder per level."""
    rows = spark.read.text(path).filter(F.length("value") > 0)
    found = F.from_json(F.get_json_object("value", "$.properties"), T.MapType(T.StringType(), T.StringType()))
    return rows.select("level", found.alias("properties"))


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """``level, file, line, value`` of written collection documents: lines in the order of file
    names and of places in a file (`sinks.writers.write_feature_collections`)."""
    rows = spark.read.text(path)
    return rows.select("level", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"), "value")


def read_collection_features(spark: SparkSession, path: str) -> DataFrame:
    """``level, properties`` of the features of written collection documents, without the
    header, the footer and the commas between them."""
    lines = read_collections(spark, path).withColumn("text", F.regexp_replace("value", "^,", ""))
    kept = lines.filter(F.get_json_object("text", "$.type") == "Feature")
    found = F.from_json(F.get_json_object("text", "$.properties"), T.MapType(T.StringType(), T.StringType()))
    return kept.select("level", found.alias("properties"))


def bundle_files(spark: SparkSession, root: str) -> DataFrame:
    """``slug, kind, path, modified`` of the bundles written under ``root``, one folder for
    each kind; the time is that of the file that lists the slugs."""
    parts = []
    for kind in ("events", "states"):
        if path_exists(spark, f"{root}/{kind}/slugs"):
            listed = spark.read.schema("slug string").json(f"{root}/{kind}/slugs")
            parts.append(
                listed.select(
                    "slug",
                    F.lit(kind).alias("kind"),
                    F.concat(F.lit(f"regencies/{kind}/rows/slug="), "slug").alias("path"),
                    F.col("_metadata.file_modification_time").alias("modified"),
                )
            )
    if not parts:
        return spark.createDataFrame([], "slug string, kind string, path string, modified timestamp")
    return reduce(DataFrame.unionByName, parts)


def read_bundle_rows(spark: SparkSession, path: str) -> DataFrame:
    """``slug`` of each row of written bundles; slugs whose bundle is empty have none."""
    if not path_exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], "slug string")
    return spark.read.schema("value string, slug string").text(f"{path}/rows").select("slug")


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON rows of an asset, or an empty typed table when it is absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def first_existing(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """New input, else the existing output, else the empty default."""
    for p in paths:
        if path_exists(spark, p):
            return spark.read.schema(schema).json(p)
    return spark.createDataFrame([], schema)


def document_rows(docs: DataFrame, key: str, row: T.StructType) -> DataFrame:
    """Rows of documents (column ``value``) that are a bare list or an object with a list
    under ``key``; other documents and non-object items give nothing."""
    bare = F.from_json("value", T.ArrayType(T.StringType()))
    listed = F.from_json(F.get_json_object("value", f"$.{key}"), T.ArrayType(T.StringType()))
    items = F.when(F.startswith(F.ltrim("value"), F.lit("[")), bare).otherwise(listed)
    keep = [c for c in docs.columns if c != "value"]
    texts = docs.select(*keep, F.posexplode(items).alias("position", "item"))
    objects = texts.filter(F.startswith(F.ltrim("item"), F.lit("{")))
    return objects.select(*keep, "position", F.from_json("item", row).alias("r")).select(
        *keep, "position", "r.*"
    )


def read_documents(spark: SparkSession, path: str, key: str, row: T.StructType) -> DataFrame:
    docs = spark.read.option("wholetext", True).text(path).select(
        "value", F.col("_metadata.file_name").alias("file_name")
    )
    return document_rows(docs, key, row)


def registry_rows(docs: DataFrame) -> DataFrame:
    """Registry rows of any form: a list of rows, or a map keyed by admin code whose rows are
    regencies, or a map keyed by slug whose rows name their code. Rows without a code are
    dropped, missing values defaulted; a slug defaults to its key."""
    listed = document_rows(docs, "rows", REGISTRY_ROW).drop("position")
    keyed = (
        docs.filter(F.startswith(F.ltrim("value"), F.lit("{")))
        .select(F.explode(F.from_json("value", T.MapType(T.StringType(), REGISTRY_ROW))).alias("k", "r"))
        .select("k", "r.*")
        .withColumn("is_code", F.col("k").rlike(CODE_PATTERN))
        .withColumn("admin_code", F.when(F.col("is_code"), F.col("k")).otherwise(F.col("admin_code")))
        .withColumn("admin_level", F.when(F.col("is_code"), F.lit("regency")).otherwise(F.col("admin_level")))
        .withColumn(
            "province_code",
            F.when(F.col("is_code"), F.substring_index("k", ".", 1)).otherwise(F.col("province_code")),
        )
        .withColumn("slug", F.coalesce(F.nullif("slug", F.lit("")), F.when(~F.col("is_code"), F.col("k"))))
        .drop("k", "is_code")
    )
    empty = F.lit("")
    rows = listed.select(*keyed.columns).unionByName(keyed)
    return rows.filter(F.coalesce("admin_code", empty) != "").select(
        "admin_code",
        F.coalesce(F.nullif("admin_level", empty), F.lit("regency")).alias("admin_level"),
        F.coalesce(F.nullif("province_code", empty), F.substring_index("admin_code", ".", 1)).alias("province_code"),
        *(F.coalesce(c, empty).alias(c) for c in ("slug", "events_path", "states_path", "updated_at")),
        "public_state_summary",
    )


def read_month_shards(spark: SparkSession, path: str) -> DataFrame:
    """Month shards; filters on level and month prune folders, a missing month is empty."""
    return read_optional(spark, path, MONTH_SHARD)


def read_trend_shards(spark: SparkSession, path: str) -> DataFrame:
    return read_optional(spark, path, TREND_SHARD)


def read_trend(spark: SparkSession, trend_path: str, month_path: str) -> DataFrame:
    """Series source of a release: trend shards, or the month shards without them."""
    if path_exists(spark, trend_path):
        return read_trend_shards(spark, trend_path)
    return read_month_shards(spark, month_path)


def read_qualitative(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The three optional inputs, each falling back to empty on its own."""
    return {
        "events": read_optional(spark, f"{root}/qualitative_events", EVENT_PAGE),
        "states": read_optional(spark, f"{root}/geography_review_states", STATE),
        "index": read_optional(spark, f"{root}/regencies/index", REGISTRY_ROW),
    }
