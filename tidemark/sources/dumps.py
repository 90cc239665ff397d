"""Rows from SQL dumps: multi-row inserts read as statements and cut by pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import geo, wkb
from tidemark.operators import geometry
from tidemark.operators.admin import classify, last_wins
from tidemark.session import cut_lineage

# A quoted literal with doubled quotes, a whole tuple, one field of a tuple.
LITERAL = r"'[^']*+(?:''[^']*+)*+'"
TUPLE = rf"\((?:[^()']++|{LITERAL})*+\)"
FIELD = rf"{LITERAL}|[^,()'\s][^,()']*+"

#: The tuples of one statement: whatever follows VALUES. Text in literals is consumed with
#: its tuple, so a VALUES inside a literal does not count.
TUPLES = rf"(?i)\bVALUES\s*+((?:{TUPLE}\s*+,?+\s*+)*+)"

# Folder of each level's boundary dumps.
BOUNDARY_FOLDERS = {"prov": "province", "kab": "regency", "kec": "district", "kel": "village"}


PATTERN = "*.sql"

#: Where a chunk stands: file, split of the file, order within the task that reads the split.
PLACE = ("file_path", "block", "statement")


def read_statements(
    spark: SparkSession, path: str, separator: str = ";\n", recursive: bool = False, pattern: str = PATTERN
) -> DataFrame:
    """Chunks of a dump as ``value`` with their place, each of one or more whole statements.

    Splitting at the separator keeps big dumps splittable. A separator inside a literal leaves
    chunks with an odd number of quotes; running parity over places alone finds them, and the
    texts of each such run are put together again.
    """
    reader = spark.read.option("lineSep", separator).option("recursiveFileLookup", recursive)
    chunks = reader.option("pathGlobFilter", pattern).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("statement"),
    )
    odd = ((F.length("value") - F.length(F.replace("value", F.lit("'")))) % 2).alias("odd")
    before = Window.partitionBy("file_path").orderBy("block", "statement").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file_path").orderBy("block", "statement")
    places = (
        chunks.select(*PLACE, odd)
        .withColumn("open", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
        .filter("odd = 1 OR open = 1")
        .withColumn("run", F.sum((F.col("open") == 0).cast("int")).over(upto))
        .select(*PLACE, "run")
    )
    placed = chunks.join(places, list(PLACE), "left")
    part = F.struct("block", "statement", "value")
    mended = placed.filter("run IS NOT NULL").groupBy("file_path", "run").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["value"]), separator).alias("value"),
        F.min(F.struct("block", "statement")).alias("at"),
    )
    return placed.filter("run IS NULL").select("value", *PLACE).unionByName(
        mended.select("value", "file_path", "at.block", "at.statement")
    )


def insert_tuples(statements: DataFrame) -> DataFrame:
    """One row per tuple after each ``VALUES``: ``fields`` as text, NULL as null.

    A text may hold several statements. Quoted text may hold doubled quotes, commas,
    parentheses, semicolons and line ends; column lists are no tuples.
    """
    lists = F.regexp_extract_all("value", F.lit(TUPLES), F.lit(1))
    found = F.flatten(F.transform(lists, lambda x: F.regexp_extract_all(x, F.lit(TUPLE), F.lit(0))))
    keep = [c for c in statements.columns if c != "value"]
    rows = statements.select(*keep, F.posexplode(found).alias("position", "t"))
    fields = F.transform(
        F.regexp_extract_all("t", F.lit(FIELD), F.lit(0)), lambda v: _unquote(F.trim(v))
    )
    return rows.select(*keep, "position", fields.alias("fields"))


def _unquote(v: Column) -> Column:
    inner = F.replace(F.regexp_replace(v, r"(?s)^'(.*)'$", "$1"), F.lit("''"), F.lit("'"))
    return F.when(F.startswith(v, F.lit("'")), inner).when(F.upper(v) == "NULL", F.lit(None)).otherwise(v)


def pairs(tuples: DataFrame, first: str, second: str) -> DataFrame:
    return tuples.select(
        "position", F.get("fields", F.lit(0)).alias(first), F.get("fields", F.lit(1)).alias(second)
    )


def read_admin(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """All admin rows of a dump; codes stay text."""
    return classify(pairs(insert_tuples(read_statements(spark, path, pattern=pattern)), "code", "name"))


def _latest(spark: SparkSession, path: str, first: str, second: str, pattern: str) -> DataFrame:
    rows = insert_tuples(read_statements(spark, path, pattern=pattern))
    placed = rows.select(
        F.get("fields", F.lit(0)).alias(first), F.get("fields", F.lit(1)).alias(second), *PLACE, "position"
    )
    return last_wins(placed, [first], [*PLACE, "position"]).select(first, second)


def read_units(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """One admin row per code, the last of the dump."""
    return classify(_latest(spark, path, "code", "name", pattern))


def read_postal(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """One postal code per village, the last of the dump."""
    return _latest(spark, path, "village_code", "postal_code", pattern)


def boundary_rows(tuples: DataFrame) -> DataFrame:
    """Boundary rows from tuples of at least five fields; the level comes from the folder.
    Rings are oriented, and invalid geometry carries repaired edges."""
    folder = F.regexp_extract("file_path", r"/boundaries/([^/]+)/", 1)
    level = F.create_map(*(F.lit(x) for kv in BOUNDARY_FOLDERS.items() for x in kv))[folder]

    def field(i: int) -> Column:
        return F.get("fields", F.lit(i))

    rows = tuples.filter(F.size("fields") >= 5).select(
        field(0).alias("code"),
        field(1).alias("name"),
        level.alias("level"),
        field(2).cast("double").alias("centroid_lat"),
        field(3).cast("double").alias("centroid_lng"),
        geo.coordinates_to_rings(field(4)).alias("rings"),
        F.lit("raw").alias("boundary_source"),
    )
    return rows


def with_shapes(rows: DataFrame) -> DataFrame:
    """Add valid, oriented rings, their directed edges and the extent to rows with ``rings``.

    Parsed rows are written first: they are read by every level's build, and the dump is
    parsed once. Invalid rings become the outline of their even-odd repair.
    """
    own = [c for c in rows.columns if c != "rings"]
    found = cut_lineage(cut_lineage(rows).withColumn("g", wkb.repair("rings")).select(*own, "g.rings", "g.valid"))
    return geometry.repaired(found).select(
        *own,
        "rings",
        geo.ring_edges(F.col("rings")).alias("edges"),
        geo.bounds(F.col("rings")).alias("extent"),
    )


def read_boundaries(spark: SparkSession, root: str, pattern: str = PATTERN) -> DataFrame:
    """All boundary dumps under ``root/boundaries/<folder>``, rows with other nesting of
    coordinates left to `rejected_boundaries`."""
    rows = boundary_rows(insert_tuples(read_statements(spark, f"{root}/boundaries", recursive=True, pattern=pattern)))
    return with_shapes(rows.filter(F.col("rings").isNotNull()))


def rejected_boundaries(spark: SparkSession, root: str) -> DataFrame:
    rows = boundary_rows(insert_tuples(read_statements(spark, f"{root}/boundaries", recursive=True)))
    return rows.filter(F.col("rings").isNull()).drop("rings")


def to_statements(
    df: DataFrame, table: str, columns: list[str], keys: tuple[str, ...] = (), per_statement: int = 500
) -> DataFrame:
    """Rows as insert statements of about ``per_statement`` rows, kept apart by ``keys``."""
    quoted = [
        F.coalesce(F.concat(F.lit("'"), F.replace(F.col(c).cast("string"), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))
        for c in columns
    ]
    row = F.concat(F.lit("("), F.concat_ws(",", *quoted), F.lit(")"))
    parts = df.sparkSession.sparkContext.defaultParallelism
    n = F.ceil(df.agg(F.count(F.lit(1)).alias("n")).scalar() / per_statement)
    bucket = F.pmod(F.xxhash64(*columns), F.greatest(n, F.lit(parts)))
    rows = df.select(*keys, row.alias("r"), bucket.alias("b"))
    grouped = rows.groupBy(*keys, "b").agg(F.collect_list("r").alias("rs"))
    head = f"INSERT INTO {table} ({', '.join(columns)}) VALUES "
    return grouped.select(*keys, F.concat(F.lit(head), F.array_join("rs", ",\n")).alias("value"))
