"""Reviewed report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import REPORT_COLUMNS
from tidemark.session import cut_lineage

# Name suffix of reviewed files; what precedes it is the slug.
SUFFIX = "_inputs.reviewed.csv"

#: A reviewed file, or a folder of its parts, in a path.
NAMED = r"([^/=]*)_inputs\.reviewed\.csv(?:/|$)"

# What a file without the column says.
DEFAULTS = {"admin_level": "regency"}


# Fields without quotes left open, each with its comma, and the rest of a value in quotes.
_FIELDS = '(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+'
_QUOTED = '[^"]*+(?:""[^"]*+)*+'
#: Lines that end inside quotes if they begin outside of them, and if they begin inside.
OPENS = f'\\A{_FIELDS}"{_QUOTED}\\z'
STAYS = f'\\A{_QUOTED}(?:\\z|"[^,]*+,{_FIELDS}"{_QUOTED}\\z)'


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``slug, file, place, first, record`` of all reviewed files: records with the line ends that
    their quotes hold, placed by the number of their first line among all files of the slug;
    ``first`` marks the header of a file.

    A reviewed file may be a folder of parts, each with its header. Files are cut into splits
    like any text. A line maps the state before it, inside quotes or not, to that after it: to
    one state whatever came before, to the same or to the other. So the state is the last one of
    the first kind, turned by the lines of the last kind that follow, and splits combine like
    lines. A value that begins with a quote and has no closing one reaches to the end of its file.
    """
    path = F.col("_metadata.file_path")
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(folder)
    lines = cut_lineage(
        text.where(path.rlike(NAMED)).select(
            F.regexp_extract(path, NAMED, 1).alias("slug"), path.alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"), "value",
        )
    )
    split, file = ["slug", "file", "block"], ["slug", "file"]
    by_line, by_split = Window.partitionBy(*split).orderBy("line"), Window.partitionBy(*file).orderBy("block")
    upto, past = (Window.unboundedPreceding, Window.currentRow), (Window.unboundedPreceding, -1)
    none = F.lit(0)

    nth = F.row_number().over(by_line) - 1
    clean = F.when(F.expr("block = 0 AND nth = 0"), F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    numbered = lines.withColumn("nth", nth).withColumn("value", clean)
    marked = numbered.withColumns({"opens": F.col("value").rlike(OPENS).cast("int"), "stays": F.col("value").rlike(STAYS).cast("int")})
    turned = marked.withColumn("turn", (F.sum(F.greatest(F.col("opens") - F.col("stays"), none)).over(by_line.rowsBetween(*upto)) % 2).cast("int"))
    set_ = turned.withColumn("set", F.when(F.col("opens") == F.col("stays"), F.col("opens").bitwiseXOR(F.col("turn"))))
    local = set_.select(
        *split, "line", "value", "nth", "set", "turn",
        F.last("set", ignorenulls=True).over(by_line.rowsBetween(*past)).alias("set_before"),
        F.coalesce(F.lag("turn").over(by_line), none).alias("turn_before"),
    )

    ends = local.groupBy(*split).agg(
        F.max_by("set", F.when(F.col("set").isNotNull(), F.col("line"))).alias("set"), F.max_by("turn", "line").alias("turn"), F.count(F.lit(1)).alias("lines")
    )
    summed = ends.withColumn("all", (F.sum("turn").over(by_split.rowsBetween(*upto)) % 2).cast("int"))
    known = summed.withColumn("known", F.col("set").bitwiseXOR(F.col("turn")).bitwiseXOR(F.col("all")))
    started = known.select(
        *split,
        F.coalesce(F.last("known", ignorenulls=True).over(by_split.rowsBetween(*past)), none)
        .bitwiseXOR(F.coalesce(F.lag("all").over(by_split), none)).alias("inside"),
        F.coalesce(F.sum("lines").over(Window.partitionBy("slug").orderBy("file", "block").rowsBetween(*past)), none).alias("base"),
    ).withColumn("head", F.min("base").over(Window.partitionBy(*file)))

    state = F.coalesce("set_before", "inside").bitwiseXOR(F.col("turn_before"))
    at = F.col("base") + F.col("nth")
    placed = local.join(started, split).select(*split, "line", "value", "head", at.alias("at"), F.when(state == 0, at).alias("begin"))
    carried = placed.groupBy(*split).agg(F.max("begin").alias("begin")).select(
        *split, F.max("begin").over(by_split.rowsBetween(*past)).alias("open")
    )
    own = placed.withColumn("begin", F.max("begin").over(by_line.rowsBetween(*upto)))
    whole = own.join(carried, split).withColumn("place", F.coalesce("begin", "open")).groupBy(*file, "place").agg(
        F.max(F.col("place") == F.col("head")).alias("first"), F.sort_array(F.collect_list(F.struct("at", "value"))).alias("v")
    )
    record = F.regexp_replace(F.array_join("v.value", "\n"), "\r\\z", "")
    return whole.select(*file, "place", "first", record.alias("record"))


def _parsed(record: DataFrame, width: int) -> DataFrame:
    """``record`` as the array ``fields``, as far as it has any, with nulls for empty ones."""
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(width)])
    row = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {"escape": '"', "multiLine": "true", "maxColumns": str(width + 1)})
    return record.withColumn("_r", row).withColumn("fields", F.array(*(F.col(f"_r._{i}") for i in range(width)))).drop("_r", "record")


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all reviewed files with ``slug`` and ``source_row``, the number of a row's first
    line among the files of its slug in the order of their names.

    Each file names its own columns, in any order; of a name that repeats the last column
    counts. Two unnamed trailing values fill an empty time window. Empty lines are no rows.
    """
    records = cut_lineage(read_records(spark, folder).where("record != ''"))
    commas = F.length("record") - F.length(F.replace("record", F.lit(","), F.lit("")))
    width = records.where("first").agg(F.max(commas)).first()[0]
    if width is None:
        empty = T.StructType([T.StructField(n, T.StringType()) for n in ("slug", *REPORT_COLUMNS)])
        return spark.createDataFrame([], empty).withColumn("source_row", F.lit(0).cast("long"))
    last = F.array_max(F.transform("fields", lambda n, i: F.when(n.isNotNull(), i + 1)))
    heads = _parsed(records.where("first"), width + 1).select(
        "slug", "file", F.transform(F.slice("fields", 1, last), lambda n: F.trim(F.coalesce(n, F.lit("")))).alias("names")
    )
    rows = _parsed(records.where("NOT first"), width + 3).join(heads, ["slug", "file"])

    def value(name: str):
        back = F.array_position(F.reverse("names"), F.lit(name))
        found = F.get("fields", (F.size("names") - back).cast("int"))
        return F.when(back > 0, found).otherwise(F.lit(DEFAULTS.get(name, ""))).alias(name)

    tails = (F.get("fields", F.size("names") + i).alias(f"_tail{i}") for i in (0, 1))
    return fill_window(rows.select(*(value(n) for n in REPORT_COLUMNS), *tails, "slug", F.col("place").alias("source_row")))


def fill_window(rows: DataFrame) -> DataFrame:
    def filled(name: str, tail: str):
        return F.coalesce(F.nullif(name, F.lit("")), F.col(tail)).alias(name)

    return rows.withColumn("time_window_start", filled("time_window_start", "_tail0")).withColumn(
        "time_window_end", filled("time_window_end", "_tail1")
    ).drop("_tail0", "_tail1")


def report_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of all reviewed files, those without rows included."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    return files.where(F.col("path").rlike(NAMED)).select(F.regexp_extract("path", NAMED, 1).alias("slug")).distinct()
