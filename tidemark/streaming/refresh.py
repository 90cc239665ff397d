"""Incremental day facts: new footprint files folded into the day table.

Counts, sums and maxima are associative, so each micro-batch contributes partial day rows
that are stored under its batch id and combined on reading. A batch that is run again
overwrites its own partition, which makes the sink idempotent. A ledger of the files folded,
known by the rows they hold, keeps a file that comes again under another name, or written
anew, from counting twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.facts import daily_facts
from tidemark.schemas import METRIC_FIELDS
from tidemark.session import work_path
from tidemark.sources.assets import folder_names, path_exists

PARTIAL = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("code", T.StringType()),
        *METRIC_FIELDS,
        T.StructField("batch", T.LongType()),
    ]
)


FILE = "_source_file"
CONTENTS = ["rows", "sum_a", "sum_b"]
LEDGER = "file string, rows long, sum_a decimal(30,0), sum_b decimal(30,0), batch long"


def start(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    to_bridge: Callable[[DataFrame], DataFrame],
    partials: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    ledger: str | None = None,
) -> StreamingQuery:
    """Process all files not seen yet and stop. ``to_bridge`` turns a batch of source rows
    into bridge rows, as `operators.overlap.overlap` does. With a folder for the ``ledger``
    files whose rows were folded before are left out."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        if ledger:
            batch = unseen(batch, batch_id, ledger)
        day = daily_facts(to_bridge(batch.drop(FILE)))
        day.write.mode("overwrite").parquet(f"{partials}/batch={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    if ledger:
        stream = stream.withColumn(FILE, F.col("_metadata.file_path"))
    return (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def file_contents(batch: DataFrame) -> DataFrame:
    """``file, rows, sum_a, sum_b`` of each file of a batch: how many rows and the sums of two
    hashes of each, the same in whatever order, cut or compression the rows were written."""
    columns = [(c, t) for c, t in batch.dtypes if c != FILE]
    own = [F.to_json(c) if t.startswith(("map", "variant")) else F.col(c) for c, t in columns]
    own += [F.col(c).isNull() for c, _ in columns]  # a hash passes over nulls
    sums = [F.sum(F.xxhash64(F.lit(s), *own).cast("decimal(20,0)")).alias(f"sum_{s}") for s in ("a", "b")]
    return batch.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def unseen(batch: DataFrame, batch_id: int, ledger: str) -> DataFrame:
    """The rows of files that no other batch has folded; of files alike in a batch the first by
    name counts.

    The batch's part of the ledger is written before its facts. If the batch is run again it
    writes both again, as it looks at the parts of earlier batches only.
    """
    spark = batch.sparkSession
    found = file_contents(batch).groupBy(*CONTENTS).agg(F.min("file").alias("file"))
    if path_exists(spark, ledger):
        known = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("batch") < batch_id)
        found = found.join(known.select(*CONTENTS), CONTENTS, "left_anti")
    found.select("file", *CONTENTS).write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")
    new = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("batch") == batch_id)
    # as many rows as files in the batch, bounded by files_per_batch
    return batch.join(F.broadcast(new.select(F.col("file").alias(FILE))), FILE, "left_semi")


def latest_base(spark: SparkSession, base: str) -> int | None:
    """Last batch folded into the newest whole table under ``base``."""
    names = [r["name"] for r in folder_names(spark, base).collect()]  # one per compaction kept
    upto = [int(n.removeprefix("upto=")) for n in names if path_exists(spark, f"{base}/{n}/_SUCCESS")]
    return max(upto, default=None)


def combined(spark: SparkSession, partials: str, base: str | None = None) -> DataFrame:
    """Day facts over all batches so far: the newest table under ``base`` and the batches after
    it, whose folders alone are read."""
    p = spark.read.schema(PARTIAL).parquet(partials)
    upto = latest_base(spark, base) if base else None
    if upto is not None:
        whole = spark.read.schema(PARTIAL).parquet(f"{base}/upto={upto}")
        p = p.filter(F.col("batch") > upto).unionByName(whole.withColumn("batch", F.lit(upto).cast("long")))
    return (
        p.groupBy("event_date", "level", "code")
        .agg(
            F.sum("unique_event_count").cast("long").alias("unique_event_count"),
            F.sum("sum_intersection_area_km2").alias("sum_intersection_area_km2"),
            F.max("max_coverage_ratio").alias("max_coverage_ratio"),
        )
        .withColumn("flood_days", F.lit(1).cast("long"))
    )


def compact(spark: SparkSession, partials: str, base: str) -> None:
    """Fold the batches so far into a new table under ``base``. Batches and older tables may be
    deleted once no reader uses them; a table that was not finished is never read."""
    upto = spark.read.schema(PARTIAL).parquet(partials).agg(F.max("batch").alias("n")).first()["n"]
    if upto is not None and upto != latest_base(spark, base):
        combined(spark, partials, base).write.mode("overwrite").parquet(f"{base}/upto={upto}")


def prune(spark: SparkSession, partials: str, base: str) -> list[str]:
    """Delete the tables under ``base`` before the newest, and the batches folded into it;
    readers of older tables must be done. Returns what was deleted."""
    upto = latest_base(spark, base)
    if upto is None:
        return []
    names = [f"{base}/{r['name']}" for r in folder_names(spark, base).collect() if r["name"] != f"upto={upto}"]
    folders = (r["name"] for r in folder_names(spark, partials).collect())  # one per batch kept
    names += [f"{partials}/{n}" for n in folders if n.startswith("batch=") and int(n.removeprefix("batch=")) <= upto]
    for name in names:
        p = spark._jvm.org.apache.hadoop.fs.Path(name)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return names


def deliver_again(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    """Put a copy of every file of a folder beside it under another name, and all rows of the
    first file once more in another order and compression."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsc.hadoopConfiguration()
    fs = p.getFileSystem(conf)
    files = sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet"))
    for f in files:
        old = spark._jvm.org.apache.hadoop.fs.Path(f)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, old, fs, spark._jvm.org.apache.hadoop.fs.Path(p, f"again-{old.getName()}"), False, conf)
    rows = spark.read.schema(schema).parquet(files[0])
    rows.coalesce(1).sortWithinPartitions(F.xxhash64(rows.columns[0])).write.mode("append").option("compression", "gzip").parquet(folder)


def replay(
    spark: SparkSession, rows: DataFrame, to_bridge: Callable[[DataFrame], DataFrame], again: bool = False
) -> DataFrame:
    """Feed rows through the stream in two parts of several files, with a compaction between
    them, and read the combined facts. With ``again`` the first part is delivered a second
    time, and what the compaction has folded is pruned."""
    root = work_path(spark, "refresh")
    rows.write.parquet(f"{root}/all")
    whole = spark.read.schema(rows.schema).parquet(f"{root}/all")
    half = F.xxhash64(*(c for c, t in rows.dtypes if not t.startswith("map"))) % 2 == 0
    for n, part in enumerate((whole.filter(half), whole.filter(~half))):
        part.write.mode("append").parquet(f"{root}/in")
        start(
            spark, f"{root}/in", rows.schema, to_bridge, f"{root}/partials", f"{root}/state", files_per_batch=4,
            ledger=f"{root}/ledger" if again else None,
        ).awaitTermination()
        if not n:
            compact(spark, f"{root}/partials", f"{root}/base")
            if again:
                prune(spark, f"{root}/partials", f"{root}/base")
                deliver_again(spark, f"{root}/in", rows.schema)
    return combined(spark, f"{root}/partials", f"{root}/base")
