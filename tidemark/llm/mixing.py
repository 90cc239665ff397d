"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, word_count
from tidemark.session import cut_lineage


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, cap: int = 3) -> DataFrame:
    """Target of each row of ``sizes`` (source, source_size), one row per source.

    ``share`` times the sum of all sizes is dealt out by weight; weights repeat along the
    sources in code point order, null last. A target stops at ``cap`` times the source's
    size and the excess goes to the others by weight. With sources in the order in which
    they reach their cap, the level per weight after filling those before is known from
    prefix sums, and the first source that does not reach its cap fixes the level. The
    windows see one row per source.
    """
    ranked = sizes.withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
    filled = Window.orderBy("_reach", "_rank")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    return (
        ranked.withColumn("_cap", F.col("source_size") * cap)
        .withColumn("_reach", F.col("_cap") / F.col("_weight"))
        .withColumn(
            "_level",
            (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
            / (F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0))),
        )
        .withColumn("_final", F.max(F.when(F.col("_reach") > F.col("_level"), F.col("_level"))).over(every))
        .select(
            "source",
            "source_size",
            F.when(F.col("_reach") > F.col("_level"), F.least(F.col("_final") * F.col("_weight"), F.col("_cap").cast("double")))
            .otherwise(F.col("_cap").cast("double"))
            .alias("target"),
        )
    )


def sampled(rows: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, cap: int = 3) -> DataFrame:
    """Copies of each row of ``rows`` (doc_id, source, size).

    Every document of a source is expected ``target / source_size`` times. Rows are put in
    order of size and id, expected copies are summed along the source, and a row is emitted
    once per integer crossed after adding one offset drawn from the source's name. The order
    by size keeps the words taken near the target. Prefix sums come from range partitions:
    positions within a slice, offset by the rows of the slices before it, so a crowded source
    is spread over all tasks. Rows alike in all three columns are interchangeable. Null ids
    come first; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    order = [F.col("size"), F.col("doc_id").asc_nulls_first()]
    sliced = cut_lineage(
        rows.select("doc_id", "source", F.col("size").cast("long").alias("size"), _source_key().alias("_src"))
        .repartitionByRange(partitions(spark), "_src", *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    pieces = sliced.groupBy("_src", "_slice").agg(
        F.first("source").alias("source"), F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_size")
    )
    aims = targets(pieces.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, share, cap)
    before = Window.partitionBy("_src").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieces.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select("_src", "_slice", "_before")
        .join(aims.withColumn("_src", _source_key()).drop("source"), "_src")
    )
    local = F.row_number().over(Window.partitionBy("_src", "_slice").orderBy(*order))
    drawn = F.conv(F.substring(F.md5(F.coalesce("source", F.lit("")).cast("binary")), 1, 5), 16, 10).cast("int") / F.lit(2.0**20)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        sliced.withColumn("_local", local)
        .join(offsets, ["_src", "_slice"])
        .withColumn("_pos", F.col("_local") + F.col("_before"))
        .withColumn("_rate", rate)
        .withColumn("_offset", drawn)
        .withColumn(
            "copies",
            F.floor(F.col("_pos") * F.col("_rate") + F.col("_offset"))
            - F.floor((F.col("_pos") - 1) * F.col("_rate") + F.col("_offset")),
        )
        .select("doc_id", "source", "size", "source_size", "target", "copies")
    )


def mix_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, cap: int = 3) -> DataFrame:
    """Size, target and words taken of every document; size counts words, null text 0."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return sampled(rows, weights, share, cap).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, cap: int = 3) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, columns as given.

    Rows alike in id, source and word count share their copies.
    """
    # other names than the caller's columns have
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    key = [F.col(names[c]) for c in ("doc_id", "source")] + [word_count(F.col(names["text"]))]
    plain = docs.toDF(*names.values()).select("*", *(c.alias(a) for c, a in zip(key, ("doc_id", "source", "size"))))
    same = ["doc_id", "source", "size"]
    copies = sampled(plain.select(*same), weights, share, cap).where("copies > 0")
    picks = copies.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.col("copies").desc()))).alias("p")
    rows = plain.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64(names["text"])))).alias("r")
    meet = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*same, "nth")]
    return (
        rows.join(picks, reduce(lambda a, b: a & b, meet))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*(F.col(f"r.{n}").alias(c) for c, n in names.items()))
    )
