"""Rows in order, dealt over range partitions, so that a crowded group is many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions
from tidemark.session import cut_lineage


def sliced(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows, written, with the range partition (``_slice``) and the place in it (``_seq``).

    Slices follow each other in the order of ``keys``, then ``order``. Ends of it that tie are
    told apart by the row's place in the input, so a row repeated often is spread as well. Rows
    are written before their ranges are sampled, so that they are computed once.
    """
    by = [F.col(k) for k in keys] + list(order)
    dealt = (
        cut_lineage(rows.withColumn("_tie", F.monotonically_increasing_id()))
        .repartitionByRange(partitions(rows.sparkSession), *by, "_tie")
        .sortWithinPartitions(*by, "_tie")
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    return cut_lineage(dealt.drop("_tie"))


def positions(cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``sliced`` with their place in the group (``pos`` from 0) and its rows (``total``).

    A group's slices hold it without a break, so a place is the rows of the group's earlier
    slices and the distance from its first row in the slice. Keys must not be null.
    """
    parts = cut.groupBy(*keys, "_slice").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *keys, "_slice", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("total")
    )
    found = cut.join(starts, [*keys, "_slice"])
    return found.withColumn("pos", F.col("_before") + F.col("_seq") - F.col("_first")).drop("_before", "_first")
