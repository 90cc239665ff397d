"""Exact top-k search over a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import partitions
from tidemark.session import cut_lineage, work_path

BLOCK = "dim int, wide boolean, ids array<long>, cells binary"
QUERY_BLOCK = "dim int, ids array<long>, vectors binary"
BOUND = "query_id long, vec_id long, low double, high double"
VECTORS = "vec_id long, v array<double>, wide boolean, _query boolean"

#: Vectors whose length times largest squared component stays below have inner products, among
#: each other, that fit in a long.
NARROW = 2.0**62
#: Whole numbers beyond count as this one, so that sums of them stay finite.
LARGEST = 2.0**480
#: Scores beyond a long count as its ends.
ENDS = (-(2**63), 2**63 - 1)


def whole_numbers(embedding: Column, scale: int = 1024) -> Column:
    """Components as floor(scale * x), exact as doubles; null for a vector that is null or holds
    null or non-finite components and for an empty one."""

    def floor(x: Column) -> Column:
        y = F.greatest(F.least(x.cast("double") * scale, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    finite = F.forall(
        embedding,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    return F.when(finite & (F.size(embedding) > 0), F.transform(embedding, floor))


def is_wide(v: Column) -> Column:
    largest = F.array_max(F.transform(v, F.abs))
    return F.size(v) * largest * largest >= NARROW


def _grids(vectors: DataFrame, bits: int) -> dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]:
    """Lower end and cell width per component, for each vector length, wide vectors apart so
    that they don't coarsen the cells of others; bounded by the number of components."""
    ends = (
        vectors.select(F.size("v").alias("dim"), "wide", F.posexplode("v"))
        .groupBy("dim", "wide", "pos")
        .agg(F.min("col").alias("low"), F.max("col").alias("high"))
        .orderBy("dim", "wide", "pos")
        .collect()
    )
    grids: dict[tuple[int, bool], list[tuple[float, float]]] = {}
    for r in ends:
        width = (int(r.high) - int(r.low)) // (1 << bits) + 1
        grids.setdefault((r.dim, r.wide), []).append((r.low, float(width)))
    return {d: (np.array([x for x, _ in g]), np.array([w for _, w in g])) for d, g in grids.items()}


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_length(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Ids and matrix of at most ``rows`` vectors of one length, all wide or none."""
    for batch in batches:
        kinds = 2 * np.array(batch.column("dim")) + np.array(batch.column("wide"))
        for kind in np.unique(kinds):
            part = batch.filter(pa.array(kinds == kind))
            for at in range(0, len(part), rows):
                cut = part.slice(at, rows)
                yield np.array(cut.column("vec_id")), _matrix(cut.column("v")), bool(kind % 2)


def approximations(vectors: DataFrame, grids: dict, k: int, rows: int = 4096) -> DataFrame:
    """Blocks of quantised vectors, one byte per component.

    Of vectors alike in all components a block keeps the k + 1 smallest ids: no query can
    need more of them, as ties go to the smaller id and a query leaves out itself only.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, m, wide in _by_length(batches, rows):
            order = np.argsort(ids, kind="stable")
            ids, m = ids[order], m[order]
            _, group = np.unique(m, axis=0, return_inverse=True)
            group = group.ravel()
            by = np.argsort(group, kind="stable")
            first = np.r_[True, np.diff(group[by]) > 0]
            nth = np.arange(len(by)) - np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
            keep = np.sort(by[nth <= k])
            low, width = grids[m.shape[1], wide]
            cells = np.minimum((m[keep] - low) // width, 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([m.shape[1]], pa.int32()),
                    "wide": [wide],
                    "ids": pa.array([ids[keep]], pa.list_(pa.int64())),
                    "cells": pa.array([cells.tobytes()], pa.binary()),
                }
            )

    return vectors.select("vec_id", F.size("v").alias("dim"), "wide", "v").mapInArrow(pack, BLOCK)


def query_blocks(queries: DataFrame, rows: int = 512) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, m, _ in _by_length(batches, rows):
            yield pa.RecordBatch.from_pydict(
                {"dim": pa.array([m.shape[1]], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())), "vectors": pa.array([m.tobytes()], pa.binary())}
            )

    return queries.select("vec_id", F.size("v").alias("dim"), "wide", "v").mapInArrow(pack, QUERY_BLOCK)


def _bounds(pairs: DataFrame, grids: dict, k: int, held: int = 1 << 18) -> DataFrame:
    """Score bounds of the vectors that may be among the k best of a query.

    The cells of each vector block are scanned for a query block. A merge join hands a task all
    vector blocks of a lane for one query block after another, so the k best lower bounds of each
    query run on from block to block: a vector stays if its upper bound reaches the k-th of
    them. What stays waits, about ``held`` vectors at most, until the floors of the lane are known.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, floors, waiting = None, None, []

        def settled() -> tuple[np.ndarray, ...]:
            row, *rest = (np.concatenate(c) for c in zip(*waiting))
            stays = rest[2] >= floors[row, 0]
            return row[stays], *(c[stays] for c in rest)

        def written(q_ids: np.ndarray) -> pa.RecordBatch:
            row, ids, low, high = settled()
            return pa.RecordBatch.from_pydict({"query_id": q_ids[row], "vec_id": ids, "low": low, "high": high})

        for batch in batches:
            for r in batch.to_pylist():
                if block is None or (r["q_ids"], r["vectors"]) != (block["q_ids"], block["vectors"]):
                    if waiting:
                        yield written(np.array(block["q_ids"]))
                    # the first column holds the k-th best of each query
                    block, floors, waiting = r, np.full((len(r["q_ids"]), k), -np.inf), []
                low, width = grids[r["dim"], r["wide"]]
                q_ids, ids = np.array(r["q_ids"]), np.array(r["ids"])
                q = np.frombuffer(r["vectors"]).reshape(len(q_ids), -1)
                cells = np.frombuffer(r["cells"], np.uint8).reshape(len(ids), -1).astype(np.float64)
                step = q * width
                base = (q @ low)[:, None] + step @ cells.T
                # a cell holds width whole numbers, so a component is at most width - 1 above its lower end
                span = q * (width - 1)
                slack = 1e-9 * (1 + np.abs(q) @ (np.abs(low) + 256 * width))
                at_least = np.clip(base + (np.minimum(span, 0).sum(1) - slack)[:, None], *map(float, ENDS))
                at_most = np.clip(base + (np.maximum(span, 0).sum(1) + slack)[:, None], *map(float, ENDS))
                own = q_ids[:, None] == ids[None, :]
                at_least[own] = -np.inf
                floors = np.partition(np.concatenate([floors, at_least], axis=1), -k, axis=1)[:, -k:]
                row, col = np.nonzero((at_most >= floors[:, :1]) & ~own)
                waiting.append((row, ids[col], at_least[row, col], at_most[row, col]))
                if sum(len(w[0]) for w in waiting) > held:
                    waiting = [settled()]
                    if len(waiting[0][0]) > held // 2:
                        yield written(q_ids)
                        waiting = []
        if waiting:
            yield written(np.array(block["q_ids"]))

    return pairs.mapInArrow(scan, BOUND)


def _exact(candidates: DataFrame, vectors: DataFrame) -> DataFrame:
    """Inner product of each candidate pair, from the exact vectors."""
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("v").alias("_q"), F.col("wide").alias("_qw"))
    pairs = candidates.join(vectors, "vec_id").join(queries, "query_id")
    wide = F.col("wide") | F.col("_qw")
    product = F.aggregate(
        F.zip_with("_q", "v", lambda a, b: a.cast("long") * b.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x
    )
    exact = F.pandas_udf(_wide_product, T.LongType())(F.when(wide, F.col("_q")), F.when(wide, F.col("v")))
    return pairs.select("query_id", "vec_id", F.when(wide, exact).otherwise(product).alias("score"))


def _wide_product(a: pd.Series, b: pd.Series) -> pd.Series:
    """Products of vectors whose sums need not fit in a long; null pairs cost nothing."""

    def product(u: np.ndarray, v: np.ndarray) -> int:
        return max(ENDS[0], min(ENDS[1], sum(int(x) * int(y) for x, y in zip(u, v))))

    return pd.Series([None if u is None else product(u, v) for u, v in zip(a, b)], dtype="Int64")


def top_k(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    bits: int = 8,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k rows of highest inner product for each query row: query_id, rank, vec_id, score.

    Vectors become whole numbers, then cells of ``2**bits`` steps per component (at most 8
    bits). Each query block meets each block of cells once; a lane of blocks yields little more
    than the k best bounds of each query. The 2k best by
    bound are read exactly first; their k-th score closes the search for all candidates whose
    upper bound lies below it, and the rest are read. Ties go to the smaller id.

    Null ids, null vectors and vectors with null or non-finite components take no part, nor do
    empty ones. Scores are exact; one beyond a long counts as the end of the range of a long, and
    whole numbers beyond 2**480 count as 2**480. Vectors of different length do not meet. If an id repeats, its smallest vector
    (component by component) counts. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    kept = embeddings.select(
        F.col(key).cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("v"), is_query.alias("_query")
    ).where("vec_id is not null and v is not null")
    path = work_path(spark, "vectors")
    once = kept.groupBy("vec_id").agg(F.min(F.struct("v", "_query")).alias("r"))
    once.select("vec_id", "r.v", is_wide(F.col("r.v")).alias("wide"), "r._query").write.parquet(path)
    rows = spark.read.schema(VECTORS).parquet(path)
    vectors, queries = rows.drop("_query"), rows.where("_query").drop("_query")
    grids = _grids(vectors, bits)
    n = partitions(spark)
    cells = cut_lineage(approximations(vectors, grids, k)).withColumn("_lane", F.pmod(F.xxhash64("ids"), F.lit(n)))
    lanes = (
        query_blocks(queries)
        .withColumnRenamed("ids", "q_ids")
        .withColumn("_lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    )
    # merged, so that the blocks of a lane follow each other for each query block
    bounds = cut_lineage(_bounds(lanes.join(cells.hint("merge"), ["_lane", "dim"]), grids, k))

    low = Window.partitionBy("query_id").orderBy(F.col("low").desc(), "vec_id")
    high = Window.partitionBy("query_id").orderBy(F.col("high").desc(), "vec_id")
    floors = bounds.withColumn("_n", F.row_number().over(low)).where(F.col("_n") == k).select("query_id", F.col("low").alias("_floor"))
    open_ = (
        bounds.join(floors, "query_id", "left")
        .where("_floor is null or high >= _floor")
        .withColumn("_n", F.row_number().over(high))
    )
    first = cut_lineage(_exact(open_.where(F.col("_n") <= 2 * k).select("query_id", "vec_id"), vectors))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), "vec_id")
    closed = first.withColumn("_n", F.row_number().over(best)).where(F.col("_n") == k).select("query_id", F.col("score").alias("_kth"))
    rest = open_.where(F.col("_n") > 2 * k).join(closed, "query_id", "left").where("_kth is null or high >= _kth")
    scored = first.unionByName(_exact(rest.select("query_id", "vec_id"), vectors))
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
