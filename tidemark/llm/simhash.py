"""SimHash near-duplicates by exact comparison of fingerprint tiles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, utf8, word_bounds
from tidemark.llm.near_dup import components
from tidemark.session import cut_lineage

WORDS, SEED, RADIUS = 3, 42, 2
#: Fingerprints in a tile, and comparisons expected for one fingerprint before tiles get finer.
TILE, COMPARED = 2048, 4096
#: Words hashed at once, so that a long text needs little beside itself.
AT_ONCE = 1 << 15


def fingerprint(data: bytes) -> int:
    """64 bits of a UTF-8 text: a bit is set if more than half the shingle hashes set it.

    Shingles are runs of ``WORDS`` lower-cased words with repeats, joined by single blanks; a
    shorter text is one shingle, a text without words has fingerprint 0.
    """
    data = data.lower()
    _, starts, ends = word_bounds(data)
    if not len(starts):
        return 0
    k = min(WORDS, len(starts))
    total = len(starts) - k + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, AT_ONCE):
        last = min(at + AT_ONCE, total) + k - 2
        words = data[starts[at] : ends[last]].split()
        line = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        close = np.cumsum(sizes + 1) - 1
        opens = close - sizes
        digest = xxhash.xxh64_intdigest
        found = [digest(line[a:b], SEED) for a, b in zip(opens.tolist(), close[k - 1 :].tolist())]
        bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (``fp``, its 64 bits as a long) of every row; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def meeting_chance(parts: int, radius: int = RADIUS) -> float:
    """Share of random pairs of fingerprints whose set bits, counted in each of ``parts`` equal
    parts, differ by ``radius`` at most in all."""
    width = 64 // parts
    ways = [math.comb(2 * width, width + d) / 4**width for d in range(radius + 1)]
    reach = [1.0] + [0.0] * radius
    for _ in range(parts):
        reach = [sum(reach[r - d] * ways[d] * (2 if d else 1) for d in range(r + 1)) for r in range(radius + 1)]
    return sum(reach)


def parts_for(n: int, radius: int = RADIUS) -> int:
    """The coarsest cut at which a fingerprint meets at most ``COMPARED`` random others; the
    finest cut keeps that up to about 10**10 fingerprints."""
    return next((p for p in (1, 2, 4, 8) if n * meeting_chance(p, radius) <= COMPARED), 16)


def _bits(parts: int, radius: int) -> int:
    """Bits for one part's count, so wide that a count moved below 0 or above the part's width
    by ``radius`` at most is no count of any fingerprint."""
    return (64 // parts + 2 * radius).bit_length()


def tile_key(fp: Column, parts: int, radius: int = RADIUS) -> Column:
    """Set bits in each part of a fingerprint, side by side in one long."""
    width = 64 // parts
    mask = F.lit(-1 if width == 64 else (1 << width) - 1).cast("long")
    counts = (F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(mask)).cast("long") for i in range(parts))
    step = _bits(parts, radius)
    return sum((F.shiftleft(c, i * step) for i, c in enumerate(counts)), F.lit(0).cast("long"))


def key_steps(parts: int, radius: int = RADIUS) -> list[int]:
    """What to add to a key for the keys within ``radius``: zero, and one of each step and its opposite."""
    step = _bits(parts, radius)
    found = {0}

    def grow(at: int, left: int, value: int) -> None:
        if at == parts:
            if value > 0:
                found.add(value)
            return
        for d in range(-left, left + 1):
            grow(at + 1, left - abs(d), value + (d << (at * step)))

    grow(0, radius, 0)
    return sorted(found)


def tiles(distinct: DataFrame, parts: int, radius: int = RADIUS) -> DataFrame:
    """Tiles of at most ``TILE`` fingerprints of one key: key, tile, fps (64-bit numbers).

    Fingerprints are dealt by ranges of (key, fingerprint), so a crowded key fills many tiles of
    several tasks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, count = None, [], 0

        def tile() -> pa.RecordBatch:
            fps = np.concatenate(held)
            return pa.RecordBatch.from_pydict(
                {"key": pa.array([key], pa.int64()), "tile": pa.array([int(fps[0])], pa.int64()), "fps": pa.array([fps.tobytes()], pa.binary())}
            )

        for batch in batches:
            keys, fps = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if keys[a] != key:
                    if held:
                        yield tile()
                    key, held, count = int(keys[a]), [], 0
                while a < b:
                    if count == TILE:
                        yield tile()
                        held, count = [], 0
                    take = min(b - a, TILE - count)
                    held.append(fps[a : a + take])
                    a, count = a + take, count + take
        if held:
            yield tile()

    keyed = distinct.select(tile_key(F.col("fp"), parts, radius).alias("key"), "fp")
    dealt = keyed.repartitionByRange(partitions(distinct.sparkSession), "key", "fp").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(cut, "key long, tile long, fps binary")


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of two tiles that differ in ``radius`` bits at most."""
    left, right = [], []
    step = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius)
        left.append(i + at)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def forest(nodes: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what (u, v) connect, one less than the nodes of each connected part."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            moved = np.flatnonzero(label != np.arange(nodes))
            return moved, label[moved]
        label = new


def links(distinct: DataFrame, radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all pairs within ``radius`` bits.

    Fingerprints are cut into tiles by how many bits are set in each of ``parts`` equal parts
    (one part: their population counts; by default more parts as ``distinct`` grows). Each bit
    that differs changes one count by one, so tiles whose counts differ beyond the radius hold
    no pair and are never joined. All pairs of the other tiles are compared. A pair of tiles
    gives a spanning forest of its close pairs, at most one edge a fingerprint.
    """
    parts = parts or parts_for(distinct.count(), radius)
    cut = cut_lineage(tiles(distinct, parts, radius))
    steps = F.array(*(F.lit(s).cast("long") for s in key_steps(parts, radius)))
    moved = cut.select(F.col("key").alias("_own"), F.col("tile").alias("x"), F.col("fps").alias("xs"), F.explode(steps).alias("_step"))
    left = moved.select((F.col("_own") + F.col("_step")).alias("key"), "_step", "x", "xs")
    right = cut.select("key", F.col("tile").alias("y"), F.col("fps").alias("ys"))
    pairs = left.join(right, "key").where((F.col("_step") != 0) | (F.col("x") <= F.col("y"))).select("xs", "ys")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = [np.zeros((2, 0), np.uint64)]
            for xs, ys in zip(batch.column("xs").to_pylist(), batch.column("ys").to_pylist()):
                a, b = np.frombuffer(xs, np.uint64), np.frombuffer(ys, np.uint64)
                i, j = close_pairs(a, b, radius)
                apart = a[i] != b[j]
                if not apart.any():
                    continue
                i, j = i[apart], j[apart]
                nodes, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
                u, v = forest(len(nodes), at[: len(i)], at[len(i) :])
                out.append(np.array([nodes[u], nodes[v]]))
            edges = np.concatenate(out, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1])], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """Every document with its fingerprint and group: doc_id, fingerprint, component_id.

    Documents whose fingerprints differ in ``radius`` bits at most are linked; component_id is
    the smallest id that links reach. Null, empty and blank texts have fingerprint 0 and are
    linked like any other. Repeated rows have a row each; a null id has one too and names a group
    only if all its ids are null. Other columns are ignored, an empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("id")))
    labels = components(cut_lineage(links(distinct.select("fp"), radius, parts)))
    placed = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "id", F.coalesce("comp", "fp").alias("comp"))
    groups = placed.groupBy("comp").agg(F.min("id").alias("component_id"))
    named = cut_lineage(placed.join(groups, "comp").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
