"""Near-duplicate classes by order MinHash and banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix, shingles, utf8, word_hashes
from tidemark.session import cut_lineage

K = 5
LEAST = 0.8
#: Labelled k-mers sampled by a sketch in one order and in another, and sketches.
SAMPLED, SAMPLED_OTHER, SKETCHES = 6, 3, 56
#: Pairs whose smaller text has fewer k-mers than ``LONG`` meet in sketches of
#: ``SAMPLED_SHORT`` of them, pairs whose smaller text has at most ``TINY`` as one set and the same
#: set with one k-mer left out: with a similarity of 0.8 they can't differ by more.
LONG, SAMPLED_SHORT, TINY = 64, 6, 7
#: Words of 64 bits in a signature, and the bits in which two with similarity 0.8 may differ:
#: one bit differs with chance 0.1, so 2048 bits exceed 252 with chance 0.0003.
LONGS, DIFFER = 32, 252
#: Tells a k-mer's occurrences apart.
_LABEL = np.uint64(0xD6E8_FEB8_6659_FD93)
#: Turns one order of hashes into another.
_OTHER = np.uint64(0xA5C3_96E1_5B2D_784F)


def _keys(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


def _hashed(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """An order of well-mixed values for each odd key."""
    return values[None, :] * keys[:, None]


def sketch(distinct: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One bucket per key: the smallest labelled k-mers under the key, in text order, as one hash.

    ``SAMPLED`` of the smallest come from one order and ``SAMPLED_OTHER`` from another. A text
    with fewer gives all it has.
    """
    if not len(distinct):
        return np.zeros(0, np.int64)
    mixed = mix(distinct)
    out = np.empty(len(keys), np.uint64)
    step = max(1, (1 << 17) // len(distinct))
    for at in range(0, len(keys), step):
        h = _hashed(mixed, keys[at : at + step])
        picks = []
        for rows, n in ((h, SAMPLED), (h ^ _OTHER, SAMPLED_OTHER)):
            if rows.shape[1] > n:
                picks.append(np.argpartition(rows, n - 1, axis=1)[:, :n])
            else:
                picks.append(np.broadcast_to(np.arange(len(mixed)), rows.shape))
        places = np.sort(np.concatenate(picks, axis=1), axis=1)
        total = keys[at : at + step].copy()
        for column in mixed[places].T:
            total = total * np.uint64(0x9E3779B97F4A7C15) + column
        out[at : at + step] = mix(total)
    return out.view(np.int64)


def short_sketch(distinct: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One bucket per key: ``SAMPLED_SHORT`` smallest labelled k-mers under the key, in text order."""
    h = _hashed(mix(distinct), keys)
    places = np.sort(np.argpartition(h, SAMPLED_SHORT - 1, axis=1)[:, :SAMPLED_SHORT], axis=1)
    total = keys ^ _OTHER
    for column in distinct[places].T:
        total = total * np.uint64(0x9E3779B97F4A7C15) + column
    return mix(total).view(np.int64)


def whole_key(distinct: np.ndarray) -> int:
    """All labelled k-mers in text order as one hash."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(distinct.tobytes()), np.int64)[0])


def less_keys(distinct: np.ndarray) -> list[int]:
    """``whole_key`` of the k-mers without each one of them."""
    return [whole_key(np.delete(distinct, i)) for i in range(len(distinct))]


def buckets(words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, int | None, list[int]]:
    """Buckets of a text, its ``whole_key`` if it is tiny, and its ``less_keys`` if a tiny text may
    be alike. A text is in the sketches of every length that a text alike may have."""
    distinct = labelled(words)
    n = len(distinct)
    least = math.ceil(LEAST * n - 1e-9)
    found, whole = [], None
    if 0 < n <= TINY:
        whole = whole_key(distinct)
        found.append(np.array([whole], np.int64))
    if n > TINY and least < LONG:
        found.append(short_sketch(distinct, keys))
    if n >= LONG:
        found.append(sketch(distinct, keys))
    less = less_keys(distinct) if n > 1 and least <= TINY and n - 1 >= LEAST * n - 1e-9 else []
    return np.concatenate([np.zeros(0, np.int64), *found]), whole, less


def labelled(words: np.ndarray) -> np.ndarray:
    """The k-mers of a text in its order, each with which occurrence of its kind it is: the
    first keeps its hash, so that no two are alike."""
    grams = shingles(words, K)
    order = np.argsort(grams, kind="stable")
    new = np.ones(len(grams), bool)
    new[1:] = grams[order][1:] != grams[order][:-1]
    place = np.arange(len(grams))
    nth = np.empty(len(grams), np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.where(nth > 0, mix(grams + nth * _LABEL), grams)


def signature(distinct: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One bit of each of 64 * LONGS minima."""
    if not len(distinct):
        return np.zeros(LONGS, np.int64)
    step = max(1, (1 << 17) // len(distinct))
    low = np.concatenate([_hashed(distinct, keys[at : at + step]).min(axis=1) for at in range(0, len(keys), step)])
    return np.packbits((low >> np.uint64(9) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def alignment(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """Similarity of two sequences of labelled k-mers: aligned / (both - aligned).

    ``least`` bounds how many k-mers may stay unaligned, hence how far apart the places of an
    aligned pair may lie. Labels make symbols distinct, so the best alignment within that band is the
    longest run of rising places among shared symbols. Returns 0 once ``least`` is out of reach.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    total = len(a) + len(b)
    need = least / (1 + least) * total
    _, pa_, pb = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(pa_) < need - 1e-9:
        return 0.0
    near = np.abs(pa_ - pb) <= total - 2 * need + 1e-9
    order = np.argsort(pa_[near])
    places = pb[near][order]
    if (np.diff(places) > 0).all():
        aligned = len(places)
    else:
        from bisect import bisect_left

        tails: list[int] = []
        for p in places.tolist():
            i = bisect_left(tails, p)
            tails[i : i + 1] = [p]
        aligned = len(tails)
    return aligned / (total - aligned)


def _node(words: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(words.tobytes())


def _sketched(docs: DataFrame) -> DataFrame:
    keys = _keys(SKETCHES, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, found = [], []
            for text in utf8(batch.column("text")):
                words = word_hashes(text)
                nodes.append(_node(words))
                found.append(buckets(words, keys))
            some, whole, less = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(some, pa.list_(pa.int64())), pa.array(whole, pa.int64()), pa.array(less, pa.list_(pa.int64()))],
                names=["doc_id", "node", "buckets", "whole", "less"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, node binary, buckets array<long>, whole long, less array<long>")


_SIGNATURE = [f"s{i}" for i in range(LONGS)]


def _described(rows: DataFrame) -> DataFrame:
    """Node, word hashes of 32 bits, number of k-mers and signature of each text."""
    keys = _keys(64 * LONGS, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_hashes(t).astype(np.uint32) for t in utf8(batch.column("text"))]
            distinct = [labelled(w.astype(np.uint64)) for w in words]
            bits = np.array([signature(d, keys) for d in distinct], np.int64).reshape(-1, LONGS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([w.tobytes() for w in words], pa.binary()), pa.array([len(d) for d in distinct], pa.int32()), *(pa.array(c) for c in bits.T)],
                names=["node", "words", "n", *_SIGNATURE],
            )

    longs = ", ".join(f"{s} long" for s in _SIGNATURE)
    return rows.select("node", "text").mapInArrow(run, f"node binary, words binary, n int, {longs}")


def _alike(a: str, b: str, least: float) -> Column:
    """Sizes and signatures leave the similarity possible."""
    bits = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in _SIGNATURE))
    small, large = F.least(F.col(f"{a}.n"), F.col(f"{b}.n")), F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))
    return (small >= large * least) & (bits <= DIFFER)


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose alignment reaches ``least``."""
    words = texts.select("node", "words")
    both = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a").join(
        words.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                alignment(*(labelled(np.frombuffer(w, np.uint32).astype(np.uint64)) for w in pair), least) >= least
                for pair in zip(batch.column("wa").to_pylist(), batch.column("wb").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "wa", "wb").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of the connected component of each node in ``edges`` (a, b).

    Every round takes the smallest label among neighbours, then the label of that label, and is
    written; rounds end when no label changes.
    """
    both = cut_lineage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")))
    while True:
        seen = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("comp").alias("near"))
            .select(F.col("a").alias("node"), "near")
        )
        lower = labels.join(seen, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        above = labels.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        new = cut_lineage(lower.join(above, "comp", "left").select("node", "old", F.least("comp", F.coalesce("top", "comp")).alias("comp")))
        changed = new.where("comp <> old").limit(1).count()
        labels = new.select("node", "comp")
        if not changed:
            return labels


def _tiny_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of a tiny text and one with a single k-mer more. Of tiny texts with the same
    k-mers one stands for all, as these share a bucket."""
    whole = nodes.where("whole is not null").groupBy("whole").agg(F.min("node").alias("x"))
    less = nodes.select(F.col("node").alias("y"), F.explode("less").alias("whole"))
    pairs = less.join(whole, "whole").where("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _links(entries: DataFrame, tiny: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Verified links that join all texts which any bucket brings together.

    First every text meets the head of each of its buckets, the text with the most company over
    all buckets: an original among its copies. Then buckets whose texts are not all connected
    yet pair each text outside the largest part with all texts of other parts, so that no
    candidate is skipped. Two texts meet in the smallest bucket they share, once. The pairs
    ``tiny`` are verified unscreened.
    """
    facts = texts.select("node", "n", *_SIGNATURE)
    company = entries.groupBy("node").agg(F.sum("size").alias("company"))
    first = Window.partitionBy("bucket").orderBy(F.col("company").desc(), "node")
    stars = cut_lineage(
        entries.join(company, "node")
        .withColumn("head", F.first("node").over(first.rowsBetween(Window.unboundedPreceding, 0)))
        .where("node <> head")
        .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
        .distinct()
    )
    possible = (
        stars.join(facts.alias("x"), F.col("a") == F.col("x.node"))
        .join(facts.alias("y"), (F.col("b") == F.col("y.node")) & _alike("x", "y", least))
        .select("a", "b")
    )
    links = cut_lineage(_verified(possible.unionByName(tiny).distinct(), texts, least))
    labels = components(links)
    placed = entries.join(labels, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    parts = cut_lineage(placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size")))
    largest = (
        parts.groupBy("bucket")
        .agg(F.max(F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("bucket", F.col("top.comp").alias("main"))
    )
    unsettled = cut_lineage(placed.join(largest, "bucket"))
    shared = unsettled.groupBy("node").agg(F.collect_list("bucket").alias("all"))  # at most 2 * SKETCHES
    open_ = cut_lineage(unsettled.join(shared, "node").join(facts, "node"))
    outside = open_.where("comp <> main").alias("x")
    rest = (
        outside.join(
            open_.alias("y"),
            (F.col("x.bucket") == F.col("y.bucket"))
            & (F.col("x.comp") != F.col("y.comp"))
            & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
            & _alike("x", "y", least)
            & (F.array_min(F.array_intersect("x.all", "y.all")) == F.col("x.bucket")),
        )
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .join(stars, ["a", "b"], "left_anti")
    )
    return links.unionByName(_verified(rest, texts, least))


def _classes(docs: DataFrame, least: float) -> DataFrame:
    """doc_id and node of every document with the (doc_id, node) that stands for its class."""
    sketched = cut_lineage(_sketched(docs))
    nodes = cut_lineage(
        sketched.groupBy("node").agg(F.min("doc_id").alias("id"), F.first("buckets").alias("buckets"), F.first("whole").alias("whole"), F.first("less").alias("less"))
    )
    size = F.count(F.lit(1)).over(Window.partitionBy("bucket"))
    entries = cut_lineage(
        nodes.select("node", F.explode("buckets").alias("bucket")).withColumn("size", size).where("size > 1")
    )
    tiny = cut_lineage(_tiny_pairs(nodes))
    members = entries.select("node").unionByName(tiny.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    wanted = members.join(nodes.select("node", "id"), "node")
    texts = cut_lineage(
        _described(
            _noded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
                wanted.select(F.col("id").alias("_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"
            )).join(members, "node", "left_semi")
        ).dropDuplicates(["node"])
    )
    labels = components(_links(entries, tiny, texts, least))
    ranked = nodes.select("node", "id").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    heads = ranked.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("head"))
    placed = ranked.join(heads, "comp").select("node", F.col("head.id").alias("class_id"), F.col("head.node").alias("head"))
    return sketched.select("doc_id", "node").join(placed, "node")


def _noded(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the hash of their word sequence as ``node``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", node binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [_node(word_hashes(t)) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], names=[*batch.schema.names, "node"])

    return docs.mapInArrow(run, schema)


def classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The class of every document: doc_id, class_id, the smallest id of the class.

    Two texts are linked if their five-word k-mers, labelled by occurrence and in text order,
    align to a similarity of ``least`` or more; classes are connected links. Texts alike in their words are one text;
    a text of fewer than five words is one k-mer; null, empty and blank texts are alike. Repeated
    rows have a row each. A null id gets a class like others; the class id is null only if all
    of its ids are. An empty table gives an empty result.
    """
    return _classes(docs, least).select("doc_id", "class_id")


def representatives(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row of each class, that of its smallest id, with the columns of ``docs``."""
    kept = cut_lineage(_classes(docs, least).where("node = head").groupBy("node").agg(F.min("class_id").alias("_id")))
    # other names than the caller's columns have
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = _noded(plain.withColumn("text", F.col(names["text"])))
    chosen = rows.join(kept, (rows["node"] == kept["node"]) & F.col(names["doc_id"]).cast("long").eqNullSafe(kept["_id"]), "left_semi")
    return chosen.dropDuplicates(["node"]).select(*(F.col(names[c]).alias(c) for c in docs.columns))
