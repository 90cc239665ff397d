"""First-fit decreasing packing of token pieces in randomised groups."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions
from tidemark.session import cut_lineage

SIZE = 2048
END_ID = 1
RANKS, WHOLE = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: A number drawn by hash from the whole document, the same for all of its pieces.
DRAWN = f"{PIECE}, draw long"
PLACED = f"{PIECE}, sequence_id long, offset long"

_encodings: dict[tuple[str, str], object] = {}


def markers(path: str) -> dict[str, int]:
    """Added tokens of the JSON form, which it finds in a text before all else."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that depend on their surroundings")
    return {t["content"]: t["id"] for t in added}


def encoding(path: str | None = None, whole: str | None = None):
    """The byte-level vocabulary in its rank form, read once per worker, with the markers of the
    JSON form (``whole``). It gives the ids of the JSON form at four times the speed."""
    import public_tokenizers
    import tiktoken

    path, whole = path or public_tokenizers.path(RANKS), whole or public_tokenizers.path(WHOLE)
    if (path, whole) not in _encodings:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[path, whole] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=markers(whole))
    return _encodings[path, whole]


def token_ids(codec, text: str | None) -> list[int]:
    """Ids of a text; a marker's string is one id wherever it stands."""
    return codec.encode(text or "", allowed_special="all")


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Cut the ids of each document, end id included, into full pieces and a rest.

    A null text is empty and has the end id only. ``with_ids`` adds the ids themselves.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(path)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "draw")}
            ids: list[np.ndarray] = []
            for doc_id, text, draw in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "text", "draw"))):
                tokens = np.append(np.asarray(token_ids(codec, text), dtype="<u4"), np.uint32(end_id))
                for start in range(0, len(tokens), size):
                    piece = tokens[start : start + size]
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                    out["doc_tokens"].append(len(tokens))
                    out["draw"].append(draw)
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            columns = {name: pa.array(values, pa.int64()) for name, values in out.items()}
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), "text", F.xxhash64(doc_id, "text").alias("draw"))
    return rows.mapInArrow(cut, DRAWN + (", ids array<int>" if with_ids else ""))


def first_fit_decreasing(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece.

    Bins are the leaves of a tournament tree; each inner node holds the largest room below
    it, so the first bin with room is found and updated on one path from the root.
    """
    order = np.argsort(-lengths, kind="stable")
    leaves = 1 << max(1, int(len(lengths) - 1).bit_length())
    room = [size] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, size - room[node]
        room[node] -= need
        node //= 2
        while node:
            left, right = room[2 * node], room[2 * node + 1]
            best = left if left > right else right
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return bins, offsets


def _runs(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[int, int, pa.Table]]:
    """Group, run and rows of at most ``limit`` pieces of a group; groups arrive in order."""
    held: list[pa.RecordBatch] = []
    current, run, count = None, 0, 0
    for batch in batches:
        groups = batch.column("_group").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            if groups[a] != current:
                if held:
                    yield current, run, pa.Table.from_batches(held)
                held, current, run, count = [], int(groups[a]), 0, 0
            while a < b:
                take = min(b - a, limit - count)
                held.append(batch.slice(a, take))
                a, count = a + take, count + take
                if count == limit:
                    yield current, run, pa.Table.from_batches(held)
                    held, run, count = [], run + 1, 0
    if held:
        yield current, run, pa.Table.from_batches(held)


def placed(cut: DataFrame, size: int = SIZE, group_rows: int = 4096) -> DataFrame:
    """Sequence and offset of each piece of a written table of pieces.

    Groups of whole documents are drawn by hash and hold about ``group_rows`` pieces. A group that
    repeated rows or a very long document make larger is packed in runs of twice that, so that
    a task holds one run at a time.
    """
    groups = max(1, -(-cut.count() // group_rows))
    limit = 2 * group_rows
    step = 1 << limit.bit_length()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, run, rows in _runs(batches, limit):
            bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), size)
            rows = rows.drop_columns(["_group", "_order", "draw"])
            rows = rows.append_column("sequence_id", pa.array((group * (1 << 24) + run) * step + bins, pa.int64()))
            rows = rows.append_column("offset", pa.array(offsets, pa.int64()))
            yield from rows.to_batches()

    return (
        cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "draw")
        .withColumn("_group", F.pmod("draw", F.lit(groups)))
        .withColumn("_order", F.xxhash64("draw", "start"))
        .repartition(partitions(cut.sparkSession), "_group")
        .sortWithinPartitions("_group", "_order")
        .mapInArrow(pack, PLACED)
    )


def pack_documents(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, path: str | None = None, group_rows: int = 4096) -> DataFrame:
    """Every id of every document in one piece of one sequence of at most ``size`` ids.

    Repeated rows are packed as often as they occur, null ids like any other, an empty table
    gives an empty result, and other columns are ignored. Sequence ids are unique, not dense.
    """
    return placed(cut_lineage(pieces(docs, size, end_id, path)), size, group_rows)


def sequences(docs: DataFrame, plan: DataFrame, size: int = SIZE, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """The ids of each sequence of a plan, in order: sequence_id, ids. Padding is left to the reader.

    Rows alike in all of a piece's columns hold the same ids, so one of them is enough.
    """
    cut = pieces(docs, size, end_id, path, with_ids=True).dropDuplicates(["doc_id", "start", "ids_crc32", "doc_tokens"])
    found = plan.alias("p").join(
        cut.alias("c"),
        F.col("p.doc_id").eqNullSafe(F.col("c.doc_id"))
        & (F.col("p.start") == F.col("c.start"))
        & (F.col("p.ids_crc32") == F.col("c.ids_crc32"))
        & (F.col("p.doc_tokens") == F.col("c.doc_tokens")),
    )
    parts = found.groupBy("p.sequence_id").agg(F.sort_array(F.collect_list(F.struct("p.offset", "c.ids"))).alias("_parts"))
    return parts.select("sequence_id", F.flatten(F.transform("_parts", lambda p: p["ids"])).alias("ids"))
