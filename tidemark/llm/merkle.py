"""Merkle manifest of documents whose parents resume copied hash states."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ordered import positions, sliced
from tidemark.session import cut_lineage

#: Children of a parent, and levels that one task climbs at once: a chunk has 16**3 nodes.
FAN, CLIMB = 16, 3
CHUNK = FAN**CLIMB
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:binary,right:binary>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """SHA-256 of the fields, each with its length in bytes before it, a null as ``-``."""
    return F.sha2(F.concat(*map(_field, (doc_id, source, lang, n_chars, text))), 256)


def lowered(text: Column) -> Column:
    """Only A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, source key, leaf and the leaf after tampering (null where ``tampered`` is not true).

    The source key is empty for a null source and sorts by the source's bytes otherwise.
    """
    plain = docs.select(*(F.col(f"`{c}`").alias(c) for c in FIELDS), tampered.alias("_tampered"))
    parts = {c: F.col(c) for c in FIELDS}
    return plain.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("key"),
        F.unhex(leaf(**parts)).alias("leaf"),
        F.when(F.col("_tampered"), F.unhex(leaf(**(parts | {"text": lowered(F.col("text"))})))).alias("altered"),
    )


class Chunk:
    """A run of neighbouring nodes with their parents, up to ``climb`` levels above.

    A parent's hash is fed child by child, and its state is copied before each child's slot.
    """

    def __init__(self, nodes: list[bytes], climb: int):
        self.states: list[list] = []
        self.siblings: list[list[bytes]] = []
        for _ in range(climb):
            states, runs, parents = [], [], []
            for at in range(0, len(nodes), FAN):
                run = nodes[at : at + FAN]
                state = hashlib.sha256()
                for child in run:
                    states.append(state.copy())
                    state.update(child)
                runs.append(b"".join(run))
                parents.append(state.hexdigest().encode())
            self.states.append(states)
            self.siblings.append(runs)
            nodes = parents
        self.tops = nodes

    def steps(self, at: int) -> list[tuple[bytes, bytes]]:
        """Left and right siblings of a node and of each parent above it."""
        found = []
        for runs in self.siblings:
            run, slot = runs[at // FAN], 64 * (at % FAN)
            found.append((run[:slot], run[slot + 64 :]))
            at //= FAN
        return found

    def path(self, at: int) -> list[tuple[object, bytes]]:
        """For each parent above a node: the state before the slot and the right siblings."""
        found = []
        for states, runs in zip(self.states, self.siblings):
            found.append((states[at], runs[at // FAN][64 * (at % FAN) + 64 :]))
            at //= FAN
        return found


def fold(node: bytes, path: list[tuple[object, bytes]]) -> bytes:
    """The root over a node: each parent's state resumes with the node and its right siblings only."""
    for state, right in path:
        resumed = state.copy()
        resumed.update(node)
        resumed.update(right)
        node = resumed.hexdigest().encode()
    return node


def _height(total: int) -> int:
    """Levels above ``total`` nodes."""
    height = 0
    while total > 1:
        total, height = -(-total // FAN), height + 1
    return height


def _hex(digest: bytes) -> bytes:
    return digest.hex().encode()


def _climbed(chunks: DataFrame) -> DataFrame:
    """The node above each chunk (key, chunk, total, nodes): key, pos, total, node, and the
    siblings on the way to it for each of its nodes."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                built = Chunk(list(map(_hex, r["nodes"])), min(CLIMB, _height(r["total"])))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([r["key"]], pa.string()),
                        "pos": pa.array([r["chunk"]], pa.int64()),
                        "total": pa.array([-(-r["total"] // CHUNK)], pa.int64()),
                        "node": pa.array([bytes.fromhex(built.tops[0].decode())], pa.binary()),
                        "climbs": pa.array(
                            [[[{"left": a, "right": b} for a, b in built.steps(i)] for i in range(len(r["nodes"]))] if r["climbs"] else None],
                            pa.list_(pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))),
                        ),
                    }
                )

    return chunks.mapInArrow(climb, f"key string, pos long, total long, node binary, climbs array<{STEPS}>")


def _gathered(nodes: DataFrame) -> DataFrame:
    """Nodes (key, pos, total, node) in chunks of ``CHUNK`` neighbours."""
    return (
        nodes.groupBy("key", F.floor(F.col("pos") / CHUNK).alias("chunk"))
        .agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("_all"))
        .select("key", "chunk", "total", F.transform("_all", lambda n: n["node"]).alias("nodes"), F.lit(True).alias("climbs"))
    )


def _rise(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From nodes (key, pos, total, node) to the one above each key, and the siblings on the
    way: tops (key, node) and paths (key, pos, steps). Each round shrinks a key 4096 times."""
    rounds = []
    while nodes.where("total > 1").limit(1).count():
        up = cut_lineage(_climbed(_gathered(nodes)))
        rounds.append(up)
        nodes = up.select("key", "pos", "total", "node")
    tops = nodes.select("key", "node")
    path = nodes.select("key", "pos", F.array().cast(STEPS).alias("steps"))
    for up in reversed(rounds):
        own = up.select("key", F.col("pos").alias("_up"), F.posexplode("climbs").alias("_at", "_own"))
        path = cut_lineage(
            own.join(path.withColumnRenamed("pos", "_up"), ["key", "_up"]).select(
                "key", (F.col("_up") * CHUNK + F.col("_at")).alias("pos"), F.concat("_own", "steps").alias("steps")
            )
        )
    return tops, path


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a source in order of doc_id (null first, ties by leaf) are hashed in runs of
    ``FAN`` until one node is left, its subroot; subroots in order of their source (null first,
    by bytes) give the root alike. ``proof_sha256`` hashes the siblings on the way from the leaf
    to the root. ``folded_root`` folds the leaf, or where ``tampered`` holds the leaf of the text
    with A-Z in lower case, into the root, and ``verified`` tells whether that is the root.

    Documents are dealt in chunks of 4096 leaves, so a large source is many tasks, and only one
    node a chunk goes on to the levels above. A chunk's parents keep their hash states, copied
    before each slot, for all folds through them; above the chunk, where a state can't be
    written, a task feeds the left siblings once and keeps the state for all its documents.

    Repeated rows are a leaf each, a null id is a leaf like others, other columns are ignored,
    and an empty table gives an empty result.
    """
    rows = sliced(leaves(docs, F.lit(False) if tampered is None else tampered), ["key"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    chunks = cut_lineage(
        positions(rows, ["key"])
        .groupBy("key", F.floor(F.col("pos") / CHUNK).alias("chunk"))
        .agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "altered"))).alias("rows"))
    )
    base = chunks.select("key", "chunk", "total", F.transform("rows", lambda r: r["leaf"]).alias("nodes"), F.lit(False).alias("climbs"))
    subroots, inner = _rise(cut_lineage(_climbed(base).drop("climbs")))
    places = positions(sliced(subroots.withColumn("_all", F.lit("")), ["_all"], [F.col("key")]), ["_all"])
    ranked = cut_lineage(places.select(F.lit("").alias("key"), "pos", "total", "node", F.col("key").alias("source_key")))
    tops, outer = _rise(ranked.drop("source_key"))
    top = tops.first()
    root = top["node"].hex() if top else ""
    above = (
        ranked.select("pos", F.col("source_key").alias("key"), F.col("node").alias("subroot"))
        .join(outer.select("pos", F.col("steps").alias("_outer")), "pos")
        .drop("pos")
    )
    ways = inner.join(above, "key").select("key", F.col("pos").alias("chunk"), F.concat("steps", "_outer").alias("steps"), "subroot")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = [_hex(x["leaf"]) for x in r["rows"]]
                chunk = Chunk(found, min(CLIMB, _height(r["total"])))
                beyond = [(hashlib.sha256(s["left"]), s["right"]) for s in r["steps"]]
                siblings = b"".join(s["left"] + s["right"] for s in r["steps"])
                proofs, folded = [], []
                for i, row in enumerate(r["rows"]):
                    proof = hashlib.sha256()
                    for left, right in chunk.steps(i):
                        proof.update(left)
                        proof.update(right)
                    proof.update(siblings)
                    proofs.append(proof.hexdigest())
                    node = found[i] if row["altered"] is None else _hex(row["altered"])
                    folded.append(fold(node, chunk.path(i) + beyond).decode())
                n = len(found)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([x["doc_id"] for x in r["rows"]], pa.int64()),
                        "leaf": pa.array([x.decode() for x in found]),
                        "subroot": pa.array([r["subroot"].hex()] * n),
                        "root": pa.array([root] * n),
                        "proof_sha256": pa.array(proofs),
                        "folded_root": pa.array(folded),
                        "verified": pa.array([f == root for f in folded]),
                    }
                )

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return chunks.join(ways, ["key", "chunk"]).select("total", "rows", "steps", "subroot").mapInArrow(prove, schema)
