"""Trie of conversation prefixes from fingerprints that compose."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions
from tidemark.llm.ordered import sliced
from tidemark.session import cut_lineage

#: A sequence t1 .. tn has the fingerprint sum of ti * base**(i - 1) for two primes: those of two
#: sequences combine as g(uv) = g(u) + base**|u| * g(v), with the empty one as 0.
PRIMES = (2**31 - 1, 2**31 - 19)
#: Bits of a length, and ids joined at once for a digest.
LENGTH_BITS, JOINED = 40, 4096


def bases(draw: int) -> tuple[int, int]:
    """Bases of the two fingerprints, other ones for each draw."""
    digest = hashlib.sha256(f"bases {draw}".encode()).digest()
    return tuple(2 + int.from_bytes(digest[8 * i : 8 * i + 8], "big") % (p - 3) for i, p in enumerate(PRIMES))  # type: ignore[return-value]


def power(base: int, exponent: Column, prime: int) -> Column:
    """base ** exponent modulo a prime below 2**31, for exponents from 0."""
    found, square = F.lit(1).cast("long"), base
    for bit in range(LENGTH_BITS):
        taken = F.shiftrightunsigned(exponent, bit).bitwiseAND(F.lit(1).cast("long")) == 1
        found = found * F.when(taken, F.lit(square).cast("long")).otherwise(F.lit(1).cast("long")) % prime
        square = square * square % prime
    return found


def combined(left: Column, length: Column, right: Column, base: int, prime: int) -> Column:
    """Fingerprint of two sequences, the left one of the given length."""
    return (left + power(base, length, prime) * right) % prime


def turn_references(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, reference and length of each turn; null roles and texts are empty.

    The reference is the SHA-256 of role and text, the role's length in bytes before it.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(content, 256)).alias("ref"),
        F.length(text).cast("long").alias("chars"),
    ).where("conv_id is not null")


def _token(ref: Column, which: int) -> Column:
    return F.pmod(F.xxhash64(ref, F.lit(which)), F.lit(PRIMES[which] - 1)) + 1


def prefixes(turns: DataFrame, draw: int = 0) -> DataFrame:
    """Each original turn with its place from 1 (``pos``), the fingerprints of the turns up to it
    (``g0``, ``g1``) and the turns of its conversation (``n``).

    ``turns`` is the result of ``ordered.sliced``: products are taken within a slice, and those
    of a conversation's earlier slices are combined before it, so a conversation of any length
    is spread over many tasks.
    """
    base = bases(draw)
    inside = Window.partitionBy("conv_id", "_slice").orderBy("_seq")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = turns.withColumn("_at", F.row_number().over(inside).cast("long") - 1)
    for i, p in enumerate(PRIMES):
        local = local.withColumn(f"t{i}", _token(F.col("ref"), i) * power(base[i], F.col("_at"), p) % p)
    local = cut_lineage(local.select("*", *((F.sum(f"t{i}").over(upto) % p).alias(f"_l{i}") for i, p in enumerate(PRIMES))))
    parts = local.groupBy("conv_id", "_slice").agg(
        F.count(F.lit(1)).alias("_n"), *((F.sum(f"t{i}") % p).alias(f"_w{i}") for i, p in enumerate(PRIMES))
    )
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumn("n", F.sum("_n").over(whole))
    for i, p in enumerate(PRIMES):
        parts = parts.withColumn(f"_w{i}", power(base[i], F.col("_before"), p) * F.col(f"_w{i}") % p)
    for i, p in enumerate(PRIMES):
        parts = parts.withColumn(f"_e{i}", F.coalesce(F.sum(f"_w{i}").over(earlier), F.lit(0)) % p)
    joined = local.join(parts.drop("_n", "_w0", "_w1"), ["conv_id", "_slice"])
    return joined.select(
        "conv_id",
        "_slice",
        (F.col("_before") + F.col("_at") + 1).alias("pos"),
        "n",
        *(combined(F.col(f"_e{i}"), F.col("_before"), F.col(f"_l{i}"), base[i], p).alias(f"g{i}") for i, p in enumerate(PRIMES)),
        *((power(base[i], F.col("_before"), p) * F.col(f"t{i}") % p).alias(f"w{i}") for i, p in enumerate(PRIMES)),
        "ref",
        "chars",
    )


def rebuilt(original: DataFrame, heads: int = 6, family: int = 100, draw: int = 0) -> tuple[DataFrame, DataFrame]:
    """The prefixes of rebuilt conversations and their lengths.

    Conversation c takes the first h turns of c - c % ``family``, h = crc32(c) % ``heads``, then
    its own after its first h. No text is rebuilt: a prefix is the fingerprint of the head
    combined with that of the own turns, the quotient of two own prefixes. Rows: conv_id, d,
    g0, g1, the fingerprints p0, p1 without the last turn, the last turn's ref and chars.
    """
    base = bases(draw)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = original.groupBy("conv_id").agg(F.max("n").alias("n"))
    convs = convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base_id"))
    first = original.where(F.col("pos") < heads)
    starts = first.where(F.col("conv_id") % family == 0).drop("_slice").withColumnRenamed("conv_id", "base_id")
    sizes = starts.where("pos = 1").select("base_id", F.col("n").alias("_m"))
    convs = cut_lineage(
        convs.join(sizes, "base_id", "left").withColumn("take", F.least("h", F.coalesce("_m", F.lit(0)).cast("long"))).drop("_m")
    )
    lengths = convs.select("conv_id", (F.col("take") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    columns = ["conv_id", "d", "g0", "g1", "w0", "w1", "ref", "chars"]
    head = convs.drop("n").join(starts, "base_id").where("pos <= take").withColumn("d", F.col("pos")).select(*columns)

    own_at = first.select("conv_id", F.col("pos").alias("h"), F.col("g0").alias("_s0"), F.col("g1").alias("_s1"))
    head_at = starts.select("base_id", F.col("pos").alias("take"), F.col("g0").alias("_h0"), F.col("g1").alias("_h1"))
    ends = convs.join(own_at, ["conv_id", "h"], "left").join(head_at, ["base_id", "take"], "left").drop("n")
    slices = original.where("pos > 0").groupBy("conv_id", "_slice").agg(F.max("pos").alias("_last"))
    facts = slices.join(ends, "conv_id").where("_last > h").drop("_last", "base_id")
    own = original.join(facts, ["conv_id", "_slice"]).where("pos > h").withColumn("d", F.col("pos") - F.col("h") + F.col("take"))
    for i, p in enumerate(PRIMES):
        inverse = pow(base[i], -1, p)
        # places move down by h - take, which is below ``heads``
        shift = power(inverse, F.col("h") - F.col("take"), p)
        start = F.when(F.col("h") > 0, F.col(f"_s{i}")).otherwise(0)
        before = F.when(F.col("take") > 0, F.col(f"_h{i}")).otherwise(0)
        own = own.withColumn(f"g{i}", (before + (F.col(f"g{i}") - start + p) % p * shift) % p).withColumn(f"w{i}", F.col(f"w{i}") * shift % p)
    rows = head.unionByName(own.select(*columns))
    parents = ((F.col(f"g{i}") - F.col(f"w{i}") + p) % p for i, p in enumerate(PRIMES))
    return rows.select(*columns, *(x.alias(f"p{i}") for i, x in enumerate(parents))).drop("w0", "w1"), lengths


_NODE = ["d", "g0", "g1"]


def nodes(rows: DataFrame) -> DataFrame:
    """One row per prefix: its smallest conversation, members, last turn and parent, and ``mixed``
    where members differ in the stored last turn or in the prefix before it."""
    same = [F.min(c) == F.max(c) for c in ("ref", "p0", "p1")]
    return rows.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("chars").alias("chars"),
        F.min("p0").alias("p0"),
        F.min("p1").alias("p1"),
        (~(same[0] & same[1] & same[2])).alias("mixed"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids that end at each node, joined by commas.

    Ids are sorted over range partitions and joined in runs of ``JOINED``; a node's runs are then
    fed to its hash in order, one at a time. The bytes of one message can only be hashed in
    order, so a node with many ends is one task that reads a 4096th of their rows.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def run() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"d": node[0], "g0": node[1], "g1": node[2], "first": ids[0], "ids": ",".join(map(str, ids))}])

        for batch in batches:
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv_id"))):
                if at != node or len(ids) == JOINED:
                    if ids:
                        yield run()
                    node, ids = at, []
                ids.append(conv)
        if ids:
            yield run()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def digest() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"d": node[0], "g0": node[1], "g1": node[2], "ends_sha256": state.hexdigest()}])

        for batch in batches:
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
                if at != node:
                    if node:
                        yield digest()
                    node, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if node:
            yield digest()

    n = partitions(ends.sparkSession)
    key = "d long, g0 long, g1 long"
    dealt = ends.select(*_NODE, "conv_id").repartitionByRange(n, *_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    joined = dealt.mapInArrow(runs, f"{key}, first long, ids string")
    return joined.repartition(n, *_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(digests, f"{key}, ends_sha256 string")


def subtree_sums(tree: DataFrame, rows: DataFrame, sums: list[str]) -> DataFrame:
    """``sums`` added up over the subtree of every node.

    Rounds double the reach: what a node has summed so far goes to its ancestor as far above.
    That ancestor is the prefix of the node's own smallest conversation, so it is looked up by
    (conversation, depth), a key of one row, and not by a crowded node.
    """
    deepest = tree.agg(F.max("d").alias("d")).first()["d"] or 0
    at = rows.select("conv_id", F.col("d").alias("_d"), F.col("g0").alias("_g0"), F.col("g1").alias("_g1"))
    reach = 1
    while reach <= deepest:
        moved = tree.where(F.col("d") >= reach).withColumn("_d", F.col("d") - reach)
        inner = moved.where("_d > 0").join(at, ["conv_id", "_d"])
        outer = moved.where("_d = 0").withColumns({"_g0": F.lit(0).cast("long"), "_g1": F.lit(0).cast("long")})
        columns = [F.col("_d").alias("d"), F.col("_g0").alias("g0"), F.col("_g1").alias("g1"), *sums]
        up = inner.select(*columns).unionByName(outer.select(*columns)).groupBy(*_NODE).agg(*(F.sum(s).alias(f"_{s}") for s in sums))
        added = [(F.col(s) + F.coalesce(F.col(f"_{s}"), F.lit(0))).alias(s) for s in sums]
        rest = [c for c in tree.columns if c not in sums]
        tree = cut_lineage(tree.join(up, _NODE, "left").select(*rest, *added))
        reach *= 2
    return tree


def trie(conversations: DataFrame, heads: int = 6, family: int = 100) -> DataFrame:
    """All prefixes of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are in order of ``turn`` (null first), ties by their reference; repeated rows are
    turns of their own. Null roles and texts are empty. Rows without a conv_id belong to no
    conversation. Other columns are ignored; an empty table has no node, not even a root.

    Prefixes group by fingerprint. Members of a group must agree in the stored reference of the
    last turn and in the group of the prefix before it; by induction along the depth they are
    then equal turn by turn. Should fingerprints clash, all is done again with other bases.
    """
    turns = sliced(turn_references(conversations), ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("ref")])
    draw = 0
    while True:
        original = cut_lineage(prefixes(turns, draw))
        found, lengths = rebuilt(original, heads, family, draw)
        rows, lengths = cut_lineage(found), cut_lineage(lengths)
        grouped = cut_lineage(nodes(rows))
        if not grouped.where("mixed").limit(1).count():
            break
        draw += 1
    zero = F.lit(0).cast("long")
    top = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = top.select(*(zero.alias(c) for c in _NODE), "conv_id", "n_convs", zero.alias("chars"), *(F.lit(None).cast("long").alias(c) for c in ("p0", "p1")))
    every = grouped.drop("mixed").unionByName(root)
    children = grouped.groupBy((F.col("d") - 1).alias("d"), F.col("p0").alias("g0"), F.col("p1").alias("g1")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = cut_lineage(
        every.join(children, _NODE, "left")
        .withColumn("n_children", F.coalesce("n_children", zero))
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars"))
    )
    summed = subtree_sums(tree, rows, ["n_leaves", "saved_tokens"])
    last = rows.join(lengths.withColumnRenamed("length", "d"), ["conv_id", "d"]).select(*_NODE, "conv_id")
    empty = lengths.where("length = 0").select(*(zero.alias(c) for c in _NODE), "conv_id")
    digests = cut_lineage(end_digests(last.unionByName(empty)))
    parents = tree.select((F.col("d") + 1).alias("d"), F.col("g0").alias("p0"), F.col("g1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    return (
        summed.join(digests, _NODE, "left")
        .join(parents, ["d", "p0", "p1"], "left")
        .select(
            "conv_id",
            F.col("d").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
