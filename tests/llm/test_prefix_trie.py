"""Conversation tries against rebuilt texts."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from tidemark.llm import catalog, ordered, prefix_trie
from tidemark.session import ship_package

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, n long, d long, ref string"


def plain_trie(rows):
    original = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            ref = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            original[r.conv_id].append((r.turn is not None, r.turn or 0, ref, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in original.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            (min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children[node], leaves[node], saved[node],
             hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
            for node, cs in members.items()
        ),
        key=repr,
    )


def made(spark, seed=1, convs=260, most=9):
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), -5, -120, 5000, 5003, 10**12 + 7]:
        if c % 37 == 3:
            continue
        for t in range(rng.randint(0, most)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", "hé 😀", None, "so"]), 1, 2, "x"))
    return spark.createDataFrame(rows, SCHEMA)


def test_query_and_sql(spark):
    ship_package(spark)
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    found = catalog.QUERIES["op12_prefix_trie"](spark, SF)
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == plain_trie(rows)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    sql = con.sql(f"select {', '.join(found.columns)} from ({catalog.ORACLES['op12_prefix_trie']})")
    assert sorted(sql.fetchall(), key=repr) == got


def test_random_conversations(spark):
    ship_package(spark)
    docs = made(spark)
    assert sorted(map(tuple, prefix_trie.trie(docs).collect()), key=repr) == plain_trie(docs.collect())


def test_edges(spark):
    """Null columns, ties, repeated rows, absent bases, and a base shorter than the head."""
    ship_package(spark)
    rows = [(None, 0, "user", "lost"), (7, None, "user", "first"), (7, 1, None, None), (7, 1, "b", "tie"), (7, 1, "b", "tie"), (100, 0, "a", "x" * 100_000)]
    rows += [(c, t, "u", f"t{t}") for c in (104, 105, 106, 150, 900_001) for t in range(7)] + [(199, 0, "u", "one")]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, prefix_trie.trie(docs).collect()), key=repr) == plain_trie(docs.collect())
    assert prefix_trie.trie(docs.where("false")).count() == 0
    lost = docs.where("conv_id is null")
    assert prefix_trie.trie(lost).count() == 0


def test_one_conversation_over_many_slices(spark):
    ship_package(spark)
    rows = [(3, t, "u", f"text {t % 50}", 1, 2, "x") for t in range(300)] + [(4, t, "u", f"text {t % 50}", 1, 2, "x") for t in range(290)]
    docs = spark.createDataFrame(rows, SCHEMA)
    turns = ordered.sliced(prefix_trie.turn_references(docs), ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("ref")])
    assert turns.where("conv_id = 3").select("_slice").distinct().count() > 1
    assert sorted(map(tuple, prefix_trie.trie(docs).collect()), key=repr) == plain_trie(docs.collect())


def test_clashing_fingerprints_draw_other_bases(spark, monkeypatch):
    """Bases of one make every order of turns alike; the stored turns show it."""
    ship_package(spark)
    draws = []
    real = prefix_trie.bases

    def weak(draw):
        draws.append(draw)
        return (1, 1) if draw == 0 else real(draw)

    monkeypatch.setattr(prefix_trie, "bases", weak)
    rows = [(c, t, "u", x, 1, 2, "x") for c, xs in ((1, "ab"), (2, "ba"), (3, "abc"), (4, "bac")) for t, x in enumerate(xs)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, prefix_trie.trie(docs, heads=1).collect()), key=repr) == plain_unchanged(docs.collect())
    assert 1 in draws


def plain_unchanged(rows):
    real = zlib.crc32
    try:
        zlib.crc32 = lambda data: 0
        return plain_trie(rows)
    finally:
        zlib.crc32 = real


def test_digest_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "JOINED", 7)
    rows = [(1, 5, 6, c) for c in range(-40, 60)] + [(0, 0, 0, 9)]
    found = prefix_trie.end_digests(spark.createDataFrame(rows, "d long, g0 long, g1 long, conv_id long")).collect()
    want = {(1, 5, 6): range(-40, 60), (0, 0, 0): [9]}
    assert {tuple(r)[:3]: r.ends_sha256 for r in found} == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in want.items()}
