"""Merkle manifests against a plain tree."""

import hashlib
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, merkle
from tidemark.session import ship_package

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, key string, pos long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def climb(levels, at, node):
    siblings = []
    for level in levels[:-1]:
        low = at - at % 16
        run = level[low : low + 16]
        siblings += run[: at - low] + run[at - low + 1 :]
        node = sha(*run[: at - low], node, *run[at - low + 1 :])
        at //= 16
    return siblings, node


def plain_manifest(rows):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted(((r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text)), r) for r in rows if r.source == s) for s in sources}
    trees = {s: plain_tree([leaf for (_, _, leaf), _ in g]) for s, g in groups.items()}
    top = plain_tree([trees[s][-1][0] for s in sources])
    root = top[-1][0] if sources else None
    out = []
    for n, s in enumerate(sources):
        for i, ((_, _, leaf), r) in enumerate(groups[s]):
            node = leaf
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
                node = plain_leaf(r, re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
            inside, folded = climb(trees[s], i, node)
            outside, folded = climb(top, n, folded)
            out.append((r.doc_id, leaf, trees[s][-1][0], root, sha(*inside, *outside), folded, folded == root))
    return sorted(out, key=repr)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def test_query(spark):
    ship_package(spark)
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = sorted(map(tuple, catalog.QUERIES["op13_merkle"](spark, SF).collect()), key=repr)
    assert found == plain_manifest(rows)
    assert {r[-1] for r in found} == {True, False}


def test_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    found = catalog.QUERIES["op13_merkle"](spark, SF)
    columns = ", ".join(found.columns)
    assert sorted(con.sql(f"select {columns} from ({catalog.ORACLES['op13_merkle']})").fetchall(), key=repr) == sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("climb_levels", [1, 2, 3])
def test_sizes(spark, monkeypatch, climb_levels):
    """Sources of every size around a run's and a chunk's end, with chunks of one to three levels."""
    ship_package(spark)
    monkeypatch.setattr(merkle, "CLIMB", climb_levels)
    monkeypatch.setattr(merkle, "CHUNK", 16**climb_levels)
    sizes = {None: 3, "": 1, "a": 16, "b": 17, "z": 256, "é": 257, "\U0001f600": 300, "m": 15}
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((at * 7919 % 10007, f"Text {at}" if at % 11 else None, None if at % 5 else "en", source, at, "x", "y", 1))
            at += 1
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(docs, tampered())
    assert sorted(map(tuple, found.collect()), key=repr) == plain_manifest(docs.collect())


def test_edges(spark):
    ship_package(spark)
    long = "Word and More " * 200_000
    rows = [(None, None, None, None, None), (None, "A", "en", "s", 1), (0, "", "en", "s", 0), (5, "Abc", None, "s", 3), (5, "Abc", None, "s", 3), (5, "Abd", None, "s", 3), (-7, long, "de", None, None)]
    docs = spark.createDataFrame([(*r, "x", "y", 2) for r in rows], SCHEMA)
    found = merkle.manifest(docs, tampered())
    assert sorted(map(tuple, found.collect()), key=repr) == plain_manifest(docs.collect())
    assert merkle.manifest(docs.where("false"), tampered()).count() == 0
    one = merkle.manifest(docs.where("doc_id = 0")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified
    assert one.proof_sha256 == hashlib.sha256().hexdigest()


def test_fold_reads_no_left_sibling():
    nodes = [sha(str(i)).encode() for i in range(40)]
    chunk = merkle.Chunk(nodes, 2)
    assert all(merkle.fold(n, chunk.path(i)) == chunk.tops[0] for i, n in enumerate(nodes))
    changed = list(nodes)
    changed[21] = sha("other").encode()
    assert merkle.fold(changed[21], chunk.path(21)) == merkle.Chunk(changed, 2).tops[0]
    assert [len(right) // 64 for _, right in chunk.path(21)] == [10, 1]
