"""SimHash groups against plain comparison of all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import catalog, simhash
from tidemark.session import ship_package

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=2):
    fps = sorted({f for _, f in rows})
    top = {f: f for f in fps}

    def find(f):
        while top[f] != f:
            f = top[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i:]:
            if (a ^ b).bit_count() <= radius:
                top[find(b)] = find(a)
    ids = {}
    for doc, f in rows:
        if doc is not None:
            ids[find(f)] = min(ids.get(find(f), doc), doc)
    return sorted(((doc, f"{f:016x}", ids.get(find(f))) for doc, f in rows), key=repr)


def test_query(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = plain_groups([(r.doc_id, plain_fingerprint(r.text)) for r in docs])
    found = catalog.QUERIES["op11_simhash_tiles"](spark, SF)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=repr) == want


@pytest.mark.parametrize("parts", [1, 2, 4, 8, 16])
def test_all_cuts_find_the_same_groups(spark, parts):
    rng = random.Random(parts)
    fps = [rng.getrandbits(64) for _ in range(150)] + [0, 1, 3, 2**64 - 1, 2**63, 2**63 + 2**62]
    for f in fps[:60]:
        for flips in range(1, 4):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), flips)))
    seen = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in set(fps)], "fp long")
    edges = simhash.links(seen, parts=parts).collect()
    top = {f: f for f in set(fps)}

    def find(f):
        while top[f] != f:
            f = top[f]
        return f

    for e in edges:
        top[find(e.a % 2**64)] = find(e.b % 2**64)
    got = {}
    for f in top:
        got.setdefault(find(f), set()).add(f)
    want = {}
    for doc, f, group in plain_groups([(f, f) for f in top]):
        want.setdefault(group, set()).add(doc)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_crowded_key_fills_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = random.Random(5)
    fps = {sum(1 << b for b in rng.sample(range(16), 8)) for _ in range(300)}
    cut = simhash.tiles(spark.createDataFrame([(f,) for f in fps], "fp long"), 4).collect()
    assert len({r.key for r in cut}) == 1 and len(cut) >= len(fps) // 16
    assert sorted(f for r in cut for f in np.frombuffer(r.fps, np.uint64).tolist()) == sorted(fps)
    assert max(len(r.fps) for r in cut) <= 16 * 8


def test_edges(spark):
    ship_package(spark)
    long = " ".join(f"w{i % 991} t{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d"), (4, "A  B\tc D"), (4, "A  B\tc D"), (5, "one"), (6, "one two"), (7, long), (8, long.upper()), (9, "Ä ä É straße")]
    docs = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows], "doc_id long, text string, fp string, key string, id int, component_id string")
    found = simhash.near_duplicates(docs)
    want = plain_groups([(i, plain_fingerprint(t)) for i, t in rows])
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    alone = simhash.near_duplicates(docs.where("doc_id is null")).collect()
    assert [(r.doc_id, r.component_id) for r in alone] == [(None, None)]


def test_meeting_chance():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, (2, 200_000), dtype=np.uint64) * 2 + rng.integers(0, 2, (2, 200_000), dtype=np.uint64)
    for parts, width in ((1, 64), (2, 32), (4, 16)):
        apart = np.zeros(len(a), int)
        for i in range(parts):
            mask = np.uint64((1 << width) - 1)
            x, y = (np.bitwise_count(v >> np.uint64(i * width) & mask).astype(int) for v in (a, b))
            apart += np.abs(x - y)
        assert (apart <= 2).mean() == pytest.approx(simhash.meeting_chance(parts), rel=0.1)
    assert [simhash.parts_for(n) for n in (100, 50_000, 10**6, 10**9)] == [1, 4, 8, 16]


def test_forest_keeps_parts():
    rng = np.random.default_rng(2)
    for _ in range(20):
        u, v = rng.integers(0, 40, (2, rng.integers(0, 60)))
        a, b = simhash.forest(40, u, v)

        def label(x, y):
            top = list(range(40))
            for _ in range(40):
                for i, j in zip(x, y):
                    top[i] = top[j] = min(top[i], top[j])
            return top

        assert label(a, b) == label(u, v) and len(a) == 40 - len(set(label(u, v)))
