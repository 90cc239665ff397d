"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import boosting, common, langid, lattice_lm, licenses, mixing, near_dup, packing, pii, quality_zip, rules, vafile
from tidemark.session import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, score string, size string, node string, _n string, held_out boolean"
LONG = " ".join(f"word{i % 977} tail{i}" for i in range(60_000))
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away from here", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog and runs far away from here", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog and runs far away from here", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \n\t ", "de", "b"),
    (None, "der schnelle braune Fuchs springt über den faulen Hund", "de", None),
    (6, "12 34 ... !!", None, "b"),
    (7, LONG, "en", "c"),
    (8, "mail me at jo.doe@example.org or +1 (505) 555-1941 4665471787434695", "en", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(*t, "x", "y", "z", "w", False) for t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, text string")


def test_mixing(docs, none):
    found = mixing.mix_documents(docs).collect()
    assert len(found) == len(TEXTS)
    assert {r.size for r in found if r.doc_id in (3, 4, 5)} == {0}
    assert all(r.taken <= 3 * r.size for r in found)
    total = sum(r.size for r in found)
    aims = {r.source: (r.target, r.source_size) for r in found}
    assert sum(t for t, _ in aims.values()) == pytest.approx(total)
    assert all(t <= 3 * s + 1e-9 for t, s in aims.values())
    again = mixing.mix_documents(docs).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r.copies for r in found)
    assert mixing.mix_documents(none).count() == 0 and mixing.mixed(none).count() == 0


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 100), ("c", 100)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found["a"] == 3 and found["b"] == pytest.approx(198 * 2 / 5) and found["c"] == pytest.approx(198 * 3 / 5)


def test_hot_source_is_counted_over_slices(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2400, "a").otherwise("b").alias("source"), (F.col("id") % 7).alias("size"))
    found = mixing.sampled(rows).collect()
    for s in ("a", "b"):
        own = [r for r in found if r.source == s]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 30


def test_licenses(docs, none, spark):
    assert licenses.scan(docs).count() == 0 and licenses.scan(none).count() == 0
    text = f"é intro. {licenses.NOTICES[3][1].upper()}! after Released under the MIT License. " + LONG
    rows = spark.createDataFrame([(1, text, "q"), (2, text, "q")], "doc_id long, text string, license string")
    found = licenses.scan(rows).collect()
    assert len(found) == 4 and {r.license for r in found} == {"MIT"}
    assert {text[r.first : r.end].split()[0] for r in found} == {"PERMISSION", "Released"}
    assert licenses.scan(rows, texts=()).count() == 0
    changed = licenses.NOTICES[3][1].replace("hereby", "now").replace("charge", "cost")
    partly = spark.createDataFrame([(1, changed)], "doc_id long, text string")
    grams = licenses.shingles(licenses.word_hashes(licenses.normal(changed.encode())), 5)
    own = licenses.Templates(licenses.NOTICES).grams[3]
    share = np.isin(own, grams).mean()
    assert (share >= 0.8) == (licenses.scan(partly).where("license = 'MIT'").count() == 1)


def test_license_templates_are_told_apart():
    known = licenses.Templates(licenses.NOTICES)
    names = lambda text: [m[0] for m in known.matches(text.encode())]
    for name, text in licenses.NOTICES:
        assert set(names(text)) == {name}, (name, text)
    between = " ".join(f"w{i}" for i in range(40))
    for name, text in licenses.NOTICES:
        for other, second in licenses.NOTICES:
            assert set(names(f"{text} {between} {second}")) == {name, other}, (text, second)


def test_band_index_finds_what_comparing_all_finds():
    rng = np.random.default_rng(3)
    minima = rng.integers(0, 1 << 63, (5, 200), dtype=np.uint64)
    minima[:, 50:60] = minima[:, 40:50]
    windows = rng.integers(0, 1 << 63, (5, 900), dtype=np.uint64)
    windows[:, ::7] = minima[:, rng.integers(0, 200, windows[:, ::7].shape[1])]
    windows[2:, 1::7] = rng.integers(0, 1 << 63, windows[2:, 1::7].shape, dtype=np.uint64)
    members = list(range(1000, 1200))
    want = {(members[t], w) for t in range(200) for w in np.flatnonzero((windows == minima[:, t, None]).any(axis=0)).tolist()}
    assert set(licenses.BandIndex(minima, members).lookup(windows)) == want and len(want) > 100


def test_whole_license_bodies():
    known = licenses.Templates(licenses.NOTICES)
    bodies = {name: text for name, text in licenses.NOTICES if text.endswith(("IN THE SOFTWARE.", "OF THIS SOFTWARE."))}
    assert set(bodies) == {"MIT", "MIT-0", "ISC", "0BSD"}
    for name, text in bodies.items():
        whole = f"Copyright (c) 2020 Someone\n\n{text}\n\nint main() {{ return 0; }}"
        [(found, first, end, share)] = known.matches(whole.encode())
        assert found == name and share == 1.0 and whole[first:end].split()[0] == "Permission" and whole[:end].endswith("SOFTWARE")


def test_altered_notice_before_a_whole_one():
    """Both are found, though the second has more shingles and starts within reach of the first."""
    known = licenses.Templates(licenses.NOTICES)
    body = next(text for name, text in licenses.NOTICES if name == "MIT" and len(text) > 600)
    altered = body.replace("TORT OR OTHERWISE", "TORT OR ELSE")
    found = known.matches(f"{altered} one two three {body}".encode())
    assert [(m[0], m[3] == 1.0) for m in found] == [("MIT", False), ("MIT", True)]


def test_many_notices_in_one_text():
    known = licenses.Templates(licenses.NOTICES)
    line = "Licensed under the MIT License. " + " ".join(f"w{i}" for i in range(20)) + " "
    assert len(known.matches((line * 3000).encode())) == 3000


def test_near_forms_of_license_notices():
    known = licenses.Templates(licenses.NOTICES)
    gnu = (
        "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation; either version {}, or (at your option) any later version. This {} is distributed"
    )
    bsd = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: {} Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. {} Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. {} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS"
    )
    third = "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    cases = {
        gnu.format("library", "Lesser General Public License", "2.1 of the License", "library"): "LGPL-2.1",
        gnu.format("library", "Lesser General Public License", "3 of the License", "library"): "LGPL-3.0",
        gnu.format("library", "Library General Public License", "2", "library"): "LGPL-2.0",
        gnu.format("program", "Affero General Public License", "3 of the License", "program"): "AGPL-3.0",
        gnu.format("program", "General Public License", "2", "program"): "GPL-2.0",
        gnu.format("program", "General Public License", "3", "program"): "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 2 only": "GPL-2.0",
        bsd.format("1.", "2.", ""): "BSD-2-Clause",
        bsd.format("(1)", "(2)", ""): "BSD-2-Clause",
        bsd.format("1.", "2.", "3. " + third.format("the copyright holder")): "BSD-3-Clause",
        bsd.format("*", "*", "* " + third.format("Example Inc.")): "BSD-3-Clause",
        bsd.format("a)", "b)", "c) " + third.format("the University")): "BSD-3-Clause",
    }
    for text, name in cases.items():
        assert {m[0] for m in known.matches(text.encode())} == {name}, text


def test_personal_data(docs, none):
    model = pii.train(docs)
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert len(pii.find(docs, model).collect()) == len(TEXTS)
    assert not found[3].spans and not found[4].spans
    text = dict((t[0], t[1]) for t in TEXTS)[8]
    assert "jo.doe@example.org" in {text[s["first"] : s["end"]] for s in found[8].spans}
    clean = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    assert clean[3] is None and "[email]" in clean[8] and clean[7] == LONG
    empty = pii.train(none)
    assert pii.find(none, empty).count() == 0
    assert [s[0] for s in pii.base_spans("a@b.c@d.e 300.1.1.1 0001.2.3.4 1.2.3.4.5.6.7.8")] == ["email", "ip", "ip", "ip"]
    assert pii.base_spans("1" * 200_000) == []


def test_trees_learn_an_interaction():
    x = np.random.default_rng(0).random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    assert ((boosting.fit(x, y).margin(x) > 0) == (y == 1)).mean() > 0.98


def test_quality_by_compression(spark, docs, none):
    known = labels(spark, [(1, 1, "a"), (2, 1, "b"), (7, 0, "c"), (8, 0, "d"), (8, 1, "d"), (None, 1, "e"), (3, None, "f")])
    for table in (known, known.where("quality = 1"), known.where("false")):
        model = quality_zip.train(docs, table)
        found = quality_zip.predict(docs, model).collect()
        assert len(found) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert quality_zip.predict(none, quality_zip.train(none, known)).count() == 0


def test_quality_draw_is_bounded(spark):
    """An id that repeats comes once, and no more ids than asked for."""
    docs = spark.range(4000).select((F.col("id") % 40).alias("doc_id"), F.concat(F.lit("some text "), F.col("id") % 40, F.lit(" of words")).alias("text"))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    seen = []

    class Drawn(quality_zip.Model):
        def difference(self, text):
            seen.append(text)
            return float(len(text))

    model, quality_zip.Model = quality_zip.Model, Drawn
    try:
        quality_zip.train(docs, labels, per_class=6)
    finally:
        quality_zip.Model = model
    assert len(seen) == len(set(seen)) == 6


def test_near_duplicates(spark, docs, none):
    found = {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()}
    assert near_dup.classes(docs).count() == len(TEXTS)
    assert found[1] == found[2] == 1 and found[3] == found[4] == found[5] == 3 and found[None] is None and found[7] == 7
    kept = near_dup.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(found.values()))
    assert near_dup.classes(none).count() == 0 and near_dup.representatives(none).count() == 0


def test_near_copies_around_one_text(spark):
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        copy = list(base)
        for j in range(6):
            copy[(i * 5 + j * 50) % 300] = f"x{i}y{j}"
        rows.append((i, " ".join(copy)))
    rows.append((100, " ".join(f"v{i}" for i in range(300))))
    ship_package(spark)
    found = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {found[i] for i in range(60)} == {0} and found[100] == 100


def test_short_texts_of_the_least_similarity_are_linked(spark):
    rows, want, new = [], {}, iter(range(10**6))
    for copy in range(40):
        # words of the text, words cut at its end: 4/5, 5/6, 7/8, 8/9, 8/10, 12/15, 16/20, 51/63, 63/78, 64/80 common runs
        for words, cut in ((9, 1), (10, 1), (12, 1), (13, 1), (14, 2), (19, 3), (24, 4), (67, 12), (82, 15), (84, 16)):
            text = [f"w{next(new)}" for _ in range(words)]
            for part in (text, text[: words - cut]):
                want[len(rows)] = len(rows) - (part is not text)
                rows.append((len(rows), " ".join(part)))
    # one text of 5 runs among many that share 4 of them, each with a similarity of 4/6 to the others
    line = [f"v{i}" for i in range(8)]
    for i in range(50):
        want[len(rows)] = len(rows)
        rows.append((len(rows), " ".join([*line, f"u{i}"])))
    ship_package(spark)
    found = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i in want if found[i] != want[i]} == set()


@pytest.mark.parametrize("common, union", [(4, 5), (5, 6), (6, 7), (7, 8), (8, 10), (12, 15), (16, 20), (20, 25), (40, 50), (63, 78), (64, 80)])
def test_short_candidates_by_size(common, union):
    keys = near_dup._keys(near_dup.SKETCHES, 1)
    rng = np.random.default_rng(union)
    for _ in range(150):
        words = rng.integers(1, 1 << 63, union + 4, dtype=np.uint64)
        cut = rng.integers(0, union - common + 1) if union - common > 1 else 0
        for a, b in ((words, words[: common + 4]), (words[: union + 4 - cut], words[union - common - cut :])):
            if near_dup.alignment(near_dup.labelled(a), near_dup.labelled(b)) < 0.8:
                continue
            (x, whole_x, less_x), (y, whole_y, less_y) = near_dup.buckets(a, keys), near_dup.buckets(b, keys)
            assert set(x.tolist()) & set(y.tolist()) or whole_y in less_x or whole_x in less_y


def test_repeated_texts_are_linked(spark):
    rows, texts = [], []
    for i in range(12):
        text = [f"w{i}x{j}" for j in range(60 + 40 * i)]
        line = text[:12]
        for words in (text, 2 * text, 3 * text, 5 * text, text[:30] + 9 * line + text[30:]):
            rows.append((len(rows), " ".join(words)))
            texts.append(near_dup.labelled(near_dup.word_hashes(rows[-1][1].encode())))
    ship_package(spark)
    found = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    least = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if near_dup.alignment(texts[a], texts[b]) >= near_dup.LEAST:
                least = [min(least[a], least[b]) if c in (least[a], least[b]) else c for c in least]
    assert [found[i] for i in range(len(texts))] == least
    # a text and its repetition differ, two texts that repeat alike don't
    assert all(least[5 * i] != least[5 * i + 1] for i in range(12))


def test_labels_tell_occurrences_apart():
    a = near_dup.labelled(near_dup.word_hashes(b"a b c d e a b c d e a b c d e"))
    assert len(set(a.tolist())) == len(a) == 11
    once = near_dup.labelled(near_dup.word_hashes(b"a b c d e a b c d"))
    assert a[:5].tolist() == once.tolist()
    longer = near_dup.labelled(near_dup.word_hashes(b"x " + b"a b c d e " * 3))
    assert set(a.tolist()) <= set(longer.tolist())
    assert len(near_dup.labelled(np.zeros(0, np.uint64))) == 0


def test_markers_are_one_id():
    import public_tokenizers
    from tokenizers import Tokenizer

    codec, whole = packing.encoding(), Tokenizer.from_file(public_tokenizers.path(packing.WHOLE))
    mark = "<|endoftext|>"
    texts = [mark, f"{mark}{mark}", f"before {mark} after", f"in{mark}side", f" {mark}\n\n{mark} ", f"<|endoftext{mark}|>", "<|endoftext|", f"é{mark}  x"]
    for text in texts:
        assert packing.token_ids(codec, text) == whole.encode(text, add_special_tokens=False).ids
    assert packing.token_ids(codec, f"a {mark}").count(50256) == 1 and packing.token_ids(codec, None) == []


def test_spans_in_one_text_stay_apart():
    import time

    taken, began = [], time.time()
    rng = np.random.default_rng(3)
    offered = [("phone", int(a), int(a) + int(n)) for a, n in zip(rng.integers(0, 10**7, 60_000), rng.integers(1, 30, 60_000))]
    kept = [s for s in offered if pii._insert(taken, s)]
    assert time.time() - began < 5 and sorted(kept, key=lambda s: s[1]) == taken
    assert all(a[2] <= b[1] for a, b in zip(taken, taken[1:]))
    few = []
    assert [pii._insert(few, s) for s in (("a", 5, 9), ("b", 9, 11), ("c", 8, 10), ("d", 0, 5), ("e", 0, 20), ("f", 6, 7))] == [True, True, False, True, False, False]


def test_samples_are_bounded(spark):
    """A row repeated often counts once, and the others are still drawn."""
    rows = [(1, "same text", "en")] * 5000 + [(i, f"text {i}", "de" if i % 2 else "en") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = common.smallest_hashes(table, 50, F.lit(50 / 300), "x").collect()
    assert len(drawn) == len(set(drawn)) == 50
    per = collections.Counter(r.lang for r in common.smallest_hashes(table, 30, F.lit(1.0), "y", ["lang"]).collect())
    assert per == {"en": 30, "de": 30}


def test_alignment_sees_order():
    a = np.arange(1, 101, dtype=np.uint64)
    assert near_dup.alignment(a, a) == 1
    assert near_dup.alignment(a, np.r_[a[50:], a[:50]]) < 0.8
    assert near_dup.alignment(a, a[10:]) == pytest.approx(0.9)
    assert near_dup.alignment(a, a[30:]) == 0


def test_components(spark):
    edges = spark.createDataFrame([(f"{i:03d}".encode(), f"{i + 1:03d}".encode()) for i in range(40)] + [(b"x", b"y")], "a binary, b binary")
    found = {bytes(r.node): bytes(r.comp) for r in near_dup.components(edges).collect()}
    assert {found[f"{i:03d}".encode()] for i in range(41)} == {b"000"} and found[b"y"] == b"x"
    assert near_dup.components(edges.where("false")).count() == 0


def test_likelihood(spark, docs, none):
    whole = lattice_lm.score_documents(docs).collect()
    tail = lattice_lm.score_documents(docs, common=0).collect()
    assert len(whole) == len(tail) == len(TEXTS)
    key = lambda r: (str(r.doc_id), r.n_tokens)
    for a, b in zip(sorted(whole, key=key), sorted(tail, key=key)):
        assert key(a) == key(b) and a.n_known == b.n_known
        assert a.base_score == pytest.approx(b.base_score) and a.score == pytest.approx(b.score)
    assert {r.n_tokens for r in whole if r.doc_id in (3, 4, 5)} == {1}
    assert lattice_lm.score_documents(none).count() == 0
    unseen = docs.withColumn("held_out", F.lit(True))
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in lattice_lm.score_documents(unseen).collect())


def test_lattice_sums_all_segmentations():
    p = lattice_lm.Pieces({"▁": math.log(0.2), "a": math.log(0.3), "aa": math.log(0.1), "▁a": math.log(0.05)}, [math.log(0.01)] * 256, -1.0)
    assert math.exp(p.log_chance("aa")) == pytest.approx(0.2 * 0.3 * 0.3 + 0.2 * 0.1 + 0.05 * 0.3)
    assert math.exp(p.log_chance("é")) == pytest.approx(0.2 * 0.01**2)


def test_packing(docs, none):
    plan = packing.pack_documents(docs, size=64, group_rows=16)
    found = plan.collect()
    assert sum(r.length for r in found if r.start == 0 and r.doc_id == 3) == 1
    cut = packing.pieces(docs, size=64, with_ids=True).collect()
    assert len(cut) == len(found)
    built = {r.sequence_id: r.ids for r in packing.sequences(docs, plan, size=64).collect()}
    by_crc = {(r.doc_id, r.start, r.ids_crc32): r.ids for r in cut}
    for r in found:
        assert built[r.sequence_id][r.offset : r.offset + r.length] == by_crc[r.doc_id, r.start, r.ids_crc32]
    assert packing.pack_documents(none).count() == 0


def test_first_fit_decreasing_matches_a_scan():
    lengths = np.random.default_rng(1).integers(1, 101, 400)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(100)
        assert (bins[i], offsets[i]) == (b, 100 - room[b])
        room[b] -= int(lengths[i])


def test_rules(spark, docs, none):
    known = labels(spark, [(1, 1, "a"), (7, 0, "c"), (8, 0, "d"), (None, 1, "e"), (3, None, "f")])
    found = rules.judge(docs, known).collect()
    assert len(found) == len(TEXTS)
    assert all(r.base_failed and not r.kept for r in found if r.doc_id in (3, 4, 5, 6))
    assert rules.judge(docs, known.where("false")).where("not base_failed and not kept").count() == 0
    assert rules.judge(none, known).count() == 0


def test_rules_find_a_conjunction(spark):
    rows = spark.range(6000).select(
        *(((F.col("id") * (17 + i) % 101) / 101.0).alias(m) for i, m in enumerate(rules.MEASURES)), (F.col("id") % 3 != 0).alias("growing")
    )
    rows = rows.withColumn("bad", ((F.col("symbols") > 0.6) & (F.col("marks") <= 0.3)).cast("int"))
    learnt = rules.learn(rows)
    wrong = rows.where(rules.keeps(learnt) == (F.col("bad") == 1)).count()
    assert learnt and wrong < 0.1 * rows.where("bad = 1").count()


def test_languages(docs, none):
    model = langid.train(docs)
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert len(langid.predict(docs, model).collect()) == len(TEXTS)
    assert {found[i].lang_pred for i in (3, 4, 5, 6)} == {"und"} and found[3].score == 0
    assert all(0 <= r.score <= 1 for r in found.values()) and found[7].lang_pred == "en"
    assert {r.lang_pred for r in langid.predict(docs, langid.train(none)).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


def test_top_k(spark):
    vectors = [[0.5, -0.25], [0.5, -0.25], [1.0, 1.0], [-1.0, 0.5], [0.0, 0.0]]
    rows = [(i, v, "x") for i, v in enumerate(vectors * 30)]
    rows += [(500, None, "x"), (501, [None, 1.0], "x"), (502, [float("nan"), 1.0], "x"), (503, [float("inf"), 1.0], "x"), (504, [], "x"), (None, [1.0, 1.0], "x"), (505, [1.0], "x"), (0, [0.5, -0.25], "x")]
    ship_package(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found = vafile.top_k(df, F.col("vec_id") % 25 == 0, k=10)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in enumerate(vectors * 30)}
    want = {}
    for q in (i for i in whole if i % 25 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    assert got == want
    assert vafile.top_k(df.where("false"), F.lit(True)).count() == 0
    assert vafile.top_k(df.where("vec_id in (1, 2)"), F.lit(True)).count() == 2


def test_top_k_of_huge_components(spark):
    """Components whose products leave a long meet all others; scores beyond end at its ends."""
    rng = random.Random(4)
    vectors = [[rng.uniform(-3, 3) for _ in range(3)] for _ in range(60)]
    vectors += [[rng.choice((-1, 1)) * 10.0 ** rng.uniform(3, 16) for _ in range(3)] for _ in range(40)]
    vectors += [[1e13, 0.0, 1.0], [1e13, 1.0, -1.0], [-1e13, 0.5, 0.25], [1e300, 1.0, 1.0], [1e300, -1e300, 2.0], [2.0**52 + 1, 1.0, 0.0]]
    ship_package(spark)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vafile.top_k(df, F.col("vec_id") % 5 == 0, k=7).collect()}
    cap = 2**480
    whole = [[max(-cap, min(cap, math.floor(Fraction(x) * 1024))) for x in v] for v in vectors]
    want = {}
    for q in range(0, len(whole), 5):
        scores = {i: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[q], v)))) for i, v in enumerate(whole) if i != q}
        want |= {(q, n + 1): (i, scores[i]) for n, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i))[:7])}
    assert got == want


def test_language_counts_alike_by_both_ways(monkeypatch):
    """Short texts sort their buckets, long ones count in a table; the counts are the same."""
    texts = ["", "a", "aé", "Der Fuchs, der Fuchs", LONG[:5000], "\U0001f600 x" * 50]
    short = [langid.gram_counts(t) for t in texts]
    monkeypatch.setattr(langid, "FEW", 0)
    monkeypatch.setattr(langid, "STRETCH", 700)
    for (at, n), (same, also) in zip(short, (langid.gram_counts(t) for t in texts)):
        assert at.tolist() == same.tolist() and n.tolist() == also.tolist()
    assert sum(short[2][1]) == 3


@pytest.mark.parametrize("held", [1 << 18, 40])
def test_floors_run_over_the_blocks_of_a_lane(spark, held):
    ship_package(spark)
    draw = np.random.default_rng(5)
    m = draw.integers(-900, 900, (400, 12)).astype(float)
    m[200:240] = m[:40]
    df = spark.createDataFrame([(i, v.tolist(), False) for i, v in enumerate(m)], "vec_id long, v array<double>, wide boolean")
    grids = vafile._grids(df, 8)
    cells = vafile.approximations(df.coalesce(1), grids, 5, rows=25)
    asked = vafile.query_blocks(df.where("vec_id % 10 = 0").coalesce(1), rows=7).withColumnRenamed("ids", "q_ids")
    pairs = asked.join(cells.hint("merge"), "dim")
    found = vafile._bounds(pairs, grids, 5, held).collect()
    scores = m @ m.T
    assert all(r.low <= scores[r.query_id, r.vec_id] <= r.high for r in found)
    kept = {(r.query_id, r.vec_id) for r in found}
    assert len(kept) == len(found) < 40 * (12 if held > 40 else 60)
    for q in range(0, 400, 10):
        best = sorted((-s, i) for i, s in enumerate(scores[q]) if i != q)[:5]
        assert {(q, i) for _, i in best} <= kept
