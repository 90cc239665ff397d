"""Text likelihood over all segmentations into pieces of an existing vocabulary."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.session import cut_lineage

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Distinct words a task holds before it passes its counts on.
HELD = 200_000

_processors: dict[str, object] = {}


def processor(path: str | None = None):
    """The vocabulary, read once per worker."""
    import public_tokenizers
    import sentencepiece

    path = path or public_tokenizers.path(MODEL)
    if path not in _processors:
        _processors[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _processors[path]


def tokens(text: bytes) -> list[bytes]:
    """Words in order, A to Z in lower case."""
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every word (word, c, total) in rows of ``docs`` (text, held_out): in those
    not held out, and in all. Tasks add up what they read before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[Counter, Counter] = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(kept[0].keys() | kept[1].keys())
            c = [kept[0][w] for w in words]
            total = [x + kept[1][w] for x, w in zip(c, words)]
            kept[0].clear()
            kept[1].clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(total, pa.int64())], names=["word", "c", "total"]
            )

        for batch in batches:
            for text, out in zip(utf8(batch.column("text")), batch.column("held_out").to_pylist()):
                kept[out].update(tokens(text))
                if len(kept[0]) + len(kept[1]) > HELD:
                    yield flush()
        yield flush()

    return (
        docs.select("text", "held_out")
        .mapInArrow(count, "word binary, c long, total long")
        .groupBy("word")
        .agg(F.sum("c").alias("c"), F.sum("total").alias("total"))
    )


@dataclass
class Pieces:
    """Log chance of each piece, of a byte, and of the end of a text."""

    chances: dict[str, float]
    bytes: list[float]
    end: float

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.chances), default=1)

    def log_chance(self, word: str) -> float:
        """Log of the summed chances of all segmentations of a word and the mark before it.

        Forward recursion over end places; a character that is no piece is spelt in bytes.
        """
        s = MARK + word
        get, longest, log, exp = self.chances.get, self.longest, math.log, math.exp
        alpha = [0.0]
        for end in range(1, len(s) + 1):
            terms = []
            for start in range(max(0, end - longest), end):
                p = get(s[start:end])
                if p is not None:
                    terms.append(alpha[start] + p)
            c = s[end - 1]
            if c not in self.chances:
                terms.append(alpha[end - 1] + sum(self.bytes[b] for b in c.encode()))
            if len(terms) == 1:
                alpha.append(terms[0])
            else:
                top = max(terms)
                alpha.append(top + log(sum([exp(t - top) for t in terms])))
        return alpha[-1]


def fit_pieces(words: DataFrame, ends: int, path: str | None = None) -> Pieces:
    """Chances of the pieces from the vocabulary's scores and the training words.

    The vocabulary ranks its pieces: a piece of score -r has weight 1 / (r + 10), a byte the
    smallest weight. These weights, scaled to one count per piece on average, are added to how
    often the vocabulary itself uses each piece over all training words.
    """
    sp = processor(path)
    size = sp.get_piece_size()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = processor(path), np.zeros(size, np.int64)
        for batch in batches:
            spelt = model.encode([w.decode() for w in batch.column("word").to_pylist()], num_threads=1)
            weights = np.repeat(batch.column("c").to_numpy(), [len(s) for s in spelt])
            # whole numbers up to 2**53 stay exact as weights
            total += np.bincount(np.fromiter((i for s in spelt for i in s), np.int64), weights, size).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(at, pa.int32()), "n": total[at]})

    sums = words.where("c > 0").select("word", "c").mapInArrow(count, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    used = np.zeros(size)
    for r in sums.collect():  # at most one row a piece
        used[r.piece] = r.n
    kept = np.array([not (sp.is_control(i) or sp.is_unknown(i)) for i in range(size)])
    is_byte = np.array([sp.is_byte(i) for i in range(size)])
    prior = 1 / (10 - np.array([sp.get_score(i) for i in range(size)]))
    prior[is_byte] = prior[kept & ~is_byte].min()
    prior[~kept] = 0
    weight = np.where(kept, used, 0) + prior / prior.sum() * kept.sum()
    total = weight.sum() + ends + 1
    logs = np.log(np.maximum(weight, 1e-300) / total)
    spelling = [0.0] * 256
    for i in np.flatnonzero(is_byte):
        spelling[int(sp.id_to_piece(int(i))[3:5], 16)] = float(logs[i])
    chances = {sp.id_to_piece(int(i)): float(logs[i]) for i in np.flatnonzero(kept & ~is_byte)}
    return Pieces(chances, spelling, math.log((ends + 1) / total))


def _with_chance(words: DataFrame, pieces: Pieces) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(pieces)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_chance = shared.value.log_chance
        for batch in batches:
            p = [log_chance(w.decode()) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, "p"])

    return words.mapInArrow(score, "word binary, c long, total long, p double")


def _common(words: DataFrame, most: int) -> pa.Table:
    """The most frequent words, at most ``most``: all from the lowest power of two on that leaves no more."""
    levels = words.groupBy(F.floor(F.log2("total")).cast("int").alias("level")).count().collect()
    taken, least = 0, 64
    for r in sorted(levels, key=lambda r: -r.level):
        if taken + r["count"] > most:
            break
        taken, least = taken + r["count"], r.level
    return words.where(F.floor(F.log2("total")).cast("int") >= least).select("word", "c", "p").toArrow()


def score_documents(docs: DataFrame, path: str | None = None, common: int = 200_000) -> DataFrame:
    """Likelihood of every text of ``docs`` (doc_id, held_out, text), learnt from those not held out.

    n_tokens counts words and one end; n_known those seen in training; train_tokens all of
    training. base_score sums log10((c + 0.5) / (N + 0.5 (V + 1))); score is the log10
    probability of the text: the product over words of the chance of all their segmentations,
    times the chance of the end.

    Words are counted over the whole corpus. At most ``common`` frequent words are broadcast and
    summed where a text is read; of the rest each text passes its distinct words on, with their
    counts, to a join with the words. A null text is empty. Rows alike in id, split and text are
    scored once and each returned. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    words = cut_lineage(word_counts(docs))
    facts = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("c") > 0).cast("long")), F.lit(0)).alias("v")).first()
    ends = docs.where(~F.col("held_out")).count()
    n, v = facts.n + ends, facts.v + (ends > 0)
    pieces = fit_pieces(words, ends, path)
    scored = cut_lineage(_with_chance(words, pieces))
    width = n + 0.5 * (v + 1)
    head = _common(scored, common)
    frequent = spark.sparkContext.broadcast(
        (head.column("word").to_pylist(), head.column("c").to_numpy(), head.column("p").to_numpy())
    )
    ten = math.log(10)
    end = (math.log10((ends + 0.5) / width), pieces.end / ten)
    local: dict[int, dict] = {}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, c, p = frequent.value
        place = local.setdefault(0, {})
        if not place:
            place.update(zip(names, range(len(names))))
        base = np.log10((c + 0.5) / width)
        known, lattice = (c > 0).astype(np.int64), p / ten
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), utf8(batch.column("text")))
            ids, digests, outs, keys, times, sums = [], [], [], [], [], []

            def take() -> pa.RecordBatch:
                found = np.array(sums, dtype=float).reshape(-1, 4).T
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(outs, pa.bool_()), pa.array(keys, pa.binary()),
                        pa.array(times, pa.int64()), pa.array(found[0].astype(np.int64)), pa.array(found[1].astype(np.int64)), pa.array(found[2]), pa.array(found[3]),
                    ],
                    names=["doc_id", "digest", "held_out", "word", "times", "n_tokens", "n_known", "base", "lattice"],
                )

            for doc_id, out, text in rows:
                digest = xxhash.xxh3_64_intdigest(text) - (1 << 63)
                counts = Counter(tokens(text))
                at, many = [], []
                for word, k in counts.items():
                    i = place.get(word)
                    if i is None:
                        keys.append(word)
                        times.append(k)
                        sums.append((0, 0, 0.0, 0.0))
                    else:
                        at.append(i)
                        many.append(k)
                rare = len(keys) - len(ids)
                k = np.array(many, dtype=np.int64)
                # a row of sums per text; its key holds a blank and meets no word
                keys.append(b" %d" % digest)
                times.append(0)
                sums.append((sum(counts.values()) + 1, int(known[at] @ k) + (ends > 0), float(base[at] @ k) + end[0], float(lattice[at] @ k) + end[1]) if at else (sum(counts.values()) + 1, int(ends > 0), *end))
                ids += [doc_id] * (rare + 1)
                digests += [digest] * (rare + 1)
                outs += [out] * (rare + 1)
                if len(keys) > HELD:
                    yield take()
                    for x in (ids, digests, outs, keys, times, sums):
                        x.clear()
            yield take()

    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(
        read, "doc_id long, digest long, held_out boolean, word binary, times long, n_tokens long, n_known long, base double, lattice double"
    )
    met = parts.join(scored.select("word", "c", "p"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    own = F.log10((c + 0.5) / F.lit(float(width))) * F.col("times")
    sums = (
        met.groupBy("doc_id", "digest", "held_out")
        .agg(
            F.sum((F.col("n_tokens") > 0).cast("long")).alias("_rows"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(c > 0, F.col("times")).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + F.when(F.col("times") > 0, own).otherwise(0.0)).alias("base_score"),
            F.sum(F.col("lattice") + F.coalesce(F.col("p"), F.lit(0.0)) * F.col("times") / ten).alias("score"),
        )
        .withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    )
    return sums.select(
        "doc_id",
        "held_out",
        *(F.expr(f"{x} div _rows").alias(x) for x in ("n_tokens", "n_known")),
        F.lit(n).cast("long").alias("train_tokens"),
        *((F.col(x) / F.col("_rows")).alias(x) for x in ("base_score", "score")),
    )
