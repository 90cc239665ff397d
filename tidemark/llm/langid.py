"""Language identification by sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import smallest_hashes

BUCKETS = 1 << 16
LONGEST = 3
#: Characters hashed at once, so that a very long text needs no more memory than this.
STRETCH = 1 << 18
UNKNOWN = "und"
#: A text may be rejected whose share of known n-grams is less than this part of that of nearly
#: all texts of the learned languages, which no language has but a text of another script or none.
LEAST_KNOWN = 1 / 7


#: Hashes up to which a text's buckets are sorted instead of counted in a table of all.
FEW = 12_000


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in use, ascending, and occurrences of the hashed n-grams of one to three
    lower-cased characters."""
    text = text.lower()
    counts = None
    found: list[np.ndarray] = []
    for at in range(0, len(text), STRETCH):
        points = np.frombuffer(text[at : at + STRETCH + LONGEST - 1].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        h = np.zeros(len(points), dtype=np.uint32)
        for n in range(1, LONGEST + 1):
            if len(points) < n:
                break
            h = h[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] * np.uint32(0x9E3779B1) + np.uint32(n)
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            found.append((mixed[:STRETCH] >> np.uint32(16)).astype(np.uint16))
        if len(text) * LONGEST > FEW:
            part = np.bincount(np.concatenate(found), minlength=BUCKETS)
            counts, found = part if counts is None else counts + part, []
    if counts is not None:
        at = np.flatnonzero(counts)
        return at, counts[at]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, n = np.unique(np.concatenate(found), return_counts=True)
    return at.astype(np.int64), n


@dataclass
class Model:
    """Weights by bucket and language; empty without training rows."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    trained_on: int = 0
    least_known: float = 0.0

    def features(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF values of unit length of buckets in use; frequencies count by 1 + log."""
        x = (1 + np.log(counts)) * self.idf[at]
        return x / (np.sqrt(x @ x) or 1.0)

    def known(self, at: np.ndarray, x: np.ndarray) -> float:
        """Share of the squared TF-IDF values in buckets with a weight for any language."""
        return float((x * x) @ (self.weights[at] != 0).any(axis=1))

    def predict(self, text: str | None, reject: bool = False) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        at, counts = gram_counts(text)
        x = self.features(at, counts)
        if reject and self.known(at, x) < self.least_known:
            return UNKNOWN, 0.0
        p = softmax((x @ self.weights[at] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Number of texts that hold each bucket, over all rows; one partial count a task and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total[gram_counts(text or "")[0]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": total[at]})

    out = np.zeros(BUCKETS, dtype=np.int64)
    sums = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # at most BUCKETS rows
        out[r.bucket] = r.n
    return out


def _sample(labelled: DataFrame, per_language: int) -> tuple[list[str], list[tuple[int, np.ndarray, np.ndarray]]]:
    """Languages, and sparse counts of at most ``per_language`` texts of each, those of the
    smallest hashes; a row that repeats counts once."""
    totals = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(totals)
    if not languages:
        return [], []
    shares = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / totals[lang]))))
    drawn = smallest_hashes(labelled.select("doc_id", "text", "lang"), per_language, shares[F.col("lang")], "language", ["lang"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = [], []
            for text in batch.column("text").to_pylist():
                used, counts = gram_counts(text or "")
                at.append(used.astype(np.uint16))
                n.append(counts.astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {"lang": batch.column("lang"), "at": pa.array([x.tobytes() for x in at], pa.binary()), "n": pa.array([x.tobytes() for x in n], pa.binary())}
            )

    rows = drawn.select("lang", "text").mapInArrow(grams, "lang string, at binary, n binary").collect()
    number = {lang: i for i, lang in enumerate(languages)}
    sample = [(number[r.lang], np.frombuffer(bytes(r["at"]), np.uint16).astype(np.int64), np.frombuffer(bytes(r["n"]), np.int32)) for r in rows]
    sample.sort(key=lambda r: (r[1].tobytes(), r[2].tobytes(), r[0]))
    return languages, sample


def follow_the_leader(
    rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a softmax over sparse rows (class, buckets, values), by
    follow-the-regularised-leader with per-coordinate rates; the absolute penalty keeps
    weights at zero until their gradients add up to more than ``l1``."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def solve(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        lazy = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zs) <= l1, 0.0, lazy)

    order = np.random.default_rng(7)
    rows = [(y, np.append(at, BUCKETS), np.append(x, 1.0)) for y, at, x in rows]
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y, at, x = rows[i]
            w = solve(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            before = n[at]
            n[at] = before + g * g
            z[at] += g - (np.sqrt(n[at]) - np.sqrt(before)) / alpha * w
    w = solve(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss on rows kept out of training. Each class
    counts as seen once more than it was, so that rows without an error don't claim certainty."""
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 140))
    aims = (len(y) * np.eye(logits.shape[1])[y] + 1) / (len(y) + logits.shape[1])
    loss = [-(aims * np.log(softmax(logits / t) + 1e-12)).sum(axis=1).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, per_language: int = 600) -> Model:
    """Fit on rows of ``docs`` (doc_id, text, lang) that have a language.

    Document frequencies cover all rows given; weights are fitted on a sample of at most
    ``per_language`` whole texts of each language, drawn by hash, one in five of which sets
    the temperature and the least share of known n-grams only.
    """
    labelled = docs.where("lang is not null").select("doc_id", "text", "lang")
    languages, sample = _sample(labelled, per_language)
    if not sample:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    frequency = document_frequencies(labelled)
    total = max(1, int(frequency.max()))
    model = Model(languages, np.log((1 + total) / (1 + frequency)) + 1, np.zeros((BUCKETS, len(languages))), np.zeros(len(languages)))

    def row(y: int, at: np.ndarray, n: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        return y, at, model.features(at, n)

    rows = [row(*r) for r in sample]
    order = np.random.default_rng(3).permutation(len(rows))
    kept_out = [rows[i] for i in order[: len(rows) // 5]]
    fitted = [rows[i] for i in order[len(rows) // 5 :]]
    model.weights, model.bias = follow_the_leader(fitted, len(languages))
    if kept_out:
        logits = np.array([x @ model.weights[at] + model.bias for _, at, x in kept_out])
        model.temperature = _temperature(logits, np.array([y for y, _, _ in kept_out]))
        model.least_known = LEAST_KNOWN * float(np.quantile([model.known(at, x) for _, at, x in kept_out], 0.01))
    model.trained_on = len(fitted)
    model.weights = model.weights.astype(np.float32)
    return model


def predict(docs: DataFrame, model: Model, reject: bool = False) -> DataFrame:
    """The columns of ``docs`` with lang_pred and score, from the text alone.

    A null text, one without a letter, and every text if nothing was learned, is ``und`` with
    score 0; with ``reject`` so is one that hardly has an n-gram of the learned languages
    (``LEAST_KNOWN``). Equal chances go to the first language in alphabetical order. Columns of these two
    names are replaced. The model holds buckets times languages numbers and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*kept)
    if "text" not in kept:
        raise ValueError("documents need a text column")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(text, reject) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema)
