"""Text quality from compression with dictionaries of good and of bad text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8

LEVEL = 3
STRETCH = 256
DICTIONARY = 112_640
#: Bytes at which the size difference weighs as much as the share of good labels.
EVEN = 64


def stretches(text: bytes) -> list[bytes]:
    return [text[i : i + STRETCH] for i in range(0, len(text), STRETCH)]


def dictionary(texts: list[bytes], most: int, seed: int = 11) -> bytes:
    """A zstandard dictionary of about 110 KB from up to ``most`` stretches of whole texts; few
    samples become the dictionary's content as they are."""
    parts = [p for t in texts for p in stretches(t)]
    order = np.random.default_rng(seed).permutation(len(parts))[:most]
    samples = [parts[i] for i in order]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


@dataclass
class Model:
    """Dictionaries, the two numbers that turn a size difference into log odds, and the log odds
    of the labels, which a text too short to show a difference falls back to."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    shift: float = 0.0
    prior: float = 0.0

    def __post_init__(self) -> None:
        self._pair = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": None}

    def difference(self, text: bytes) -> float:
        """Compressed bytes more with the bad than with the good dictionary, per byte of text;
        stretches are compressed apart, so that the dictionaries weigh alike in any text."""
        if not text or not self.good or not self.bad:
            return 0.0
        if self._pair is None:
            self._pair = _compressor(self.good), _compressor(self.bad)
        good, bad = self._pair
        return sum(len(bad.compress(p)) - len(good.compress(p)) for p in stretches(text)) / len(text)

    def score(self, text: bytes) -> float:
        part = len(text) / (len(text) + EVEN)
        return chance(part * (self.slope * self.difference(text) + self.shift) + (1 - part) * self.prior)


def chance(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with a weak penalty on the slope."""
    scale = float(x.std()) or 1.0
    d = np.c_[x / scale, np.ones(len(x))]
    w = np.zeros(2)
    loss = lambda w: np.logaddexp(0, np.where(y == 1, -1, 1) * (d @ w)).sum() + 0.005 * w[0] ** 2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -40, 40)))
        slope = d.T @ (p - y) + np.array([0.01 * w[0], 0])
        step = np.linalg.solve(d.T @ (d * (p * (1 - p))[:, None]) + np.diag([0.01, 1e-6]), slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, most_stretches: int = 8000) -> Model:
    """Fit on rows of ``docs`` (doc_id, text) with a quality in ``labels``.

    Of each quality the ``per_class`` labelled ids of the smallest hashes are drawn and broadcast;
    one whole text of each, the smallest if an id repeats, comes to the driver. Half of them build the dictionaries, the others, weighted
    back to the shares in ``labels``, set the calibration. Null ids and qualities are left out;
    if an id repeats in ``labels``, its lowest quality counts. Without both classes the score
    is the share of good labels, one half without labels.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    totals = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    good, bad = totals.get(1, 0), totals.get(0, 0)
    prior = math.log((good + 0.5) / (bad + 0.5))
    if not good or not bad:
        prior = prior if good or bad else 0.0
        return Model(shift=prior, prior=prior)
    by_hash = (F.xxhash64(F.lit("quality"), "doc_id"), F.col("doc_id"))
    drawn = reduce(DataFrame.unionByName, (known.where(F.col("quality") == q).orderBy(*by_hash).limit(per_class) for q in (1, 0)))
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = sorted((r.doc_id, (r.text or "").encode(), r.quality) for r in texts.collect())
    order = np.random.default_rng(5).permutation(len(rows)).tolist()
    build, rest = [rows[i] for i in order[::2]], [rows[i] for i in order[1::2]]
    texts = {q: [t for _, t, quality in build if quality == q] for q in (0, 1)}
    if not all(any(t) for t in texts.values()):
        return Model(shift=prior, prior=prior)
    model = Model(dictionary(texts[1], most_stretches), dictionary(texts[0], most_stretches), prior=prior)
    x, y = np.array([model.difference(t) for _, t, _ in rest]), np.array([q for _, _, q in rest])
    if len(set(y.tolist())) < 2:
        model.shift = prior
        return model
    model.slope, shift = calibrate(x, y)
    model.shift = shift + prior - math.log(y.sum() / (len(y) - y.sum()))
    return model


def predict(docs: DataFrame, model: Model, bound: float = 0.3) -> DataFrame:
    """The columns of ``docs`` with score and predicted, from the text alone.

    A null text is empty; an empty text gets the share of good labels. Columns of these two names are replaced. The model, two dictionaries, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(c for c in docs.columns if c not in ("score", "predicted")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([shared.value.score(t) for t in utf8(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= bound).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return rows.mapInArrow(run, schema)
