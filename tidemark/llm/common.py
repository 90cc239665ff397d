"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters other than blanks and the five ASCII line and tab controls.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id as text leaves ``part``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def smallest_hashes(rows: DataFrame, n: int, share: Column, salt: str, group: Sequence[str] = ()) -> DataFrame:
    """At most ``n`` distinct rows of each group, those of the smallest hashes.

    ``share`` is about ``n`` divided by the group's rows; hashes beyond eight times that share
    are passed over at the scan. Only hashes are compared; the rows of those chosen follow.
    """
    turns = 1 << 40
    kept = [*rows.columns]
    hashed = rows.withColumn("_hash", F.xxhash64(F.lit(salt), *kept))
    place = F.pmod(F.col("_hash"), F.lit(turns))
    low = hashed.where(place < F.least(share * 8, F.lit(1.0)) * turns)
    keys = low.select(*group, "_hash").distinct()
    first = Window.partitionBy(*group).orderBy(place, "_hash") if group else None
    chosen = keys.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= n) if group else keys.orderBy(place, "_hash").limit(n)
    return low.join(F.broadcast(chosen.select("_hash")), "_hash").dropDuplicates(["_hash"]).select(*kept)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of a string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a text with the start and end of each word."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[b]
    step = np.diff(inside)
    return b, np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word of a UTF-8 text, in text order."""
    b, starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _tables(len(b))
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit hash per run of ``k`` words; a shorter text has one shingle, an empty one none."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    n = max(1, len(words) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(min(k, len(words))):
        out = out * np.uint64(_BASE) + words[j : j + n]
    return mix(out)
