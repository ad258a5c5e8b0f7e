"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekin.staging import new_path

#: A word is a run of characters other than space and the five ASCII line and tab characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to a thousand rows: whole texts make large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    known = int(df.sparkSession.conf.get(name, "10000"))
    if known <= 0 or known > 1000:
        df.sparkSession.conf.set(name, "1000")
    return df


def stage_packed(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder, tightly packed, and return a reader of it."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are hashed together, so that short texts share the cost of a call.
GROUP_BYTES = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A number per byte, A-Z as a-z.
_VALUE = mixed(np.array([c + 33 if 65 <= c <= 90 else c + 1 for c in range(256)], dtype=np.uint64))
_WEIGHTS = np.array([(2 * k + 1) * 0xD6E8FEB86659FD93 % (1 << 64) | 1 for k in range(1, 17)], dtype=np.uint64)
_factors = np.ones(0, dtype=np.uint64)


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of ``data``.

    Each byte's number is multiplied by an odd factor of its place in the word; factors are
    unrelated numbers, not powers, so no pattern of bytes cancels out.  A running sum
    gives all words as differences: no loop over words.
    """
    global _factors
    raw = np.frombuffer(data, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(~_SPACE[raw], prepend=False, append=False))
    starts, ends = edges[0::2], edges[1::2]
    if not starts.size:
        return starts, np.zeros(0, dtype=np.uint64)
    longest = int((ends - starts).max())
    if longest > _factors.size:
        size = max(2 * longest, 1 << 12)
        _factors = mixed(np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
    letters = raw[np.repeat(starts, lengths) + place]
    total = np.add.reduceat(_VALUE[letters] * _factors[place], before)
    return starts, mixed(total + lengths.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    value = words[: words.size - size + 1] * _WEIGHTS[0]
    for j in range(1, size):
        value = value + words[j : words.size - size + 1 + j] * _WEIGHTS[j]
    return mixed(value + np.uint64(size))


def shingle_sets(texts: Iterable[bytes | None], size: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``size``-word shingles, A-Z lower-cased.

    Fewer words count as one shingle; a text without words, or null, has none.
    """
    group: list[bytes] = []
    held = 0
    for text in texts:
        group.append(text or b"")
        held += len(group[-1]) + 1
        if held >= GROUP_BYTES:
            yield from _group_sets(group, size)
            group, held = [], 0
    yield from _group_sets(group, size)


def _group_sets(group: list[bytes], size: int) -> Iterator[np.ndarray]:
    if not group:
        return
    starts, words = _words(b"\n".join(group))
    bounds = np.cumsum([0, *(len(t) + 1 for t in group)])
    first = np.searchsorted(starts, bounds)
    values = _shingles(words, size) if words.size >= size else words[:0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(values[a : b - size + 1])
        else:
            yield _shingles(words[a:b], b - a) if b > a else words[:0]
