"""Token ids of a corpus as one concatenated array with Elias-Fano document boundaries.

File format (``write_token_files``): a folder of parquet files, each with rows
that hold one block of consecutive documents.  Parquet is only the container, so
any store that Spark reaches will do.

    part         int      number of the file's range of doc_ids
    block        int      number of the block within its part
    first        long     ids of the part before this block
    n_docs, n_ids  long   documents and ids of the block
    doc_ids      binary   little-endian int64, one per document
    null_ids     binary   bit map of null doc_ids (little bit order), empty if none
    ids          binary   little-endian uint16, or uint32 where an id needs it
    width        int      bytes per id, 2 or 4
    low_bits     int      l
    low          binary   l low bits of every end offset, packed
    high         binary   unary coded high parts: bit (end >> l) + i is set for document i
    selects      binary   uint32 position of every 256th set bit of ``high``

The ends of n documents over u ids take 2 + log2(u / n) bits each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekin.llm.common import partitions_of, small_batches
from tablekin.staging import new_path

SELECT_EVERY = 256
#: Ids of a block, beyond which it is closed; a longer document fills one block alone.
BLOCK_IDS = 1 << 18
#: Words whose ids a Python worker keeps, about 200 bytes each; the first it meets, so the frequent ones.
CACHE_WORDS = 600_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

FORMAT = (
    "part int, block int, first long, n_docs long, n_ids long, doc_ids binary, null_ids binary, ids binary, "
    "width int, low_bits int, low binary, high binary, selects binary"
)


# ---- Elias-Fano ---------------------------------------------------------------------


def ef_encode(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(l, low, high, selects) of the non-decreasing ``ends``."""
    n = ends.size
    universe = int(ends[-1]) if n else 0
    width = max(0, (universe // n).bit_length() - 1) if n else 0
    values = ends.astype(np.uint64)
    low = np.zeros(0, dtype=np.uint8)
    if width and n:
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
    bits[places] = 1
    high = np.packbits(bits, bitorder="little")
    return width, low.tobytes(), high.tobytes(), places[::SELECT_EVERY].astype("<u4").tobytes()


class EliasFano:
    """Reads what ``ef_encode`` has written."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, selects: bytes):
        self.n, self.width = n, width
        self.low = np.frombuffer(low, dtype=np.uint8)
        self.high = np.frombuffer(high, dtype=np.uint8)
        self.selects = np.frombuffer(selects, dtype="<u4")

    def _low(self, i: np.ndarray) -> np.ndarray:
        value = np.zeros(i.size, dtype=np.int64)
        for k in range(self.width):
            place = i * self.width + k
            value |= ((self.low[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(np.int64) << k
        return value

    def select(self, i: int) -> int:
        """The i-th value, by the nearest sample and a scan of at most 256 set bits."""
        place = int(self.selects[i // SELECT_EVERY])
        left, byte = i % SELECT_EVERY, place >> 3
        word = int(self.high[byte]) >> (place & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            place, word = byte << 3, int(self.high[byte])
        while True:
            if word & 1:
                if not left:
                    break
                left -= 1
            word >>= 1
            place += 1
        return (place - i << self.width) | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        index = np.arange(self.n)
        return (places - index << self.width) | self._low(index)


# ---- writing ------------------------------------------------------------------------


class _WordIds(dict):
    """Ids of words as bytes; a word comes between white space and never joins its neighbours."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.path, self.tokenizer = path, Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def __missing__(self, word: bytes) -> bytes:
        # Variants of a word share its ids: ASCII capitals fold (a following combining mark forbids it), and
        # ASCII punctuation behind letters is a token run of its own unless it starts a contraction.
        value, low = None, word.lower()
        core = low.rstrip(PUNCTUATION)
        if b"<|" not in word and b"\xcc" not in word and b"\xcd" not in word:
            if core and core != low and low[len(core)] != 0x27 and core.decode("utf-8").lower().isalpha():
                value = self[core] + self[low[len(core) :]]
            elif low != word:
                value = self[low]
        if value is None:
            ids = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
            value = np.array(ids, dtype=self.kind).tobytes()
        if len(self) < (CACHE_WORDS if word == core else CACHE_WORDS // 2):
            self[word] = value
        return value


_words: _WordIds | None = None


def _word_ids(path: str) -> _WordIds:
    global _words
    if _words is None or _words.path != path:
        _words = _WordIds(path)
    return _words


def _block(part: int, number: int, first: int, ids: list[bytes], keys: list[int | None], size: int) -> dict:
    ends = np.cumsum([len(x) // size for x in ids], dtype=np.int64)
    width, low, high, selects = ef_encode(ends)
    nulls = np.array([k is None for k in keys])
    return {
        "part": part,
        "block": number,
        "first": first,
        "n_docs": len(ids),
        "n_ids": int(ends[-1]),
        "doc_ids": np.array([k or 0 for k in keys], dtype="<i8").tobytes(),
        "null_ids": np.packbits(nulls, bitorder="little").tobytes() if nulls.any() else b"",
        "ids": b"".join(ids),
        "width": size,
        "low_bits": width,
        "low": low,
        "high": high,
        "selects": selects,
    }


def _writer(path: str, end_id: int, block_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema(
            [(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in FORMAT.split(", "))]
        )
        part = TaskContext.get().partitionId()
        number = first = held = 0
        ids, keys = [], []
        words = _word_ids(path)
        for batch in batches:
            size = int(words.kind[-1])
            end = np.array([end_id], dtype=words.kind).tobytes()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # bytes.split() cuts at ASCII white space only
                row = b"".join(map(words.__getitem__, (text.as_py() or b"").split())) + end
                ids.append(row)
                keys.append(key)
                held += len(row) // size
                if held >= block_ids:
                    yield pa.RecordBatch.from_pylist([_block(part, number, first, ids, keys, size)], schema)
                    number, first, held, ids, keys = number + 1, first + held, 0, [], []
        if ids:
            yield pa.RecordBatch.from_pylist([_block(part, number, first, ids, keys, size)], schema)
        pa.default_memory_pool().release_unused()

    return write


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, parts: int | None = None, block_ids: int = BLOCK_IDS
) -> str:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order and write the files to ``folder``.

    Texts are shuffled once, into ranges of doc_ids; each task encodes its sorted
    range word by word (white space always separates tokens of this kind of
    vocabulary; equal words are encoded once per worker) and closes a block every
    ``block_ids`` ids, so memory holds one block.  A null text is empty and gives the
    end id alone; null ids come first; rows with equal ids are ordered by text.
    """
    docs = small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.repartitionByRange(parts or partitions_of(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_writer(tokenizer_path, end_id, block_ids), FORMAT).write.mode("overwrite").option(
        "compression", "none"
    ).parquet(folder)
    return folder


# ---- reading ------------------------------------------------------------------------


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            n, size = row["n_docs"], row["width"]
            ends = EliasFano(n, row["low_bits"], row["low"], row["high"], row["selects"]).all()
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            ids = np.frombuffer(row["ids"], dtype=f"<u{size}").astype("<u4")
            keys = np.frombuffer(row["doc_ids"], dtype="<i8")
            missing = np.unpackbits(np.frombuffer(row["null_ids"], dtype=np.uint8), bitorder="little")[:n].astype(bool)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, mask=missing if missing.size else None),
                    pa.array(starts + row["first"]),
                    pa.array(ends - starts),
                    pa.array(crcs, type=pa.int64()),
                    pa.array(np.full(n, row["part"], dtype=np.int32)),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "part"],
            )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (over all files), n_tokens and ids_crc32.

    ``start`` adds the ids of earlier parts; that table has one row per file.
    """
    blocks = spark.read.parquet(folder)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("part").alias("base_part"), F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("base"))
    rows = blocks.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long, part int")
    joined = rows.join(F.broadcast(bases), rows["part"] == bases["base_part"])
    return joined.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def token_binary(docs: DataFrame, tokenizer_path: str, end_id: int = 2, **options) -> DataFrame:
    """Write ``docs`` to a new folder of the shared place, and the documents as read back from it.

    An empty table gives no rows.  Columns besides doc_id and text are not looked at.
    """
    spark = docs.sparkSession
    folder = write_token_files(docs, tokenizer_path, new_path(spark, "tokens"), end_id, **options)
    return read_token_files(spark, folder)
