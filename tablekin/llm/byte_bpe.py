"""Byte-level BPE encoding and decoding with a rank queue of hierarchical bitmaps.

A text is cut into pre-tokens by the vocabulary's pattern and the bytes of each are
merged on their own, always the pair of the lowest rank, the leftmost of equals.  The
pairs that wait are held in one bucket of positions per rank; a bitmap of three levels
(64 children per word) marks the ranks whose buckets are filled, so the next rank is
three find-first-set steps away however long the pre-token is.  Positions belong to a
linked list of tokens; an entry whose pair has changed meanwhile is skipped when it
comes up.  A pre-token of n bytes costs about n log n, never n squared.

Ids are kept as little-endian unsigned 32-bit integers in a binary column.  Both
directions are done row by row in Arrow batches: nothing is shuffled.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekin.llm.common import small_batches

#: Pre-tokens whose ids a Python worker keeps; the store is emptied when it is full.
CACHE_PIECES = 800_000
#: Pre-tokens of more bytes are merged anew each time.
CACHE_BYTES = 64
#: Bytes of ids or text after which a batch of results is handed on.
OUT_BYTES = 32 << 20
#: Characters whose pre-tokens are listed at once; a longer text is read this many pre-tokens at a time.
LIST_CHARS, LIST_PIECES = 1 << 20, 1 << 17


class RankQueue:
    """Positions by rank.

    One heap of positions per rank in use, and a bitmap over the ranks: a word's bits say which of 64 ranks, or
    of 64 words of the level below, are in use.
    """

    def __init__(self, ranks: int):
        sizes = [ranks]
        while sizes[-1] > 1:
            sizes.append((sizes[-1] + 63) // 64)
        self.levels = [[0] * n for n in sizes[1:]] or [[0]]
        self.buckets: dict[int, list[int]] = {}

    def fill(self, rank: int, positions: list[int]) -> None:
        """Open the bucket of a rank not in use with ascending ``positions``."""
        self.buckets[rank] = positions
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            filled = level[word]
            level[word] = filled | bit
            if filled:
                return
            rank = word

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.fill(rank, [position])
        else:
            heappush(bucket, position)

    def lowest(self) -> int:
        """The least rank in use, or -1: the first set bit of each level from the top."""
        rank = 0
        for level in reversed(self.levels):
            bits = level[rank]
            if not bits:
                return -1
            rank = rank << 6 | (bits & -bits).bit_length() - 1
        return rank

    def close(self, rank: int) -> None:
        """Give up the empty bucket of ``rank``."""
        del self.buckets[rank]
        for level in self.levels:
            word = rank >> 6
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                return
            rank = word


class Vocabulary:
    """Token ids by bytes, read from lines of base64 text and rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            read = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in read}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing}")
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.queue = RankQueue(size)
        # Ranks of pairs of ids, by id << shift | id, and of pairs of bytes as a table.
        self.shift = size.bit_length()
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << self.shift | right] = rank
        self.bytes = np.full((256, 256), -1, dtype=np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.bytes[token[0], token[1]] = rank

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian ids of each non-empty pre-token; all go through one queue.

        Pre-tokens do not touch each other, so the least rank of all is the least of its own.
        """
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = data.size
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(lengths)
        first = np.full(n, -1, dtype=np.int64)
        first[:-1] = self.bytes[data[:-1], data[1:]]
        first[ends - 1] = -1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1], before[ends - lengths] = n, -1
        # Plain lists are quick; those of a very long text would take too much memory.
        plain = n <= LIST_CHARS
        token, waiting, after, before = (
            x.tolist() if plain else array("q", x.astype(np.int64).tobytes()) for x in (self.single[data], first, after, before)
        )
        place = np.flatnonzero(first >= 0)
        place = place[np.argsort(first[place], kind="stable")]
        starts = np.flatnonzero(np.diff(first[place], prepend=-1))
        for rank, bucket in zip(first[place[starts]].tolist(), np.split(place, starts[1:]), strict=False):
            self.queue.fill(rank, bucket.tolist())
        self._run(token, waiting, after, before, n)
        ids = np.array(token, dtype=np.int64)
        alive = np.concatenate([[0], np.cumsum(ids >= 0)])
        packed = ids[ids >= 0].astype("<u4").tobytes()
        bounds = (4 * alive[np.concatenate([[0], ends])]).tolist()
        return [packed[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _run(self, token, waiting, after, before, n: int) -> None:
        """Merge until no pair waits; the right part of a merged pair is marked by the id -1."""
        pairs, shift, queue = self.pairs, self.shift, self.queue
        buckets, push = queue.buckets, queue.push
        while (rank := queue.lowest()) >= 0:
            bucket = buckets[rank]
            while bucket:
                i = heappop(bucket)
                if waiting[i] != rank:
                    continue
                gone = after[i]
                right, left = after[gone], before[i]
                token[i], token[gone] = rank, -1
                waiting[i] = waiting[gone] = -1
                after[i] = right
                least = rank
                if right < n:
                    before[right] = i
                    new = pairs.get(rank << shift | token[right])
                    if new is not None:
                        waiting[i] = new
                        push(new, i)
                        least = new
                if left >= 0:
                    new = pairs.get(token[left] << shift | rank)
                    if new is None:
                        waiting[left] = -1
                    else:
                        waiting[left] = new
                        push(new, left)
                        if new < least:
                            least = new
                if least < rank:
                    break
            if not bucket:
                queue.close(rank)


def _ranges(points: list[int]) -> str:
    """A pattern's class body that lists ``points``."""
    out, k = [], 0
    while k < len(points):
        end = k
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out.append(f"\\U{points[k]:08x}-\\U{points[end]:08x}")
        k = end + 1
    return "".join(out)


def _splitters(pattern: str):
    """(the pattern, characters that need care or None, the pattern with them read as the library reads them).

    Letters and numbers are those of tiktoken's edition of Unicode, which may be older
    or newer than that of ``regex``; classes of the library are asked once per worker.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    odd: set[str] = set()
    exact = pattern
    for name in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding("class", pat_str=name + "+", mergeable_ranks=single, special_tokens={})
        theirs = set(probe.decode_bytes(probe.encode_ordinary(every)).decode("utf-8"))
        ours = set(regex.findall(name, every))
        more, less = sorted(map(ord, theirs - ours)), sorted(map(ord, ours - theirs))
        odd |= theirs ^ ours
        body = f"[{name}{_ranges(more)}]"
        exact = exact.replace(name, f"[{body}--[{_ranges(less)}]]" if less else body)
    # The standard module looks a character up in a table, however many ranges a class has.
    care = re.compile(f"[{_ranges(sorted(map(ord, odd)))}]") if odd else None
    return regex.compile(pattern), care, regex.compile(exact, flags=regex.V1)


class Coder(dict):
    """Ids of pre-tokens as bytes; those not met before are merged together."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.key = (path, pattern)
        self.vocabulary = Vocabulary(path)
        self.plain, self.care, self.exact = _splitters(pattern)
        # Encoding is a quicker look at all characters than searching.
        self.careless = self.care and not self.care.search("".join(map(chr, range(256))))

    def _splitter(self, text: str):
        if self.care is None or text.isascii():
            return self.plain
        if self.careless:
            try:
                text.encode("latin-1")
                return self.plain
            except UnicodeEncodeError:
                pass
        return self.exact if self.care.search(text) else self.plain

    def _ids(self, groups: list[list[str]]) -> list[bytes]:
        """Ids of each list of pre-tokens."""
        met = set().union(*groups)
        new = met.difference(self)
        if len(self) + len(new) > CACHE_PIECES:
            self.clear()
            new = met
        ranks, rest = self.vocabulary.ranks, []
        for piece in new:
            data = piece.encode("utf-8")
            rank = ranks.get(data)
            if rank is None:
                rest.append((piece, data))
            else:
                self[piece] = rank.to_bytes(4, "little")
        if rest:
            for (piece, _), ids in zip(rest, self.vocabulary.merge([data for _, data in rest]), strict=True):
                self[piece] = ids
        out = [b"".join(map(self.__getitem__, pieces)) for pieces in groups]
        for piece, data in rest:
            if len(data) > CACHE_BYTES:
                del self[piece]
        return out

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text; pre-tokens of ``LIST_CHARS`` characters of text are held at once."""
        groups, held = [], 0
        for text in texts:
            if len(text) > LIST_CHARS:
                yield from self._ids(groups)
                groups, held = [], 0
                pieces = (m.group() for m in self._splitter(text).finditer(text))
                yield b"".join(self._ids([part])[0] for part in iter(lambda: list(islice(pieces, LIST_PIECES)), []))
                continue
            groups.append(self._splitter(text).findall(text))
            held += len(text)
            if held > LIST_CHARS:
                yield from self._ids(groups)
                groups, held = [], 0
        if groups:
            yield from self._ids(groups)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_coder: Coder | None = None


def _coder_of(path: str, pattern: str) -> Coder:
    global _coder
    if _coder is None or _coder.key != (path, pattern):
        _coder = Coder(path, pattern)
    return _coder


def _pieces_of(batch: pa.RecordBatch, column: int, convert, names: list[str]) -> Iterator[pa.RecordBatch]:
    """``batch`` with ``convert`` of the given column added, cut so that no part grows large."""
    out, first, held = [], 0, 0
    for k, value in enumerate(convert(x.as_py() for x in batch.column(column))):
        out.append(value)
        held += len(out[-1])
        if held >= OUT_BYTES or k == batch.num_rows - 1:
            kept = batch.slice(first, k + 1 - first)
            columns = [*(c for j, c in enumerate(kept.columns) if j != column or names[column]), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in names if n])
            out, first, held = [], k + 1, 0


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens long, ids binary) of every row of ``docs`` (doc_id, text).

    ``path`` names a file of base64 tokens and ranks that every executor can open, and
    ``pattern`` cuts texts into pre-tokens.  Nothing in a text is a special token.  A null
    text is empty and an empty text has no ids.  Rows that repeat an id or have none
    give a row each; an empty table gives none; other columns are not looked at.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder_of(path, pattern)
        for batch in batches:
            yield from _pieces_of(batch, 1, lambda texts: coder.encode_all(t or "" for t in texts), ["doc_id", "", "ids"])

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(encode, "doc_id long, ids binary")
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded binary): the bytes that the ids of each row stand for.

    A null list of ids is an empty one.  An id that the vocabulary lacks is an error.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder_of(path, pattern)
        for batch in batches:
            yield from _pieces_of(batch, 2, lambda ids: (coder.decode(x or b"") for x in ids), ["doc_id", "n_tokens", "ids", "decoded"])

    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(decode, "doc_id long, n_tokens long, ids binary, decoded binary")
