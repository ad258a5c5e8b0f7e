"""Benchmark decontamination: BM25 retrieval with block-max WAND, then overlap checks.

Test items form an inverted index whose lists are cut into blocks of items; a block
stores the largest contribution a term can make in it.  Every passage of a text is a
query.  A bound from the terms' largest contributions discards most passages; for the
others WAND moves over the lists block by block and scores only items that can pass
the threshold.  Every item found is then verified on word n-grams of its question and
its answer against the text around the passage.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekin.llm.common import small_batches

#: Words of a passage and the step between passages: every run of 32 words lies within one.
PASSAGE, STEP = 64, 32
K1, B = 1.2, 0.75
BLOCK_ITEMS = 32
#: A passage is near an item if it scores this share of what the item's own words score (at most PASSAGE of them).
NEAR = 0.6
#: A word is rare if at most this share of the items, or two, hold it.
RARE_SHARE = 0.05
#: Words of the n-grams that verify an item, and the shares of question and answer that must be found.
GRAM = 4
QUESTION_SHARE, ANSWER_SHARE, WHOLE_SHARE = 0.5, 0.5, 0.7
#: Items and words of one index: larger test sets are searched in several passes.
INDEX_ITEMS, INDEX_WORDS = 20_000, 4_000_000

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """An item's last sentence is its answer, what stands before is its question; one sentence is halved."""
    parts = [w for p in SENTENCE.split(text or "") if (w := words_of(p))]
    while len(parts) > 2 and len(parts[-1]) < GRAM:
        parts[-2:] = [parts[-2] + parts[-1]]
    if len(parts) > 1 and len(parts[-1]) >= GRAM:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = [w for p in parts for w in p]
    return words[: len(words) // 2], words[len(words) // 2 :]


def _grams(words: list[str]) -> set[tuple[str, ...]]:
    size = min(GRAM, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if size else set()


@dataclass
class Index:
    """Lists of (item, contribution) sorted by item, with the block maxima; items' grams and thresholds."""

    keys: list[int]
    terms: dict[str, int]
    lists: list[tuple[np.ndarray, np.ndarray]]
    blocks: list[tuple[list[int], list[float]]]
    largest: np.ndarray
    need: np.ndarray
    least: float
    #: Largest contributions of rare words alone, and what an item needs of them at least, as its other
    #: words cannot give more than the item's own share; items without that need, and what they need.
    rare: np.ndarray
    rare_posts: dict[int, list[tuple[int, float]]]
    least_terms: int
    rest: list[float]
    least_rare: float
    least_common: float
    question: list[set]
    answer: list[set]


def build_index(items: list[tuple[int, str]]) -> Index:
    items = [(k, t) for k, t in items if words_of(t)]
    words = [words_of(t) for _, t in items]
    mean = sum(map(len, words)) / max(1, len(words))
    frequency = Counter(w for ws in words for w in set(ws))
    idf = {w: math.log(1 + (len(items) - n + 0.5) / (n + 0.5)) for w, n in frequency.items()}
    lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
    need, rest = [], []
    often = max(2, RARE_SHARE * len(items))
    for k, ws in enumerate(words):
        count = Counter(ws)
        own = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(ws) / mean)) for w, n in count.items()}
        for w, value in own.items():
            lists[w].append((k, value))
        # a passage holds at most PASSAGE words of an item
        need.append(NEAR * sum(own.values()) * min(1.0, PASSAGE / len(ws)))
        rest.append(need[-1] - sum(v for w, v in own.items() if frequency[w] > often))
    terms = {w: k for k, w in enumerate(lists)}
    arrays = [(np.array([i for i, _ in v]), np.array([c for _, c in v])) for v in lists.values()]
    blocks = []
    for who, value in arrays:
        starts = range(0, len(who), BLOCK_ITEMS)
        blocks.append(([int(who[min(s + BLOCK_ITEMS, len(who)) - 1]) for s in starts], [float(value[s : s + BLOCK_ITEMS].max()) for s in starts]))
    largest = np.array([v.max() for _, v in arrays] + [0.0])
    rare = np.where(np.array([frequency[w] <= often for w in lists] + [False]), largest, 0.0)
    rare_posts = {k: list(zip(who.tolist(), value.tolist(), strict=True)) for k, (who, value) in enumerate(arrays) if rare[k]}
    least_rare = min((r for r in rest if r > 0), default=math.inf)
    least_terms = math.ceil(least_rare / rare.max()) if rare.any() and least_rare < math.inf else 1
    pairs = [question_and_answer(t) for _, t in items]
    return Index(
        [k for k, _ in items],
        terms,
        arrays,
        blocks,
        largest,
        np.array(need),
        min(need, default=math.inf),
        rare,
        rare_posts,
        least_terms,
        rest,
        least_rare,
        min((n for n, r in zip(need, rest, strict=True) if r <= 0), default=math.inf),
        [_grams(q) for q, _ in pairs],
        [_grams(a) for _, a in pairs],
    )


class Cursor:
    """A place in one inverted list."""

    def __init__(self, index: Index, term: int):
        self.items, self.values = index.lists[term]
        self.ends, self.maxima = index.blocks[term]
        self.largest = float(index.largest[term])
        self.at = 0

    @property
    def item(self) -> float:
        return int(self.items[self.at]) if self.at < len(self.items) else math.inf

    def seek(self, item: float) -> None:
        if item is math.inf:
            self.at = len(self.items)
        elif self.item < item:
            self.at += int(np.searchsorted(self.items[self.at :], item))

    def block(self, item: int) -> tuple[float, float]:
        """Maximum of the block that would hold ``item``, and the block's last item."""
        k = int(np.searchsorted(self.ends, item))
        return (self.maxima[k], self.ends[k]) if k < len(self.ends) else (0.0, math.inf)


def retrieve(index: Index, terms: set[int], threshold: float) -> list[tuple[int, float]]:
    """All items that score at least ``threshold`` for a passage's terms, by block-max WAND."""
    cursors = [Cursor(index, t) for t in terms]
    found = []
    while True:
        cursors = sorted((c for c in cursors if c.item != math.inf), key=lambda c: c.item)
        bound, pivot = 0.0, None
        for k, c in enumerate(cursors):
            bound += c.largest
            if bound >= threshold:
                pivot = k
                break
        if pivot is None:
            return found
        item = cursors[pivot].item
        while pivot + 1 < len(cursors) and cursors[pivot + 1].item == item:
            pivot += 1
        tops = [c.block(item) for c in cursors[: pivot + 1]]
        if sum(m for m, _ in tops) < threshold:
            # no item before the end of the shortest of these blocks, or the next list's item, can pass
            beyond = min(e for _, e in tops) + 1
            if pivot + 1 < len(cursors):
                beyond = min(beyond, cursors[pivot + 1].item)
            for c in cursors[: pivot + 1]:
                c.seek(max(beyond, item + 1))
        elif cursors[0].item == item:
            here = [c for c in cursors[: pivot + 1] if c.item == item]
            score = sum(float(c.values[c.at]) for c in here)
            if score >= threshold and score >= index.need[item]:
                found.append((item, score))
            for c in here:
                c.at += 1
        else:
            for c in cursors[:pivot]:
                c.seek(item)


def _may_hold(index: Index, terms: set[int]) -> bool:
    """Whether some item gets from the rare words of a passage what it needs of them."""
    if index.least_common < math.inf and index.largest[list(terms)].sum() >= index.least_common:
        return True
    posts = index.rare_posts
    rare = [t for t in terms if t in posts]
    if len(rare) < index.least_terms:
        return False
    found: dict[int, float] = {}
    for term in rare:
        for item, value in posts[term]:
            found[item] = found.get(item, 0.0) + value
    rest = index.rest
    return any(value >= rest[item] > 0 for item, value in found.items())


def _verified(index: Index, item: int, words: list[str]) -> tuple[float, float, float]:
    """Shares of the item's question, answer and both whose n-grams stand in ``words``."""
    sizes = {len(g) for g in (next(iter(index.question[item]), ()), next(iter(index.answer[item]), ()))} - {0}
    there = set()
    for size in sizes:
        there |= {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
    q, a = index.question[item], index.answer[item]
    in_q, in_a = len(q & there), len(a & there)
    return in_q / len(q) if q else 1.0, in_a / len(a) if a else 1.0, (in_q + in_a) / max(1, len(q) + len(a))


def contaminations(index: Index, text: str | None) -> list[tuple[int, float, float, float]]:
    """(item key, best passage score, question share, answer share) of the items that ``text`` holds."""
    words = words_of(text)
    if not words or not index.keys:
        return []
    codes = np.fromiter(map(index.terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))
    # an upper bound for every passage from the terms' largest contributions
    total, rare = (np.concatenate([[0.0], np.cumsum(v[codes])]) for v in (index.largest, index.rare))
    starts = np.arange(0, max(1, len(words) - STEP), STEP)
    ends = np.minimum(starts + PASSAGE, len(words))
    hits: dict[int, list] = {}
    enough = (rare[ends] - rare[starts] >= index.least_rare) | (total[ends] - total[starts] >= index.least_common)
    for k in np.flatnonzero(enough).tolist():
        terms = set(codes[starts[k] : ends[k]].tolist()) - {-1}
        if not _may_hold(index, terms):
            continue
        for item, score in retrieve(index, terms, index.least):
            hits.setdefault(item, [score, []])
            hits[item][0] = max(score, hits[item][0])
            hits[item][1].append((int(starts[k]), int(ends[k])))
    out = []
    for item, (score, places) in sorted(hits.items()):
        size = len(index.question[item]) + len(index.answer[item]) + 2 * GRAM
        best = (0.0, 0.0, 0.0)
        last = -1
        for begin, end in places:
            begin = max(0, begin - size)
            if begin < last and last >= end + size:
                continue
            last = end + size
            best = max(best, _verified(index, item, words[begin:last]), key=lambda x: x[2])
        in_q, in_a, whole = best
        if in_q >= QUESTION_SHARE and in_a >= ANSWER_SHARE or whole >= WHOLE_SHARE:
            out.append((index.keys[item], score, in_q, in_a))
    return out


# ---- Spark ---------------------------------------------------------------------------------


def item_indexes(items: DataFrame) -> list[Index]:
    """Indexes over all of ``items`` (item_id, text), each of bounded size; ids may be null or repeat.

    A test set is read part by part: a part holds at most ``INDEX_ITEMS`` items.
    """
    rows = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    parts, held, size = [], [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"]) // 5
        if len(held) >= INDEX_ITEMS or size >= INDEX_WORDS:
            parts.append(build_index(held))
            held, size = [], 0
    if held:
        parts.append(build_index(held))
    return parts


HITS = "doc_id long, item_id long, score double, question_share double, answer_share double"


def find_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_share, answer_share): test items found in the texts of ``docs``.

    Every passage of every text is a query.  Null and empty texts, and items without
    words, give nothing; repeated rows and items give repeated rows.
    """
    spark = docs.sparkSession

    def find(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    rows += [(key, *hit) for hit in contaminations(shared.value, text.as_py())]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                columns = [pa.array([r[k] for r in rows], type=kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in HITS.split(", ")])

        return run

    docs = small_batches(docs)
    out = None
    for index in item_indexes(items):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        part = rows.mapInArrow(find(spark.sparkContext.broadcast(index)), HITS)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], HITS)


def keep_uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item."""
    docs = small_batches(docs)
    for index in item_indexes(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not contaminations(shared.value, t.as_py()) for t in batch.column("text")]
                yield batch.filter(pa.array(clean, type=pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
