"""Scoring texts with a hidden Markov language model.

Latent states emit symbols: the most frequent words have one each, all other words
share symbols by their ending.  A word's probability is that of its symbol under the
recursion, times its smoothed share among the words of the symbol (1 for a word that
has its own), so the model is a distribution over words in the same sense as the
add-one unigram base: one unknown type per shared symbol.

Texts are read once.  Each task writes its texts as numbers of a dictionary of its own
(a chunk) next to that dictionary; counts, symbols and all later work join chunks'
dictionaries instead of single words.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekin.llm.common import small_batches, stage_packed


#: Words with a symbol of their own, symbols that the others share (by their last bytes), latent states.
OWN_SYMBOLS = 4096
SHARED_SYMBOLS = 1024
ENDING_BYTES = 3
STATES = 6
ITERATIONS = 4
#: Entries of a chunk's dictionary before a new chunk begins.
CHUNK_WORDS = 250_000
#: Tokens of a training segment: longer texts count as segments that start from a distribution of their own.
SEGMENT = 256
#: Texts that the starting point of the training is taken from; the counts then come from all training texts.
START_ROWS = 1000


# ---- chunks -----------------------------------------------------------------------------

CODED = "chunk string, doc_id long, training boolean, codes binary, local int, word binary, train_count long"


def _code(chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "int": pa.int32()}
        schema = pa.schema([(n, kind[k]) for n, k in (c.split() for c in CODED.split(", "))])

        class Numbers(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = n = len(self)
                return n

        def words(chunk: str, numbers: dict, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            names = list(numbers)
            for k in range(0, len(names), 20_000):
                part = names[k : k + 20_000]
                n = len(part)
                none = pa.nulls(n)
                columns = [
                    pa.array([chunk] * n),
                    none.cast(pa.int64()),
                    none.cast(pa.bool_()),
                    none.cast(pa.binary()),
                    pa.array(np.arange(k, k + n, dtype=np.int32)),
                    pa.array(part, type=pa.binary()),
                    pa.array(counts[k : k + n]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

        chunk, numbers, counts = uuid.uuid4().hex, Numbers(), np.zeros(chunk_words, dtype=np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                rows = batch.slice(begin, 512)
                codes, training = [], rows.column(2).to_pylist()
                for text, trains in zip(rows.column(1), training, strict=True):
                    code = np.fromiter(map(numbers.__getitem__, (text.as_py() or b"").lower().split()), dtype=np.uint32)
                    codes.append(code.tobytes())
                    if trains and code.size:
                        if len(numbers) > counts.size:
                            counts = np.concatenate([counts, np.zeros(len(numbers), dtype=np.int64)])
                        seen, times = np.unique(code, return_counts=True)
                        counts[seen] += times
                if len(numbers) > counts.size:
                    counts = np.concatenate([counts, np.zeros(len(numbers), dtype=np.int64)])
                n = rows.num_rows
                none = pa.nulls(n)
                columns = [
                    pa.array([chunk] * n),
                    rows.column(0),
                    rows.column(2),
                    pa.array(codes, type=pa.binary()),
                    none.cast(pa.int32()),
                    none.cast(pa.binary()),
                    none.cast(pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                if len(numbers) >= chunk_words:
                    yield from words(chunk, numbers, counts)
                    chunk, numbers, counts = uuid.uuid4().hex, Numbers(), np.zeros(chunk_words, dtype=np.int64)
        yield from words(chunk, numbers, counts)

    return run


def _ending(words: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(w[-ENDING_BYTES:]) % SHARED_SYMBOLS for w in words.to_pylist()], dtype=np.int32)


def _with_ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_ending(batch.column(0)))], names=["word", "count", "ending"])


# ---- the model ----------------------------------------------------------------------------


@dataclass
class Markov:
    """start: first state; resume: first state of a later training segment; move[i, j]: i to j; emit[state, symbol]."""

    start: np.ndarray
    resume: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _matrix(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences, longest first, as columns of one padded matrix; and how many are as long as each step."""
    lengths = np.array([s.size for s in sequences])
    table = np.zeros((lengths[0], len(sequences)), dtype=np.int64)
    for k, s in enumerate(sequences):
        table[: s.size, k] = s
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    return table, alive


def log_likelihoods(model: Markov, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probabilities of whole symbol sequences by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    order = sorted((k for k in range(len(sequences)) if sequences[k].size), key=lambda k: -sequences[k].size)
    step_move = model.move.T.copy()
    for begin in range(0, len(order), 512):
        part = order[begin : begin + 512]
        table, alive = _matrix([sequences[k] for k in part])
        total = np.zeros(len(part))
        state = model.start[:, None] * model.emit[:, table[0]]
        for t in range(len(table)):
            n = alive[t]
            if t:
                state = (step_move @ state[:, :n]) * model.emit[:, table[t, :n]]
            scale = state.sum(axis=0)
            state /= scale
            total[:n] += np.log10(scale)
        out[part] = total
    return out


def expected_counts(model: Markov, sequences: list[np.ndarray], first: np.ndarray) -> Markov:
    """Baum-Welch: expected starts, resumptions, moves and emissions of the sequences (``first``: starts of texts)."""
    k, symbols = model.emit.shape
    start, resume, move, emit = np.zeros(k), np.zeros(k), np.zeros((k, k)), np.zeros((k, symbols))
    order = sorted((i for i in range(len(sequences)) if sequences[i].size), key=lambda i: -sequences[i].size)
    step_move = model.move.T.copy()
    for begin in range(0, len(order), 1024):
        part = order[begin : begin + 1024]
        table, alive = _matrix([sequences[i] for i in part])
        begins = first[part]
        emitted = model.emit[:, table]  # state x step x sequence
        ahead = np.zeros(emitted.shape)
        scales = np.ones(table.shape)
        state = np.where(begins, model.start[:, None], model.resume[:, None]) * emitted[:, 0]
        for t in range(len(table)):
            n = alive[t]
            if t:
                state = (step_move @ state[:, :n]) * emitted[:, t, :n]
            scale = state.sum(axis=0)
            state = state / scale
            ahead[:, t, :n] = state
            scales[t, :n] = scale
        back = np.ones((k, len(part)))
        for t in range(len(table) - 1, 0, -1):
            n = alive[t]
            weighted = back[:, :n] * emitted[:, t, :n] / scales[t, :n]
            move += model.move * (ahead[:, t - 1, :n] @ weighted.T)
            ahead[:, t, :n] *= back[:, :n]
            back[:, :n] = model.move @ weighted
        ahead[:, 0] *= back
        start += ahead[:, 0, begins].sum(axis=1)
        resume += ahead[:, 0, ~begins].sum(axis=1)
        live = np.arange(len(part)) < alive[:, None]
        places = table[live]
        for s in range(k):
            emit[s] += np.bincount(places, weights=ahead[s][live], minlength=symbols)
    return Markov(start, resume, move, emit)


def _estimated(counts: Markov, shares: np.ndarray) -> Markov:
    """Probabilities from counts; every state keeps some of the overall symbol shares."""
    k = len(counts.start)
    start, resume = counts.start + 1 / k, counts.resume + 1 / k
    move = counts.move + 0.1
    emit = counts.emit + 20 * shares
    return Markov(
        start / start.sum(), resume / resume.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)
    )


def _segments(codes: Iterator[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    parts, first = [], []
    for raw in codes:
        symbols = np.frombuffer(raw, dtype=np.uint16)
        for begin in range(0, symbols.size, SEGMENT):
            parts.append(symbols[begin : begin + SEGMENT])
            first.append(begin == 0)
    return parts, np.array(first, dtype=bool)


def _count_task(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        k, symbols = m.emit.shape
        total = np.zeros(2 * k + k * k + k * symbols)
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                rows = batch.slice(begin, 2000).column(0)
                parts, first = _segments(r.as_py() for r in rows)
                c = expected_counts(m, parts, first)
                total += np.concatenate([c.start, c.resume, c.move.ravel(), c.emit.ravel()])
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[places])], names=["place", "amount"])

    return run


def _starting_point(rows: list[bytes], symbols: int, states: int, shares: np.ndarray) -> Markov:
    """States that each begin with the symbols of one group of similar texts, and stay long."""
    x = np.array([np.bincount(np.frombuffer(r, dtype=np.uint16), minlength=symbols) for r in rows], dtype=np.float64)
    y = np.sqrt(x)
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    chosen = [int(np.argmax(y @ y.mean(axis=0)))]
    while len(chosen) < states:
        chosen.append(int(np.argmin((y @ y[chosen].T).max(axis=1))))
    centre = y[chosen]
    for _ in range(8):
        near = (y @ centre.T).argmax(axis=1)
        centre = np.stack([y[near == s].sum(axis=0) if (near == s).any() else centre[s] for s in range(states)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    emit = np.stack([x[near == s].sum(axis=0) for s in range(states)])
    # an uneven share of the whole keeps empty groups apart
    uneven = 1 + 0.5 * np.random.default_rng(5).random((states, symbols))
    emit = emit / np.maximum(emit.sum(axis=1, keepdims=True), 1) * 1000 + 200 * shares * uneven
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    even = np.full(states, 1 / states)
    return Markov(even, even, move, emit / emit.sum(axis=1, keepdims=True))


def train(coded: DataFrame, shares: np.ndarray, states: int = STATES, iterations: int = ITERATIONS) -> Markov:
    """Baum-Welch over all training rows of ``coded`` (training, symbols, key); the counts of the tasks are summed by Spark."""
    spark = coded.sparkSession
    rows = coded.where("training")
    last = rows.select("key").orderBy("key").limit(START_ROWS).agg(F.max("key")).first()[0]
    first = [bytes(r["symbols"]) for r in rows.where(F.col("key") <= last).select("symbols").limit(2 * START_ROWS).collect()]
    if not first:
        even = np.full(states, 1 / states)
        return Markov(even, even, np.full((states, states), 1 / states), np.tile(shares, (states, 1)))
    model = _starting_point(first, len(shares), states, shares)
    k, symbols = model.emit.shape
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast(model)
        counted = rows.select("symbols").mapInArrow(_count_task(shared), "place long, amount double")
        total = np.zeros(2 * k + k * k + k * symbols)
        # one row per parameter
        for row in counted.groupBy("place").agg(F.sum("amount").alias("amount")).collect():
            total[row["place"]] = row["amount"]
        start, resume, move, emit = np.split(total, [k, 2 * k, 2 * k + k * k])
        model = _estimated(Markov(start, resume, move.reshape(k, k), emit.reshape(k, symbols)), shares)
    return model


# ---- the operator ---------------------------------------------------------------------------


def _join_chunk(train_tokens: int, vocabulary: int, end_count: int, shared):
    """Texts of one chunk with the counts and symbols of its dictionary: sums per text, and symbol sequences."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        sizes = shared.value  # log10 of the denominator of each shared symbol
        n = right.num_rows
        local = right["local"].to_numpy()
        count, symbol = np.zeros(n), np.zeros(n, dtype=np.uint16)
        count[local] = right["count"].to_numpy()
        symbol[local] = right["symbol"].to_numpy()
        known, weight = count > 0, np.log10(count + 1)
        inside = np.where(symbol >= OWN_SYMBOLS + 1, weight - sizes[np.maximum(symbol.astype(np.int64) - OWN_SYMBOLS - 1, 0)], 0.0)
        base = np.log10(train_tokens + vocabulary + 1)
        columns = {c: [] for c in ("n_tokens", "n_known", "base_score", "inside", "symbols")}
        for raw in left["codes"]:
            code = np.frombuffer(raw.as_py(), dtype=np.uint32)
            columns["n_tokens"].append(code.size + 1)
            columns["n_known"].append(int(known[code].sum()) + int(end_count > 0))
            columns["base_score"].append(float(weight[code].sum() + np.log10(end_count + 1) - (code.size + 1) * base))
            columns["inside"].append(float(inside[code].sum()))
            columns["symbols"].append(np.append(symbol[code], np.uint16(0)).astype(np.uint16).tobytes())
        return pa.table(
            [
                left["doc_id"],
                left["training"],
                pa.array(columns["n_tokens"], pa.int64()),
                pa.array(columns["n_known"], pa.int64()),
                pa.array(columns["base_score"], pa.float64()),
                pa.array(columns["inside"], pa.float64()),
                pa.array(columns["symbols"], pa.binary()),
            ],
            names=["doc_id", "training", "n_tokens", "n_known", "base_score", "inside", "symbols"],
        )

    return run


def _forward(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            # rows of similar length share steps
            for begin in range(0, batch.num_rows, 4096):
                rows = batch.slice(begin, 4096)
                scores.append(log_likelihoods(model.value, [np.frombuffer(r.as_py(), dtype=np.uint16) for r in rows.column(0)]))
            score = np.concatenate(scores) if scores else np.zeros(0)
            columns = [*batch.columns[1:5], pa.array(score + batch.column(5).to_numpy()), batch.column(6)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score", "training"])

    return run


def score_texts(docs: DataFrame, training, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, n_known, train_tokens, base_score, score and training.

    ``training`` is a boolean column: the rows that counts and model are learned from.
    Tokens are words with A-Z lower-cased and one end per text; a null text is empty and
    has the end alone.  ``base_score`` is the add-one unigram log10 probability, ``score``
    that of the model.  Repeated rows are scored alike.  An empty table gives no rows;
    without training rows all symbols are equally likely.
    """
    spark = docs.sparkSession
    docs = small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), training.alias("training"))
    coded = stage_packed(rows.mapInArrow(_code(CHUNK_WORDS), CODED), "markov-coded")
    texts = coded.where("word IS NULL").select("chunk", "doc_id", "training", "codes")
    entries = coded.where("word IS NOT NULL").select("chunk", "local", "word", "train_count")

    words = entries.groupBy("word").agg(F.sum("train_count").alias("count"))
    words = stage_packed(words.mapInArrow(_with_ending, "word binary, count long, ending int"), "markov-words")
    found = words.agg(F.sum("count").alias("tokens"), F.count_if(F.col("count") > 0).alias("types")).first()
    end_count = texts.where("training").count()
    train_tokens, vocabulary = (found["tokens"] or 0) + end_count, found["types"] + int(end_count > 0)

    # Symbol 0 is the end, then the words of their own, then the shared ones.
    own = words.where("count > 0").orderBy(F.desc("count"), "word").limit(OWN_SYMBOLS).collect()
    table = [(bytes(r["word"]), k + 1) for k, r in enumerate(own)]
    own_rows = F.broadcast(spark.createDataFrame(table, "own_word binary, own_symbol int"))  # at most OWN_SYMBOLS rows
    placed = words.join(own_rows, F.col("word") == F.col("own_word"), "left")
    placed = placed.select("word", "count", F.coalesce("own_symbol", F.col("ending") + OWN_SYMBOLS + 1).alias("symbol"))

    tokens, types = np.zeros(SHARED_SYMBOLS), np.zeros(SHARED_SYMBOLS)
    for r in words.groupBy("ending").agg(F.sum("count").alias("c"), F.count_if(F.col("count") > 0).alias("v")).collect():
        tokens[r["ending"]], types[r["ending"]] = r["c"], r["v"]
    for r in own:
        tokens[r["ending"]] -= r["count"]
        types[r["ending"]] -= 1
    sizes = spark.sparkContext.broadcast(np.log10(tokens + types + 1))
    amount = np.concatenate([[end_count], [r["count"] for r in own], np.zeros(OWN_SYMBOLS - len(own)), tokens])
    # symbols without a word stay impossible
    exists = np.concatenate([[1.0], np.arange(OWN_SYMBOLS) < len(own), np.ones(SHARED_SYMBOLS)])
    shares = (amount + exists) / (amount + exists).sum()

    entries = entries.join(placed, "word").select(F.col("chunk").alias("of_chunk"), "local", "count", "symbol")
    join = _join_chunk(train_tokens, vocabulary, end_count, sizes)
    joined = texts.groupBy("chunk").cogroup(entries.groupBy("of_chunk")).applyInArrow(
        join, "doc_id long, training boolean, n_tokens long, n_known long, base_score double, inside double, symbols binary"
    )
    joined = joined.withColumn("key", F.xxhash64("doc_id", "n_tokens", "base_score"))
    joined = stage_packed(joined, "markov-symbols")
    model = spark.sparkContext.broadcast(train(joined, shares, states, iterations))
    scored = joined.select("symbols", "doc_id", "n_tokens", "n_known", "base_score", "inside", "training").mapInArrow(
        _forward(model), "doc_id long, n_tokens long, n_known long, base_score double, score double, training boolean"
    )
    return scored.withColumn("train_tokens", F.lit(train_tokens).cast("long"))
