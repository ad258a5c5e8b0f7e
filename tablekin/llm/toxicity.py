"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer turns words into symbols: insult stems and words learned from
labelled rows (with their log-odds as weights), and fixed small lists of threat,
target, negation and reported-speech words.  Five two-state transducers, one per
kind of evidence, read the symbols of a clause; their composition accepts a clause
with the total insult weight and the set of evidence seen.  A logistic layer, fitted
on labelled rows that the lexicon has not used, turns the matched clauses of a
document into a score.  Words outside a matched clause count for nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekin.llm.common import fold, shingle_sets, small_batches
from tablekin.staging import stage_table

# Words of the closed classes, in English, German, Spanish and French.
THREATS = "kill hurt destroy burn beat töten schlagen matar golpear tuer frapper".split()
TARGETS = "you your yourself they them du dich dir euch tú ti usted ustedes toi tu vous".split()
NEGATIONS = "not never no isn't aren't nicht kein keine nunca jamás ne pas jamais".split()
REPORTS = "said says wrote called quoted claims sagte schrieb dijo escribió dit écrit".split()

INSULT, THREAT, TARGET, NEGATION, REPORT = "insult", "threat", "target", "negation", "report"
KINDS = (INSULT, THREAT, TARGET, NEGATION, REPORT)
CLOSED = {w: k for k, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}

#: Labelled rows of each class that fitting uses at most, lexicon entries kept, stem lengths tried.
SAMPLE_ROWS = 4000
LEXICON_SIZE = 400
STEMS = (4, 5, 6, 7, 8)
#: A stem or word enters the lexicon if its share among toxic rows is larger by so many standard errors ...
LEAST_Z = 5.0
#: ... and so many times larger.
LEAST_RATIO = 4.0

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
CLAUSE_END = re.compile(r"[.!?;:\n]")


# ---- transducers -------------------------------------------------------------------


@dataclass
class Transducer:
    """Reads symbols; an arc (state, symbol) -> (state, factor) adds factor x the symbol's weight.

    A symbol without an arc leaves the state as it is.
    """

    arcs: dict[tuple[tuple, str], tuple[tuple, float]]
    start: tuple = (False,)
    states: set[tuple] = field(default_factory=set)

    def step(self, state: tuple, symbol: str) -> tuple[tuple, float]:
        return self.arcs.get((state, symbol), (state, 0.0))

    def accept(self, symbols: list[tuple[str, float]]) -> tuple[tuple, float]:
        state, total = self.start, 0.0
        for symbol, weight in symbols:
            state, factor = self.step(state, symbol)
            total += factor * weight
        return state, total


def evidence(kind: str) -> Transducer:
    """Two states: the kind was not, or was, seen; insults and threats carry weight."""
    factor = 1.0 if kind in (INSULT, THREAT) else 0.0
    return Transducer({((seen,), kind): ((True,), factor) for seen in (False, True)}, states={(False,), (True,)})


def compose(left: Transducer, right: Transducer) -> Transducer:
    """Both machines reading the same symbols: states are joined, weights added."""
    start = left.start + right.start
    arcs, open_states, states = {}, [start], {start}
    n = len(left.start)
    while open_states:
        state = open_states.pop()
        for kind in KINDS:
            (a, x), (b, y) = left.step(state[:n], kind), right.step(state[n:], kind)
            if a + b != state or x + y:
                arcs[state, kind] = (a + b, x + y)
            if a + b not in states:
                states.add(a + b)
                open_states.append(a + b)
    return Transducer(arcs, start, states)


def clause_grammar() -> Transducer:
    machine = evidence(KINDS[0])
    for kind in KINDS[1:]:
        machine = compose(machine, evidence(kind))
    return machine


# ---- features ------------------------------------------------------------------------

FEATURES = ("weight", "clauses", "density", "targeted", "negated", "reported", "threats")


class Matcher:
    """Finds the matched clauses of a text; ``lexicon`` maps ``stem*`` or ``word`` to a weight."""

    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick

        self.grammar = clause_grammar()
        self.find = ahocorasick.Automaton()
        entries = dict(lexicon) | {w: 1.0 for w in THREATS}
        for entry, weight in entries.items():
            stem = entry.removesuffix("*")
            kind = THREAT if entry in THREATS else INSULT
            if stem not in self.find or entry.endswith("*"):
                self.find.add_word(stem, (len(stem), entry.endswith("*"), kind, weight))
        self.find.make_automaton()

    def matches(self, text: str) -> list[tuple[int, str, float]]:
        """(start, kind, weight) of words that begin with a stem or are a word of the lexicon."""
        found: dict[int, tuple[int, str, float]] = {}
        size = len(text)
        for end, (length, stem, kind, weight) in self.find.iter(text):
            start = end + 1 - length
            if start and text[start - 1].isalnum() or not stem and end + 1 < size and text[end + 1].isalnum():
                continue
            if start not in found or weight > found[start][2]:
                found[start] = (start, kind, weight)
        return [found[k] for k in sorted(found)]

    def clauses(self, text: str) -> Iterator[tuple[int, int, tuple, float]]:
        """(start, end, evidence seen, weight) of every clause with an insult or a threat."""
        hits = self.matches(text)
        k = 0
        while k < len(hits):
            begin = max(text.rfind(c, 0, hits[k][0]) for c in ".!?;:\n") + 1
            ending = CLAUSE_END.search(text, hits[k][0])
            end = ending.start() if ending else len(text)
            own = {}
            while k < len(hits) and hits[k][0] < end:
                own[hits[k][0]] = hits[k][1:]
                k += 1
            symbols = []
            for word in WORD.finditer(text, begin, end):
                if word.start() in own:
                    symbols.append(own[word.start()])
                elif (kind := CLOSED.get(word[0])) and kind != THREAT:
                    symbols.append((kind, 1.0))
            seen, weight = self.grammar.accept(symbols)
            yield begin, end, seen, weight

    def features(self, text: str) -> list[float]:
        weight = clauses = targeted = negated = reported = threats = 0.0
        for _, _, seen, w in self.clauses(text):
            insult, threat, target, negation, report = seen
            if insult:
                weight += w
                clauses += 1
                targeted += target
                negated += negation
                reported += report
            elif threat and target:
                threats += 1
        density = 100 * clauses / (1 + text.count(" ")) if clauses else 0.0
        return [math.log1p(max(weight, 0.0)), math.log1p(clauses), math.log1p(density), *map(math.log1p, (targeted, negated, reported, threats))]


# ---- learning ------------------------------------------------------------------------


def _entries(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k}


def _count_entries(wanted: set[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts = Counter(), (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _entries(text or "")
                counts[toxic].update(found if wanted is None else found & wanted)
                rows[toxic] += 1
        names = [*(k for k in counts[1]), *(k for k in counts[0] if k not in counts[1]), ""]
        toxic = [*(counts[1][k] for k in names[:-1]), rows[1]]
        clean = [*(counts[0][k] for k in names[:-1]), rows[0]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(toxic, type=pa.int64()), pa.array(clean, type=pa.int64())], names=["entry", "toxic", "clean"]
        )

    return run


def _totals(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    counted = rows.select("text", "toxic").mapInArrow(_count_entries(wanted), "entry string, toxic long, clean long")
    return counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Words and stems that mark toxic rows of the bounded table ``rows`` (text, toxic), with log-odds.

    Candidates come from the toxic rows; their counts among clean rows follow in a second job.
    """
    seen = _totals(rows.where("toxic = 1"), None)
    seen = seen.where(F.col("toxic") >= 3).orderBy(F.desc("toxic"), "entry").limit(50_000)
    wanted = {r["entry"] for r in seen.collect()}
    if not wanted:
        return {}
    table = {r["entry"]: (r["toxic"], r["clean"]) for r in _totals(rows, wanted - {""}).collect()}
    n_toxic, n_clean = table.pop("", (0, 0))
    if not n_toxic or not n_clean:
        return {}
    scored = {}
    for entry, (t, c) in table.items():
        p = (t + c) / (n_toxic + n_clean)
        spread = math.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_clean)) or 1.0
        ratio = (t + 0.5) / (n_toxic + 1) / ((c + 0.5) / (n_clean + 1))
        z = (t / n_toxic - c / n_clean) / spread
        if z >= LEAST_Z and ratio >= LEAST_RATIO:
            scored[entry] = (round(z, 6), math.log(ratio))
    kept: dict[str, float] = {}
    for entry, (_, weight) in sorted(scored.items(), key=lambda x: (-x[1][0], -x[1][1], len(x[0]), x[0])):
        stem = entry.removesuffix("*")
        # a shorter or longer form of an entry that marks toxic rows better adds no evidence
        related = any(k.startswith(stem) or k.endswith("*") and stem.startswith(k[:-1]) for k in kept)
        if not related and len(kept) < LEXICON_SIZE:
            kept[entry] = weight
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, toxic_share: float, ridge: float = 0.05) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, classes weighted to ``toxic_share``, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y == 1, toxic_share / max(1, y.sum()), (1 - toxic_share) / max(1, (1 - y).sum())) * len(y)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge + 1e-6)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + penalty * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    weights: np.ndarray
    #: Score of every text where the labels hold no or only toxic rows.
    constant: float | None = None


def _features(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            rows = [matcher.features((t or "").lower()) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, type=pa.list_(pa.float64())), batch.column(1)], names=["features", "toxic"]
            )

    return run


def _with_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least shingle hash, which near copies mostly share."""
    for batch in batches:
        texts = ((t.as_py() or "").encode() for t in batch.column(0))
        least = [int(h[:1].view(np.int64)[0]) if h.size else 0 for h in shingle_sets(texts)]
        columns = [*batch.columns, pa.array(least, type=pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["text", "toxic", "part", "sketch"])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled texts of either class, those with the least hashes of their ids; fold 0 of 5 is left out."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold(F.col("doc_id"), 5) != 0)
    marks = marks.groupBy(F.col("doc_id").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    parts = [marks.where(F.col("toxic") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(rows) for k in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 x rows ids
    named = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("label_id"))
    named = named.select("text", "toxic", fold(F.col("doc_id"), 5).cast("int").alias("part"))
    named = named.mapInArrow(_with_sketch, "text string, toxic int, part int, sketch long")
    # One text of each group of copies, else every rare word of a copied toxic text would look like a mark.
    alike = Window.partitionBy("toxic", "sketch").orderBy(F.md5("text"), "part")
    return named.withColumn("copy", F.row_number().over(alike)).where("copy = 1").drop("copy", "sketch")


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from at most ``rows`` labelled rows of either class; folds 1 to 3 give the lexicon, fold 4 the weights."""
    sample = stage_table(labelled_sample(small_batches(docs), labels, rows), "toxicity-sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return ToxicityModel({}, np.zeros(len(FEATURES) + 1), 1.0 if n.get(1) else 0.0)
    lexicon = learn_lexicon(sample.where("part != 4"))
    features = sample.where("part = 4").select("text", "toxic").mapInArrow(_features(lexicon), "features array<double>, toxic int")
    table = features.collect()
    x = np.array([r["features"] for r in table]).reshape(-1, len(FEATURES))
    y = np.array([r["toxic"] for r in table])
    if not y.size or y.min() == y.max():
        # too few rows for a separate part: any matched clause decides
        weights = np.zeros(len(FEATURES) + 1)
        weights[1], weights[-1] = 4.0, -2.0
        return ToxicityModel(lexicon, weights)
    held = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold(F.col("doc_id"), 5) != 0)
    toxic_share = held.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    return ToxicityModel(lexicon, fit_logistic(x, y, toxic_share))


# ---- scoring -------------------------------------------------------------------------


def _score(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.lexicon)
        for batch in batches:
            x = np.array([matcher.features((t.as_py() or "").lower()) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            z = x @ model.weights[:-1] + model.weights[-1]
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            if model.constant is not None:
                score = np.full(len(score), model.constant)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(np.expm1(x[:, 1]).round().astype(np.int32))], names=["row", "score", "clauses"]
            )

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, clauses) of every row of ``docs``, from its whole text alone; null texts count as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), "text").mapInArrow(_score(model), "row long, score double, clauses int")
    return rows.withColumnRenamed("row", "doc_id")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _score(model)
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column("text"), batch.column("text")], names=["row", "text"])
            scores = next(scorer(iter([pair]))).column(1).to_numpy()
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
