"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekin.llm.common import fold, small_batches

#: Dimensions of the hashed n-gram space, centroids per language.
DIMENSIONS = 1 << 13
CENTROIDS = 3
#: Rows per language, expected, that the centroids are fitted on (document frequencies use all rows).
SAMPLE_ROWS = 1500
#: Share of a language's own rows that its rejection distance leaves out.
REJECTED_SHARE = 0.005

#: The Unicode categories of letters; superscripts, fractions and circled digits are none.
LETTER = regex.compile(r"\p{L}")
#: ASCII digits, punctuation and white space become one separator.
_SEPARATE = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def ngram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed byte 2- and 3-grams, word borders included, of the lower-cased text."""
    raw = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATE) + b" ", dtype=np.uint8)
    # one separator between words
    gap = raw == 32
    codes = raw[~(gap & np.concatenate([[False], gap[:-1]]))].astype(np.uint32)
    two = codes[:-1] << np.uint32(8) | codes[1:]
    three = two[:-1] << np.uint32(8) | codes[2:]
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    two = (two + np.uint32(1 << 24)) * np.uint32(2654435761) >> shift
    three = three * np.uint32(2654435761) >> shift
    return np.bincount(two, minlength=DIMENSIONS) + np.bincount(three, minlength=DIMENSIONS)


def _vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the normalised TF-IDF vector."""
    places = np.flatnonzero(counts)
    values = (1 + np.log(counts[places])) * idf[places]
    norm = np.sqrt((values * values).sum())
    return places, values / norm if norm else values


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    #: One column per centroid, the language of each, and each language's rejection distance.
    centroids: np.ndarray
    owner: np.ndarray
    reject: np.ndarray


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(DIMENSIONS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            seen += ngram_counts(text.as_py()) > 0
            rows += 1
    places = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(places, -1)), pa.array(np.append(seen[places], rows))], names=["place", "rows"]
    )


def _cluster(idf: np.ndarray, clusters: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
        for k, text in enumerate(rows["text"].sort_values()):
            places, values = _vector(ngram_counts(text), idf)
            x[k, places] = values
        x = x[x.any(axis=1)]
        if not len(x):
            return pd.DataFrame({"lang": [], "reject": [], "centroid": []})
        # spherical k-means from spread starting points
        chosen = [int(np.argmax(x @ x.mean(axis=0)))]
        while len(chosen) < min(clusters, len(x)):
            chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
        centre = x[chosen]
        for _ in range(10):
            near = (x @ centre.T).argmax(axis=1)
            sums = np.stack([x[near == k].sum(axis=0) if (near == k).any() else centre[k] for k in range(len(centre))])
            centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        # a centroid of stray rows is no cluster: it needs a hundredth of the rows
        size = np.bincount((x @ centre.T).argmax(axis=1), minlength=len(centre))
        centre = centre[size >= 0.01 * len(x)]
        best = (x @ centre.T).max(axis=1)
        reject = float(1 - np.quantile(best, REJECTED_SHARE))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "reject": reject, "centroid": [c.tobytes() for c in centre]})

    return run


def fit_languages(docs: DataFrame, clusters: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from text and non-null lang of the rows outside fold 2 of 4.

    Document frequencies come from all those rows; centroids from a sample of about
    ``sample_rows`` rows per language, chosen by a hash of id and text.  Vectors of
    fixed size and at most ``clusters`` rows per language come to the driver.
    """
    docs = small_batches(docs)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(fold(F.col("doc_id"), 4) != 2)
    counts = rows.groupBy("lang").agg(F.count("*").alias("rows_of_lang"))
    counted = rows.select("text").mapInArrow(_frequencies, "place long, rows long").groupBy("place").agg(F.sum("rows").alias("rows"))
    seen = np.zeros(DIMENSIONS)
    total = 0
    for row in counted.collect():
        if row["place"] < 0:
            total = row["rows"]
        else:
            seen[row["place"]] = row["rows"]
    idf = np.log((1 + total) / (1 + seen)) + 0.05
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    one_row_each = F.broadcast(counts.withColumnRenamed("lang", "of"))  # a row per language, never per document
    chosen = rows.select("doc_id", "text", "lang").join(one_row_each, F.col("lang") == F.col("of"))
    chosen = chosen.where(share * F.col("rows_of_lang") < sample_rows).select("lang", "text")
    fitted = chosen.groupBy("lang").applyInPandas(_cluster(idf, clusters), "lang string, reject double, centroid binary").collect()
    fitted.sort(key=lambda r: (r["lang"].encode(), r["centroid"]))
    languages = list(dict.fromkeys(r["lang"] for r in fitted))
    centroids = np.array([np.frombuffer(r["centroid"], dtype=np.float32) for r in fitted]).reshape(-1, DIMENSIONS).T
    owner = np.array([languages.index(r["lang"]) for r in fitted], dtype=np.int64)
    reject = np.array([max(r["reject"] for r in fitted if r["lang"] == x) for x in languages])
    return LanguageModel(languages, idf, np.ascontiguousarray(centroids), owner, reject)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            names, scores, rejected = [], [], []
            for item in batch.column(1):
                text = item.as_py()
                if not text or not m.languages or not LETTER.search(text):
                    names.append("und")
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                places, values = _vector(ngram_counts(text), m.idf)
                near = values.astype(np.float32) @ m.centroids[places]
                k = int(near.argmax())
                best, lang = min(1.0, max(0.0, float(near[k]))), int(m.owner[k])
                names.append(m.languages[lang])
                scores.append(best)
                rejected.append(1 - best > m.reject[lang])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64()), pa.array(rejected, type=pa.bool_())],
                names=["row", "lang_pred", "score", "rejected"],
            )

    return run


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of ``docs`` from its whole text.

    ``score`` is the cosine with the nearest centroid; ``rejected`` says that it is
    farther than nearly all rows the language was learned from.  Null texts and
    texts without a letter are ``und`` with score 0, and so is everything where no
    language was learned.  Equal cosines go to the language first in code point order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), "text")
    found = rows.mapInArrow(_predict(shared), "row long, lang_pred string, score double, rejected boolean")
    return found.withColumnRenamed("row", "doc_id")
