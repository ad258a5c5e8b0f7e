"""How a chain of filters would act in any order, from one small table of counts per part.

Every document is reduced to five failure bits.  Counting documents per part and cell of
the 2x2x2x2x2 table holds all that any order of the filters can do: what a step keeps
or removes is the table contracted with one selector per axis (pass, fail or all).
Documents are read once; what is shuffled has a fixed width per document, and the
contractions work on at most 32 cells per part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekin.staging import stage_table

LETTERS = "ABCDE"
MIN_WORDS = 200
#: Parts whose contractions are computed together.
PARTS_AT_ONCE = 256
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
#: Salts that spread rows without an id over the join with the labels, which none of them meets.
SPREAD = 1024

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: whether ``text`` fails A to D."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words).cast("long")
    fails = [
        n < MIN_WORDS,
        F.size(F.array_distinct(words)).cast("long") * 100 < n * 50,
        F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.char_length(text).cast("long") * 2,
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(fail, 1 << k).otherwise(0) for k, fail in enumerate(fails)]
    return sum(bits[1:], bits[0])


def _selectors(orders: list[tuple[int, ...]]) -> np.ndarray:
    """(orders x steps, what, axis, 2): selectors of kept and removed."""
    out = np.empty((len(orders) * 5, 2, 5, 2), dtype=np.int64)
    for o, order in enumerate(orders):
        for step, axis in enumerate(order):
            for what, at in enumerate((PASS, FAIL)):
                row = out[o * 5 + step, what]
                row[:] = ALL
                row[list(order[:step])] = PASS
                row[axis] = at
    return out


def _measures(tables: np.ndarray) -> Iterator[tuple[str, int, np.ndarray]]:
    """(order, step, measures x parts) of ``tables``: parts x (all, good, toxic) x 2x2x2x2x2."""
    orders = list(permutations(range(5)))
    chosen = _selectors(orders)
    axes = [chosen[:, :, k] for k in range(5)]
    # What each step keeps and removes: one selector per axis.
    found = np.einsum("pmabcde,ska,skb,skc,skd,ske->skmp", tables, *axes, optimize=True)
    kept, removed = found[:, 0], found[:, 1]
    every = tables[:, 0]
    failing = [np.einsum("pabcde," + "abcde"[k] + "->p", every, np.array(FAIL)) for k in range(5)]
    alone = [
        np.einsum("pabcde,a,b,c,d,e->p", every, *(np.array(FAIL if j == k else PASS) for j in range(5))) for k in range(5)
    ]
    by_letter = np.array([order[step] for order in orders for step in range(5)])
    shapley = [removed[by_letter == k, 0].sum(axis=0) for k in range(5)]
    for s, axis in enumerate(by_letter.tolist()):
        name = "".join(LETTERS[k] for k in orders[s // 5])
        gone = removed[s, 0]
        lost = [removed[s, 1], removed[s, 2]]
        yield name, s % 5 + 1, np.stack([kept[s, 0], gone, failing[axis] - gone, alone[axis], *lost, shapley[axis]])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "filter_order", "step", *MEASURES]
    for batch in batches:
        for first in range(0, batch.num_rows, PARTS_AT_ONCE):
            rows = batch.slice(first, PARTS_AT_ONCE)
            parts = rows.column(0)
            tables = np.zeros((len(parts), 3, 2, 2, 2, 2, 2), dtype=np.int64)
            for p, cells in enumerate(rows.column(1).to_pylist()):
                for c in cells:
                    place = tuple(c["cell"] >> k & 1 for k in range(5))
                    tables[(p, slice(None), *place)] += (c["n"], c["good"], c["toxic"])
            for order, step, values in _measures(tables):
                fixed = [pa.array([order] * len(parts)), pa.array([step] * len(parts), pa.int32())]
                yield pa.RecordBatch.from_arrays([parts, *fixed, *map(pa.array, values)], names=names)


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cell, n, good, toxic): documents per part and set of failed filters (bit k of cell: letter k).

    Equal texts are told by SHA-256.  The least id of a text is found with a partial
    minimum per task, and both joins are keyed by the document's id (with the digest), so a text of
    any number of copies is never gathered in one task.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text_failures(text).cast("int").alias("failed"),
    )
    rows = stage_table(rows, "filter-bits")
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("label_id"))
    marks = marks.agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    ).withColumn("label_salt", F.lit(0))
    first = rows.where(F.col("doc_id").isNotNull()).groupBy(F.col("digest").alias("first_digest")).agg(F.min("doc_id").alias("first_id"))
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest", "part"), F.lit(SPREAD))).otherwise(0).cast("int")
    keyed = rows.withColumn("key_id", F.coalesce("doc_id", F.lit(0))).withColumn("salt", salt)
    joined = keyed.join(marks, (F.col("key_id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")), "left")
    at_first = (F.col("key_id") == F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    joined = joined.join(first.withColumn("first_salt", F.lit(0)), at_first & (F.col("salt") == F.col("first_salt")), "left")
    copy = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    return joined.groupBy("part", (F.col("failed") + F.when(copy, 16).otherwise(0)).alias("cell")).agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts per part, order of the five filters and step; columns as in ``MEASURES``.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic; a document is good
    (toxic) if any row of its id says so.  A null text or source is empty.  A row without an
    id is never a copy and has no labels; rows that repeat an id count each, and are
    copies only of a smaller id.  An empty table gives no rows; other columns are not looked at.
    """
    cells = failure_cells(docs, labels)
    tables = cells.groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))
    counts = ", ".join(f"{m} long" for m in MEASURES)
    return tables.mapInArrow(_contract, f"part string, filter_order string, step int, {counts}")


def oracle() -> str:
    return r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
    firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
    marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            {'A': len(words) < 200, 'B': 100 * list_unique(words) < 50 * len(words),
             'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
             'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(w.doc_id > first_id, false)} AS s
          FROM w JOIN firsts USING (t) LEFT JOIN marks ON w.doc_id = marks.doc_id),
    fails AS (SELECT part, good, toxic, (CASE WHEN s.A THEN 'A' ELSE '' END) || (CASE WHEN s.B THEN 'B' ELSE '' END)
            || (CASE WHEN s.C THEN 'C' ELSE '' END) || (CASE WHEN s.D THEN 'D' ELSE '' END) || (CASE WHEN s.E THEN 'E' ELSE '' END) AS failed
          FROM f),
    cells AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    steps AS (SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
          FROM orders, (SELECT unnest(range(1, 6)) AS step)),
    hits AS (SELECT part, filter_order, step, letter, n, good, toxic, failed, contains(failed, letter) AS fails,
            earlier <> '' AND regexp_matches(failed, '[' || earlier || ' ]') AS gone
          FROM cells, steps),
    sums AS (SELECT part, filter_order, CAST(step AS INT) AS step, letter,
            CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
            CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
            CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
            CAST(coalesce(sum(n) FILTER (failed = letter), 0) AS BIGINT) AS unique_fails,
            CAST(coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
            CAST(coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
          FROM hits GROUP BY part, filter_order, step, letter)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM sums"""
