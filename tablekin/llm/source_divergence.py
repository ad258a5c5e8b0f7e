"""Which sources of a language differ, and by which terms, with terms shuffled as digests only.

Documents are read once and counted per task; the counted rows are written with a
64-bit digest beside each term, and from then on only (language, source, digest, counts)
move.  Text comes back in two places: one aggregate per digest that reaches the
frequency limit takes its least and its greatest term, which differ exactly if terms
share the digest (those few digests are then split and counted by term), and the terms of
the report are joined to their digests.  A merged digest is at least as frequent as each of
its terms, so terms below the limit never need their text.

All values are integers: a share is 1 + floor(10^9 (count + 5) / (N + 5 V)), with N the occurrences of
kept terms and V their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekin.llm.common import small_batches, stage_packed
from tablekin.staging import stage_table

MIN_DOCUMENTS = 30
TOP_TERMS = 50
#: Entries a task holds before it hands its counts on.
HELD_TERMS = 600_000
#: Bytes of a text that are cut into terms at once.
PIECE_BYTES = 4 << 20
#: Kept terms in one block of the distances, and sources in one tile of it.
BLOCK_TERMS = 4096
TILE_SOURCES = 128

#: A-Z become a-z, other letters of terms stay, everything else separates.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of ``text``, in lists of bounded size; none is cut in two."""
    first = 0
    while first < len(text):
        last = min(first + PIECE_BYTES, len(text))
        piece = text[first:last].translate(_TERM_BYTES)
        if last < len(text):
            cut = piece.rfind(b" ")
            while cut < 0 and last < len(text):
                end = min(last + PIECE_BYTES, len(text))
                more = text[last:end].translate(_TERM_BYTES)
                cut = more.find(b" ")
                cut = len(piece) + cut if cut >= 0 else -1
                piece, last = piece + more, end
            if cut >= 0:
                piece = piece[:cut]
        yield piece.split()
        first += max(len(piece), 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the task's documents; a row may come up more than once."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    names = ["lang", "source", "term", "n", "docs"]

    def counted() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = list(n)
            columns = [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(n.values(), pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        groups.clear()

    for batch in batches:
        langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for text, lang, source in zip(batch.column(0), langs, sources, strict=True):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in _terms(text.as_py()):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
        if sum(len(n) for n, _ in groups.values()) >= HELD_TERMS:
            yield from counted()
    yield from counted()


def count_terms(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """Counts (lang, source, term, digest, n, docs), summed within tasks only and written.

    Digests follow from the terms and are not written, only taken where they are to move.
    """
    empty = F.lit("")
    rows = small_batches(docs).select(
        F.coalesce("text", empty).cast("binary").alias("text"),
        F.coalesce("lang", empty).alias("lang"),
        F.coalesce("source", empty).alias("source"),
    )
    counted = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    digest = F.xxhash64("term")
    if digest_bits < 64:
        digest = F.shiftrightunsigned(digest, 64 - digest_bits)
    return stage_packed(counted, "term-counts").withColumn("digest", digest)


def _kept(counts: DataFrame, min_documents: int) -> DataFrame:
    """(lang, digest, split, lang_n) of the terms in at least ``min_documents`` documents of their language."""
    sums = counts.groupBy("lang", "digest", "split").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
    return sums.where(F.col("lang_docs") >= min_documents).drop("lang_docs")


def _sums(rows: DataFrame, *keys) -> DataFrame:
    return rows.groupBy("lang", "source", *keys).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counted: DataFrame, min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(counts, dictionary) of the kept terms.

    counts: lang, source, digest, split, n, lang_n.  dictionary: digest, split, term.  A
    term is (digest, split): split is 0 unless several terms share the digest, which are then
    numbered from 1.  Only digests that reach the limit meet their texts.
    """
    merged = _sums(counted, "digest").withColumn("split", F.lit(0))
    merged = stage_packed(merged.join(_kept(merged, min_documents), ["lang", "digest", "split"]), "kept-digests")
    digests = merged.select("digest").distinct()
    texts = counted.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))
    texts = stage_table(texts.join(digests, "digest"), "kept-texts")
    clean = texts.where(F.col("term") == F.col("last")).select("digest", F.lit(0).alias("split"), "term")
    shared = texts.where(F.col("term") != F.col("last")).select("digest")
    if shared.isEmpty():
        return merged.drop("docs"), clean
    sharing = counted.join(shared, "digest", "left_semi")
    order = Window.partitionBy("digest").orderBy("term")
    numbers = sharing.select("digest", "term").distinct().withColumn("split", F.row_number().over(order))
    numbers = stage_table(numbers, "shared-digests")
    apart = _sums(sharing.join(numbers, ["digest", "term"]), "digest", "split")
    apart = apart.join(_kept(apart, min_documents), ["lang", "digest", "split"])
    whole = merged.join(shared, "digest", "left_anti").unionByName(apart.select(*merged.columns))
    return stage_table(whole.drop("docs"), "kept-terms"), clean.unionByName(numbers.select("digest", "split", "term"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), exact for any long counts."""
    above = (count.cast("decimal(20,0)") + 5) * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)") * 5
    return F.when(terms > 0, F.call_function("div", above, below) + 1).otherwise(1)


def _tile_distances(tile_sources: int):
    def distances(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        """Sums of |p - q| over the block's terms, for pairs of sources of two tiles."""
        lang, one, two, _ = key
        sources, place = np.unique(rows["number"].to_numpy(), return_inverse=True)
        base = np.zeros(sources.size, dtype=np.int64)
        base[place] = rows["base"].to_numpy()
        held = (rows["split"] >= 0).to_numpy()
        terms, column = np.unique(rows.loc[held, ["digest", "split"]].to_numpy(), axis=0, return_inverse=True)
        table = np.repeat(base[:, None], len(terms), axis=1)
        table[place[held], column.ravel()] = rows["p"].to_numpy()[held]
        a = np.flatnonzero(sources // tile_sources == one)
        b = np.flatnonzero(sources // tile_sources == two)
        out = np.empty((a.size, b.size), dtype=np.int64)
        for i, row in enumerate(a):
            out[i] = np.abs(table[b] - table[row]).sum(axis=1)
        return pd.DataFrame(
            {
                "lang": lang,
                "a": np.repeat(sources[a], b.size),
                "b": np.tile(sources[b], a.size),
                "block_sum": (out - np.abs(base[b][None, :] - base[a][:, None]) * len(terms)).ravel(),
            }
        )

    return distances


def _pairs(counts: DataFrame, groups: DataFrame, block_terms: int, tile_sources: int) -> DataFrame:
    """(lang, a, b, block_sum) of pairs of numbered sources of a language.

    Two sources differ by |p0 - q0| at every term that neither holds; block_sum is what
    the terms held by a source of either tile add to V |p0 - q0|.  A block has some
    ``block_terms`` terms and two tiles of sources, so a task's table is bounded for any
    number of terms and sources.
    """
    blocks = F.ceil(F.col("terms") / block_terms).cast("long")
    held = counts.join(groups, ["lang", "source"]).withColumn("block", F.pmod(F.xxhash64("digest", "split"), blocks))
    shared = ["lang", "number", "sources", "base", "block"]
    p = _share(F.col("n"), F.col("total"), F.col("terms"))
    held = held.select(*shared, "digest", F.col("split").cast("long").alias("split"), p.alias("p"))
    # One row per block tells a source that holds none of its terms.
    present = groups.where("terms > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    present = present.select(*shared, F.lit(0).cast("long").alias("digest"), F.lit(-1).cast("long").alias("split"), F.col("base").alias("p"))
    tile = F.floor(F.col("number") / tile_sources).cast("int")
    last = F.floor((F.col("sources") - 1) / tile_sources).cast("int")
    held = held.unionByName(present).withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    held = held.withColumns({"one": F.least("tile", "other"), "two": F.greatest("tile", "other")}).drop("tile", "other", "sources")
    tiles = held.groupBy("lang", "one", "two", "block")
    sums = tiles.applyInPandas(_tile_distances(tile_sources), "lang string, a long, b long, block_sum long")
    sums = sums.where("a != b").groupBy("lang", "a", "b").agg(F.sum("block_sum").alias("block_sum"))
    return sums


def source_divergence(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    digest_bits: int = 64,
    block_terms: int = BLOCK_TERMS,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """(lang, source, part, item, value, rank) as the module describes.

    ``docs`` has text, lang and source; null ones are empty strings, and every (lang, source)
    that occurs takes part, with no terms too.  Part `pair` ranks the other sources of the
    language by distance, part `term` the at most ``top_terms`` terms that the source uses
    more than its language; ties go to the smaller item by UTF-8 bytes.  Rows that repeat count each;
    an empty table gives no rows; other columns are not looked at.  ``digest_bits`` under 64
    makes terms share digests, for tests.
    """
    counted = count_terms(docs, digest_bits)
    counts, dictionary = kept_terms(counted, min_documents)
    present = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    in_lang = Window.partitionBy("lang")
    langs = counts.groupBy("lang", "digest", "split").agg(F.first("lang_n").alias("lang_n"))
    langs = langs.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = present.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["terms", "lang_total", "total"])
    groups = groups.withColumn("number", F.row_number().over(in_lang.orderBy("source")).cast("long") - 1)
    groups = groups.withColumn("sources", F.count("*").over(in_lang))
    groups = groups.withColumn("base", _share(F.lit(0), F.col("total"), F.col("terms")))
    groups = stage_table(groups, "term-groups")

    sums = _pairs(counts, groups, block_terms, tile_sources)
    mine = groups.select("lang", "source", "terms", F.col("number").alias("a"), F.col("base").alias("p0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("base").alias("q0"))
    both = mine.join(other, "lang").where("a != b")
    turned = sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "block_sum")
    turned = sums.unionByName(turned).groupBy("lang", "a", "b").agg(F.first("block_sum").alias("block_sum"))
    value = F.coalesce("block_sum", F.lit(0)) + F.col("terms") * F.abs(F.col("p0") - F.col("q0"))
    pairs = both.join(turned, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    ranking = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    pairs = pairs.withColumn("rank", F.row_number().over(ranking.orderBy(F.col("value").desc(), "item")))

    p = _share(F.col("n"), F.col("total"), F.col("terms"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    more = counts.join(groups, ["lang", "source"]).select("lang", "source", "digest", "split", (p - q).alias("value"))
    # Ties at the last place are only broken by text, so all of them are kept until it is there.
    near = more.where("value > 0").withColumn("place", F.rank().over(ranking)).where(F.col("place") <= top_terms)
    named = near.join(dictionary, ["digest", "split"]).withColumnRenamed("term", "item")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    named = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    terms = named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.select(*terms.columns).unionByName(terms)


def oracle() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, translate(coalesce(text, ''), '{upper}', '{lower}') AS t,
            coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
    groups AS (SELECT DISTINCT lang, source FROM d),
    hits AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS lang_n FROM hits GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
    counts AS (SELECT lang, source, term, count(*) AS n FROM hits JOIN kept USING (lang, term) GROUP BY lang, source, term),
    langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
    totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
    shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
            1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * l.v) AS p,
            1 + (CAST(1000000000 AS HUGEINT) * (k.lang_n + 5)) // (l.total + 5 * l.v) AS q
          FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
          LEFT JOIN totals s ON s.lang = g.lang AND s.source = g.source
          LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
          FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
