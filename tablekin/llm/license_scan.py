"""Licence scan by canonical digest: whole texts, and whole lines, joined with known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Short licence notices that are known without a table of full texts.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
]
# MD5 of the canonical form of full licence texts as Linux distributions ship them.
FULL_TEXTS = [
    ("Apache-2.0", "bb90ddb921a4bcfa8bbc590c5f5577e2"),  # 1571 words
    ("Artistic-1.0", "16ce2a0e3a36daef45584aa03b283555"),  # 960 words
    ("BSD-3-Clause", "6989781d8e3e31bf06f590dd203d4e65"),  # 217 words
    ("CC0-1.0", "93a180096f6cfcf2c0dd24f75c2eec48"),  # 1088 words
    ("GFDL-1.2", "cc01ca980940972208eb713c9ec0139c"),  # 3305 words
    ("GFDL-1.3", "ed41361b493868c950e226a26679485b"),  # 3710 words
    ("GPL-1.0", "b37a688f44419d3168b23775b65749eb"),  # 2067 words
    ("GPL-2.0", "707992d5752580ab5b883e8a7baf875a"),  # 2965 words
    ("GPL-3.0", "f64797b28d40d59d82ee3ff9013adebb"),  # 5662 words
    ("LGPL-2.0", "49c35a2f80e5ce15f8ab7230f3eb4dc2"),  # 4165 words
    ("LGPL-2.1", "f3e4b8b3f89fd84b83748e4530f560c1"),  # 4366 words
    ("LGPL-3.0", "b31b7335bc37919e8cdd79154e04d88d"),  # 1231 words
    ("MPL-1.1", "b7edc06df79bc44a04f12befb8111960"),  # 3760 words
    ("MPL-2.0", "35fb4d2625087f7fd780039aa7b4ebb2"),  # 2414 words
]
# Spellings that licence texts use alike.
SPELLINGS = [
    ("licence", "license"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("acknowledgement", "acknowledgment"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
]
COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©)[^\n]*$"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, words of letters and digits with single spaces, one spelling of each."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def digest(text: Column) -> Column:
    return F.md5(canonical(text).cast("binary"))


def known_notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "license_id string, text string")


def known_texts(spark: SparkSession) -> DataFrame:
    """(license_id, known): canonical digests of full licence texts."""
    return spark.createDataFrame(FULL_TEXTS, "license_id string, known string")


def scan_licenses(docs: DataFrame, licenses: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): digest, license_id, notices and n_notices.

    ``licenses`` (license_id, text) are known texts and ``digests`` (license_id, known)
    known canonical digests; of equal ones the first id counts.  ``digest`` is that of the
    whole canonical text, ``license_id`` the licence that it equals; ``notices`` lists the
    licences that whole lines equal (sorted, comma separated, '' if none) and ``n_notices``
    counts those lines.  Texts and lines without a letter or digit equal nothing; a null
    text has a null digest.  Rows are told apart by id and text: those that repeat an id, or have
    none, keep their own notices, and rows that repeat both have equal ones.  Only
    lines that equal a licence are shuffled.
    """
    known = licenses.select("license_id", digest(F.col("text")).alias("known"), canonical(F.col("text")).alias("words"))
    known = known.where("words != ''").select("license_id", "known")
    if digests is not None:
        known = known.unionByName(digests.select("license_id", "known"))
    known = known.groupBy("known").agg(F.min("license_id").alias("license_id"))
    own = F.md5(F.col("text").cast("binary"))
    whole = docs.select("doc_id", digest(F.col("text")).alias("digest"), own.alias("own"))
    lines = docs.select(F.col("doc_id").alias("line_doc"), own.alias("line_own"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.where(F.length("line") > 0).select("line_doc", "line_own", "place", digest(F.col("line")).alias("line_digest"))
    found = lines.join(known.select("known", F.col("license_id").alias("notice")), F.col("line_digest") == F.col("known"))
    found = found.groupBy("line_doc", "line_own").agg(
        F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("notices"), F.count_distinct("place").alias("n_notices")
    )
    out = whole.join(known, F.col("digest") == F.col("known"), "left")
    out = out.join(found, F.col("doc_id").eqNullSafe(F.col("line_doc")) & (F.col("own") == F.col("line_own")), "left")
    return out.select(
        "doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notices", F.lit(0)).alias("n_notices")
    )


def oracle() -> str:
    """DuckDB twin of ``scan_licenses`` over documents with the notices and digests above."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canon(text: str) -> str:
        out = f"regexp_replace(lower({text}), '(?m)^[ \\t]*(?:copyright|\\(c\\)|©)[^\\n]*$', ' ', 'g')"
        out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        for old, new in SPELLINGS:
            out = f"replace({out}, {quoted(old)}, {quoted(new)})"
        return out

    rows = ", ".join(f"({quoted(k)}, {quoted(t)})" for k, t in NOTICES)
    full = ", ".join(f"({quoted(k)}, {quoted(d)})" for k, d in FULL_TEXTS)
    return f"""
    WITH known AS (SELECT known, min(license_id) AS license_id FROM (
                     SELECT license_id, md5({canon('text')}) AS known
                     FROM (VALUES {rows}) AS v(license_id, text) WHERE {canon('text')} <> ''
                     UNION ALL SELECT * FROM (VALUES {full}) AS w(license_id, known)) GROUP BY known),
    d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
    found AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n_notices
              FROM lines JOIN known ON md5({canon('line')}) = known WHERE length(line) > 0 GROUP BY r)
    SELECT d.doc_id, md5({canon('d.text')}) AS digest, k.license_id,
           coalesce(f.notices, '') AS notices, coalesce(f.n_notices, 0) AS n_notices
    FROM d LEFT JOIN known k ON md5({canon('d.text')}) = k.known LEFT JOIN found f ON f.r = d.r
    """
