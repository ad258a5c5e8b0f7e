"""The corpus pipeline: documents to token files, each stage by one operator of ``tablekin.llm``.

Stages take (spark, docs, sf_dir) and return a DataFrame; it is written as Parquet and
read back as the next stage's ``docs``.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekin.llm import decontaminate, mixing, ngram_join, token_binary, toxicity
from tablekin.llm.common import read_table, stage_packed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores below 0.5; it learns from the labelled rows among ``docs``."""
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(*COLUMNS), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that 5-word shingles (similarity 0.8) tie together.

    Rows are grouped by their texts alone, each under a number of its own: rows that repeat
    an id fold if their texts tie them together and stay apart otherwise.  Of rows with
    the smallest id the one of the least digest stays; a null id comes after all others.
    Texts without words fold only with the same text of the same id.
    """
    rows = stage_packed(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "pipeline-rows")
    groups = ngram_join.similarity_classes(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("component"), (F.col("n_shingles") == 0).alias("empty"))
    groups = stage_packed(groups, "pipeline-groups")
    digest = F.md5(F.col("text").cast("binary"))
    rest = F.xxhash64("lang", "source", "n_chars")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", digest.alias("digest"), rest.alias("rest"), "_row")
    members = groups.join(rows.select("_row", order.alias("order")), "_row")
    empty = [F.when(F.col("empty"), F.col(f"order.{c}")).alias(f"of_{c}") for c in ("doc_id", "digest")]
    group = [F.when(~F.col("empty"), F.col("component")).alias("of_component"), F.col("empty"), *empty]
    kept = members.groupBy(*group).agg(F.min("order").alias("first")).select("first._row")
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.keep_uncontaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as their source's target takes them."""
    return mixing.mix_documents(docs.select(*COLUMNS)).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and per document what they hold; repeated documents are written repeatedly."""
    import public_tokenizers

    return token_binary.token_binary(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", clean_toxicity),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_targets),
    ("token_binary", write_tokens),
]

#: Learned scores, shingle components and a tokenizer are not SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_packed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
