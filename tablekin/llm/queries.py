"""One query per operator, applied to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekin.llm import (
    byte_bpe,
    decontaminate,
    filter_audit,
    hidden_markov,
    language_id,
    license_scan,
    mixing,
    ngram_join,
    permutation_index,
    source_divergence,
    surrogates,
    token_binary,
    toxicity,
)
from tablekin.llm.common import fold, read_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.similarity_classes(read_table(spark, sf, "documents"))


def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    known = license_scan.known_notices(spark), license_scan.known_texts(spark)
    return license_scan.scan_licenses(read_table(spark, sf, "documents"), *known)


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "clauses",
    )


def op5_hidden_markov(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    scored = hidden_markov.score_texts(docs, fold(F.col("doc_id"), 7) != 2)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies", "shards")


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    found = language_id.predict_languages(docs, language_id.fit_languages(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op8_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    return surrogates.replace_personal(read_table(spark, sf, "documents"))


def op9_permutation_index(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read_table(spark, sf, "embeddings")
    return permutation_index.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op10_token_binary(spark: SparkSession, sf: str) -> DataFrame:
    return token_binary.token_binary(read_table(spark, sf, "documents"), tokenizer_path())


def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence.source_divergence(read_table(spark, sf, "documents"))


def op12_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    vocabulary = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = byte_bpe.encode_texts(read_table(spark, sf, "documents"), *vocabulary)
    decoded = byte_bpe.decode_ids(encoded, *vocabulary)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.filter_audit(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_license_scan": op2_license_scan,
    "op3_decontamination": op3_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_hidden_markov": op5_hidden_markov,
    "op6_mixing": op6_mixing,
    "op7_language_id": op7_language_id,
    "op8_surrogates": op8_surrogates,
    "op9_permutation_index": op9_permutation_index,
    "op10_token_binary": op10_token_binary,
    "op11_source_divergence": op11_source_divergence,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": pipeline,
}


def oracles() -> dict[str, str]:
    return {
        "op2_license_scan": license_scan.oracle(),
        "op11_source_divergence": source_divergence.oracle(),
        "op13_filter_audit": filter_audit.oracle(),
    }
