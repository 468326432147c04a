"""The registered queries of the operators for training text, and their SQL counterparts."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import (
    ann, collocations, extraction, merkle, mixing, neardup, oracles, packing, passages, quality, quality_lines, secrets, toxicity,
    wordpiece,
)
from quillspark.llm.common import n_words, text_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), VOCABULARY)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.judge(docs, labels, "doc_id", "text", F.col("lang"), ["doc_id"]).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, labels, "doc_id", "text"))
    return scored.select(
        "doc_id",
        (toxicity.fold_of("doc_id") == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_recurring(_table(spark, sf_dir, "documents"), window=35)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return neardup.near_duplicates(docs, "doc_id", "text", neardup.Settings(words=3, percent=85))


def op6_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter("vec_id % 50 = 0"), 5, "vec_id", "embedding")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return secrets.digest(secrets.scan(docs, "text", F.col("source"), repository, ["doc_id"]))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", n_words(text_of()).alias("size"))
    mixed = mixing.mix(docs, F.col("size"), F.col("source"), F.col("doc_id"))
    return mixed.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(_table(spark, sf_dir, "documents"), VOCABULARY)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.verified(docs, tampered, F.translate("text", ascii_uppercase, ascii_lowercase))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"), "text", F.coalesce("lang", F.lit("und")), least=30, most=2000)


def op13_line_field_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = quality_lines.score(docs, quality_lines.learn(docs, labels, "doc_id", "text"))
    return scored.select(
        "doc_id",
        (quality_lines.fold_of("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "n_lines",
        "n_bad_lines",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_two_fit_packing, op2_quality_rules, op3_toxicity_lexicon, op4_repeated_passages, op5_near_duplicates,
        op6_multiprobe_neighbours, op7_main_text, op8_secret_scan, op9_mix_sources, op10_token_counts,
        op11_merkle_manifest, op12_collocations, op13_line_field_quality,
    )
}
ORACLES = {
    "op2_quality_rules": oracles.quality_sql(),
    "op4_repeated_passages": oracles.passages_sql(35),
    "op5_near_duplicates": oracles.near_duplicates_sql(3, 85),
    "op8_secret_scan": oracles.secrets_sql(),
    "op11_merkle_manifest": oracles.merkle_sql(),
    "op12_collocations": oracles.collocations_sql(30, 2000),
}
