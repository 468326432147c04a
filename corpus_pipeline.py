"""From raw documents to packed training sequences: five stages, each an operator of ``quillspark.llm``.

Every stage gets what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import mixing, neardup, packing, quality, secrets
from quillspark.llm.common import n_words, text_of, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled thresholds keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_documents(docs, labels, "doc_id", "text", F.col("lang"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity of 0.8 or more."""
    return neardup.kept_documents(docs, "doc_id", "text", neardup.Settings(words=5, percent=80))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets that only one owner has replaced by a placeholder; ``n_chars`` follows the text."""
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    cleared = secrets.redact(docs, "text", F.col("source"), repository)
    return cleared.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.taken(docs, n_words(text_of()), F.col("source"), F.col("doc_id"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), most=1024, end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Packing and near duplicates cannot be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the ``documents`` in a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
