"""A corpus pipeline of five stages over `documents`: quality, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read as the next stage's docs:

1. quality: documents that the classifier rejects (score under 0.7) go. It learns from the labelled rows among docs.
2. near_duplicates: of each class of near-duplicate documents the one with the least id stays.
3. secrets: found secrets are masked in the texts; every document stays.
4. mixing: documents are repeated or left out so that each source's words come near its target.
5. packing: the documents' tokens in sequences of at most 4096.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import best_fit_packing, dart_dedup, quality_classifier, secret_scans, source_mixing
from tidemark.llm.common import stored
from tidemark.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, quality_classifier.quality_model(docs, labels), 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scans.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mixing.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents one after another, each result written and read again in the shared folder."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        out = stored(stage(spark, out, sf_dir))
    return out


#: A learned classifier and a tokenizer can't be expressed in SQL.
ORACLE_SQL: str | None = None
