"""Clean a corpus and pack it for training: four stages, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazaarlake.llm.common import table
from bazaarlake.llm.order_minhash import first_of_each_group
from bazaarlake.llm.packing import pack
from bazaarlake.llm.quality_cnn import classify, train
from bazaarlake.llm.secret_scan import masked_documents
from bazaarlake.session import scratch_path

# What packing leaves in the Python workers is there while other stages run.
REMEMBERED_CHUNKS = 250_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels, takes for good ones."""
    network = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, network, docs.columns, keep=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return first_of_each_group(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked."""
    return masked_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, laid into training windows."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, path, ["doc_id"], with_ids=False, remembered=REMEMBERED_CHUNKS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# A trained network and a tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
