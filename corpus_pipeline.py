"""Cleaning pipeline of a training corpus, from raw documents to packed sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, ngram_join, packing, secret_scan, toxicity
from tidemark.llm.common import table, written
from tidemark.llm.queries import tokenizer_files


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from all labels of these documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least doc_id."""
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in their sequences."""
    return packing.pack(docs, *tokenizer_files())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", jaccard_dedup),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scan", redact_secrets),
    ("differencing_packing", pack),
]

#: The stages learn a classifier and count tokens, which SQL cannot express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
