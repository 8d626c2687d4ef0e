"""Training corpus: quality filter, near-copy removal, benchmark decontamination, source mix, token files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelcast.llm import decontaminate, jaccard, mixing, nbsvm, tokenids
from parcelcast.llm.common import store, table
from parcelcast.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts, at the threshold of its query."""
    return nbsvm.accept(docs, nbsvm.fit(docs, table(spark, sf_dir, "labels"))).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram join links: five-word shingles, similarity 0.8."""
    return jaccard.keep_one(docs, size=5, percent=80).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once, or up to three times."""
    return mixing.draw(docs, mixing.mix(docs)).select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the written token files hold of each copy of a document."""
    path = scratch_path(spark, "token-ids")
    tokenids.write(docs, path, tokenids.public_tokenizer())
    return tokenids.read(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID output", token_files),
]
ORACLE_SQL = None  # fitted models and tokenizers have no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store(docs, "stage")
    return docs
