"""The corpus pipeline: toxicity, near-duplicates, benchmark passages, secrets, piece ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm import sentencepieces
from fleetlens.llm.catalog import MODEL
from fleetlens.llm.common import checkpointed, table
from fleetlens.llm.decontaminate import decontaminate
from fleetlens.llm.hyperminhash import without_near_duplicates
from fleetlens.llm.secrets import without_secrets
from fleetlens.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return without_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out; documents that consist of them for the most part go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return without_secrets(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, and whether these decode to the text."""
    encoded = sentencepieces.encode(docs, MODEL)
    return encoded.select(*[F.col("row")[name].alias(name) for name in docs.columns], "ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secret_scan", secret_scan),
    ("piece_ids", piece_ids),
]

#: The stages learn, search and tokenise; SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents; what a stage kept is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, checkpointed(docs) if k else docs, sf_dir)
    return docs
