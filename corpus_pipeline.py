"""From raw documents to packed sequences: each stage is one of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import fertility, lines, packing, simhash
from cellweave.llm.common import keep, tune
from cellweave.llm.queries import BANDS, END_OF_DOCUMENT, FERTILITY, MAX_BITS, SHINGLE, WORD_BPE, vocabulary

#: Tokeniser fertility, SimHash and packing have no counterpart in SQL.
ORACLE_SQL: str | None = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the bands of their language."""
    tune(spark)
    return fertility.without_rejected(docs, FERTILITY, BANDS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of 20 characters or more that three documents have and a later one keeps."""
    tune(spark)
    return lines.cleaned(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose SimHash fingerprints hang together the document of the least id."""
    tune(spark)
    return simhash.without_near_duplicates(docs, SHINGLE, MAX_BITS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens."""
    tune(spark)
    return packing.pack_documents(docs, vocabulary(WORD_BPE), END_OF_DOCUMENT)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", good),
    ("line dedup", without_repeated_lines),
    ("near dedup", without_copies),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each to what its predecessor wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
