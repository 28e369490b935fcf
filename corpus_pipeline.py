"""A corpus pipeline: language ID, near-duplicate removal, mixing to target weights, SentencePiece encoding."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricemill.llm import bpe, language, mixing, near_duplicates
from pricemill.llm.common import table
from pricemill.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters (null and empty texts too) and uncertain ones go.

    Repeated rows stay or go alike; an empty table stays empty; further columns stay.
    """
    return language.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of every class of exact and near copies.

    Null and empty texts are one class; rows that repeat a doc_id, or have none, stay if their texts are unlike; of equal ranks the hash
    of the row decides.  An empty table stays empty; further columns stay.
    """
    return near_duplicates.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per output shard, slot and span of a document in it.

    Documents without words are not taken, a null source is a source, and each row is a document of its own.  An empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text with its place in the mix, segmented with merge-dropout and checked to decode to the text.

    Null and empty texts have no tokens; rows with equal doc_id and place are segmented alike; an empty table stays empty.
    """
    return bpe.encode_documents(docs, place=[c for c in mixing.PLACE if c in docs.columns])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# A trained classifier, sketches and keyed permutations: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next one.

    What stages do with nulls, empty and long texts, ties, repeated rows and empty tables is told at each of them.
    """
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
