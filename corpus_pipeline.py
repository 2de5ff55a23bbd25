"""The corpus pipeline: from raw documents to packed training sequences.

Each stage reads the table that the one before it wrote. Every stage but the last only
drops rows and keeps the columns of ``documents``. Stages work on nulls, empty texts, repeated
rows and empty tables as their operators say; columns they do not know pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from tarmac.llm.queries import given, vocabulary
from tarmac.session import ensure_checkpoint_dir, remove_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a factorization machine, learned from ``labels``, does not reject."""
    return toxicity.without_toxic(docs, given(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, by way of a digest index."""
    return exact_dedup.distinct_texts(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in ``benchmark``."""
    return decontaminate.decontaminate(docs, given(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Training a model, alignment and tokenization have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    A stage's table is removed once the next one is written; the last one stays.
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = given(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
