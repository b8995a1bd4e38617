"""The corpus pipeline: each stage works on all that the one before it kept.

Toxic documents go, then exact copies, then near copies; private values get pseudonyms,
and what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palabre.llm.common import bound_batches, read_table, stage
from palabre.llm.exact_dedup import drop_exact_duplicates
from palabre.llm.near_dedup import drop_near_duplicates
from palabre.llm.packing import pack_documents
from palabre.llm.pii import pseudonymise
from palabre.llm.queries import PSEUDONYM_KEY
from palabre.llm.toxicity import drop_toxic, train_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labelled ones, doesn't reject."""
    bound_batches(spark)
    return drop_toxic(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    bound_batches(spark)
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    bound_batches(spark)
    return drop_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, private values replaced; ``n_chars`` is that of the new text."""
    masked = pseudonymise(docs, PSEUDONYM_KEY)
    if "n_chars" not in masked.columns:
        return masked
    size = F.length("text").cast(masked.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2,048 ids."""
    bound_batches(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), digests_only=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

#: None: training, hashing and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
