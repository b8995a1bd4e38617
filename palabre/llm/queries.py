"""The registered queries of this subpackage; ``ORACLES`` has the SQL twins of some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palabre.llm.bpe import encode_documents
from palabre.llm.common import bound_batches, read_table
from palabre.llm.exact_dedup import exact_duplicates
from palabre.llm.language_id import predict_language, train_language_id
from palabre.llm.license_scan import scan_licenses
from palabre.llm.merkle import document_manifest
from palabre.llm.near_dedup import near_duplicates
from palabre.llm.oracles import ORACLES
from palabre.llm.packing import pack_documents
from palabre.llm.pii import pseudonymise
from palabre.llm.quality import judge_quality
from palabre.llm.repeats import remove_repeats
from palabre.llm.toxicity import score_toxicity, train_toxicity
from palabre.llm.url_filter import filter_urls
from palabre.llm.whitening import whiten_embeddings


#: For the checked queries; a user keeps a key of their own secret.
PSEUDONYM_KEY = "palabre-check"


def _fold(folds: int) -> Column:
    """The part a document is in: the CRC-32 of its id as text, modulo the parts."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from pages whose id has a label: low quality or toxic ones are blocked."""
    pages = read_table(spark, sf_dir, "pages")
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)).alias("blocked"),
    )
    return filter_urls(pages, pages.select("page_id", "url").join(labels, "page_id"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PSEUDONYM_KEY, counted="n_private")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(read_table(spark, sf_dir, "documents"))
    distances = {c: F.round(c, 6) for c in ("kinds_distance", "words_distance")}
    return judged.withColumns(distances)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(docs, tokenizer, digests_only=True)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = train_language_id(docs.filter(_fold(4) != 2))
    predicted = predict_language(docs, model)
    return predicted.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").filter(_fold(5) != 0)
    scored = score_toxicity(docs, train_toxicity(docs, labels))
    return scored.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", "predicted")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, digests_only=True)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark, 64)
    return remove_repeats(read_table(spark, sf_dir, "documents"), digests_only=True)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Vectors are short; larger batches make fewer and larger products.
    bound_batches(spark, 10_000)
    return whiten_embeddings(read_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark, 10_000)
    return document_manifest(read_table(spark, sf_dir, "documents"), _fold(3) == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_license_scan": op2_license_scan,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_quality_rules": op4_quality_rules,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
}

__all__ = ["ORACLES", "PSEUDONYM_KEY", "QUERIES"]
