"""The stages of the corpus pipeline: documents in, documents out (the last: their encodings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, langid, neardup, secret_scan
from .common import table

#: A document whose best language has less than this share of the evidence is rejected.
LEAST_LANGUAGE_SHARE = 0.3
#: A document whose words fit the learned languages by less than this is in none of them.
LEAST_LANGUAGE_FIT = 0.85


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language: ``und``, none with a clear share of the evidence, or one that was not learned.

    The model learns from the labelled rows of docs.  Null and letterless texts are dropped;
    if no row is labelled, nothing can be recognised and only those are.
    """
    return langid.keep(docs, langid.fit(docs), LEAST_LANGUAGE_SHARE, fit=LEAST_LANGUAGE_FIT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at least 0.8 alike: that of the least doc_id, once.

    SimHash fingerprints of those shingles meet by pigeonring first; what they leave apart is found by bands, see ``neardup``.
    """
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that repeat a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in text; keeps every document, and n_chars is that of the new text."""
    return secret_scan.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document by byte-level BPE: (doc_id, n_tokens, ids, decoded_sha256)."""
    return bpe.tokens(docs)
