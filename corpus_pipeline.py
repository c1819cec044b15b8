"""From documents to token digests: language, near duplicates, secrets, mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.llm import bpe, langid, minhash, mixing, secrets
from allelespan.llm.common import ship, table
from allelespan.session import materialise


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` as of the text that is left."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose words have no certain language, go; several languages may stay."""
    ship(spark)
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (0.8 or more of shared five-word shingles) the document with the smallest id stays."""
    ship(spark)
    return minhash.keep_one(docs, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    ship(spark)
    return _with_length(secrets.redact(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last one of a source is cut at its budget."""
    ship(spark)
    return _with_length(mixing.mixed_documents(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is in the mix."""
    ship(spark)
    return bpe.token_digests(docs)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_duplicates),
    ("secret_scans", secret_scan),
    ("source_mixing", source_mix),
    ("byte_bpe", tokens),
]

#: Language ID, secrets found by likelihood and tokens are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
