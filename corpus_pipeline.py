"""Corpus cleaning in five stages; each works on what its predecessor kept.

Toxic documents go, one document of each near-duplicate group stays, documents that leak a benchmark item go, secrets
are masked, and what is left is encoded.  All stages but the last return the columns of ``documents``; a stage written
as Parquet and read again is the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import decontaminate, pieces, secrets, simhash, toxicity
from sigloom.llm.common import table
from sigloom.scale import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half, by a model of the labelled rows that are not held out."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity(F.coalesce("text", F.lit("")), model)["score"] < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret and the length of the text as it is then."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids."""
    return pieces.tokenize(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("sentencepiece", encode),
]
# A fitted model and a tokenizer are beyond SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
