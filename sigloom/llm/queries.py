"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import decontaminate, pieces, secrets, simhash, toxicity
from sigloom.llm.common import bounded_batches, table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every rule in all documents, with counts and a digest of the base kinds."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, kinds), F.sha2(secrets.told(base), 256).alias("base_sha256"), secrets.told(F.col("spans")).alias("spans")
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the text that they decode to."""
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(pieces.read_model())
    rows = table(spark, sf_dir, "documents").select("doc_id", pieces.encode_checked(F.col("text"), model).alias("out"))
    return rows.select(
        "doc_id",
        F.coalesce(F.size("out.ids"), F.lit(0)).alias("n_tokens"),
        F.col("out.ids").alias("token_ids"),
        F.col("out.sha256").alias("decoded_sha256"),
        F.col("out.exact").alias("exact"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it leaks."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, from a model that has not seen the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return groups.select("doc_id", fingerprint, F.col("component").alias("component_id"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_sentencepiece": op2_sentencepiece,
    "op4_decontamination": op4_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_simhash_dedup": op7_simhash_dedup,
}
