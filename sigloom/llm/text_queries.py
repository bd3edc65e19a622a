"""The registered queries of the operators on phrases, token alignments and periodic runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import licences, periods
from sigloom.llm.align import Alignment
from sigloom.llm.common import table, text_of

# Fixed value: what separates words in the contract of op13.
_GAPS = r"[\x20\x09-\x0D]+"


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the base phrases and labels of every rule in all documents."""
    found = licences.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"])

    def joined(detections: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["sure"])), F.lit(0.0)).alias("score"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and overlap links of two tokenizations of every document, with corpus-wide counts of linked id pairs."""
    found = Alignment(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    groups = found.groups().select("row", "n_groups", digest, "n_shared")
    out = found.sizes().withColumnRenamed("id", "doc_id").join(groups, "row").join(found.scores(), "row", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *counts, "groups_sha256", "n_shared")


def _made_periodic(docs: DataFrame) -> DataFrame:
    """The texts that the contract of op13 asks for: of some documents the words go on in periods."""
    rows = docs.select("doc_id", text_of("text").alias("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("words", F.when(F.expr("h % 10 = 0"), F.filter(F.split("text", _GAPS), lambda w: w != "")))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.expr("cast(floor(h / 10) % nullif(n, 0) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + floor((n - a) / (3 + floor(h / 10) % 8)) as int)"))
    period = F.expr("flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int)))")
    made = F.concat(F.expr("slice(words, 1, a)"), F.slice(period, 1, F.col("n") - F.col("a")))
    return rows.select("doc_id", F.when(F.expr("n > 0"), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, the longest one, and a digest of the text without repeats."""
    found = periods.find_runs(_made_periodic(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        best.alias("best"),
    )
    return out.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES = {
    "op11_license_scans": op11_license_scans,
    "op12_token_alignment": op12_token_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}
