"""Evaluation of (label, prediction) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(predicted: DataFrame) -> DataFrame:
    """Share of rows whose prediction is the label."""
    return predicted.agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy"))


def confusion(predicted: DataFrame) -> DataFrame:
    """Rows per (label, prediction)."""
    return predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def weighted_prf(predicted: DataFrame) -> DataFrame:
    """Precision, recall and F-measure, averaged over the labels by their number of rows.

    Everything after the confusion counts works on at most classes x classes rows.
    """
    counts = confusion(predicted)
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    by_label = counts.groupBy("label").agg(F.sum("n").alias("support"), hit.alias("hits"))
    by_prediction = counts.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    rows = by_label.join(by_prediction, "label", "left")
    precision = F.when(F.coalesce("predicted", F.lit(0)) == 0, F.lit(0.0)).otherwise(F.col("hits") / F.col("predicted"))
    recall = F.col("hits") / F.col("support")
    f = F.when(precision + recall == 0, F.lit(0.0)).otherwise(2 * precision * recall / (precision + recall))
    total = F.sum("support")
    return rows.agg(
        (F.sum(precision * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(recall * F.col("support")) / total).alias("weighted_recall"),
        (F.sum(f * F.col("support")) / total).alias("weighted_f"),
    )
