"""Classifiers: naive Bayes as tables, naive Bayes, trees and forests on vectors, and key-hash splits."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions.paths import key_percent
from sigloom.functions.vectors import as_doubles, literal_array
from sigloom.operators.embed import vector_sums
from sigloom.operators.terms import MAX_TOPICS
from sigloom.scale import bounded_rows, rows_within, settle, within


def key_split(df: DataFrame, key: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows whatever the partitioning."""
    number = key_percent(key)
    return df.filter(number < percent), df.filter(number >= percent)


def labelled_points(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Rows (…, label double, vector array<double>) from a label column and feature columns."""
    return df.select(
        "*", F.col(label).cast("double").alias("label"), F.array(*[F.col(c).cast("double") for c in features]).alias("vector")
    )


@dataclass
class TermBayes:
    """Multinomial naive Bayes over terms.

    ``table`` holds (term, df, counts, theta) with one array entry per topic;
    ``priors`` are the log priors.  Topics are in alphabetical order.
    """

    topics: list
    priors: list[float]
    table: DataFrame


def fit_term_bayes(postings: DataFrame, topic_docs: DataFrame, smoothing: float = 1.0) -> TermBayes:
    """Train on (topic, term, tf) rows and a (topic, n) table.

    One aggregation over the postings; the term table is written to the shared
    folder, and its totals are read from there.
    """
    rows = sorted(bounded_rows(topic_docs.select("topic", "n"), MAX_TOPICS, "topics"))
    topics = [r["topic"] for r in rows]
    docs = sum(r["n"] for r in rows)
    priors = [math.log((r["n"] + smoothing) / (docs + smoothing * len(rows))) for r in rows]
    per_topic = [F.sum(F.when(F.col("topic") == t, F.col("tf")).otherwise(F.lit(0))) for t in topics]
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.array(*per_topic).alias("counts"))
    counts = settle(counts, "term-counts")
    totals = counts.agg(
        F.array(*[F.sum(F.col("counts")[i]) for i in range(len(topics))]).alias("t"), F.count(F.lit(1)).alias("v")
    ).first()
    below = literal_array([(t or 0) + smoothing * totals["v"] for t in totals["t"]])
    theta = F.zip_with("counts", below, lambda n, b: F.log((n + smoothing) / b))
    return TermBayes(topics, priors, counts.withColumn("theta", theta))


def theta_table(model: TermBayes) -> DataFrame:
    """Log probability of each term in each topic (topic, term, theta)."""
    names = F.array(*[F.lit(t) for t in model.topics])
    pairs = F.arrays_zip(names.alias("topic"), F.col("theta").alias("theta"))
    rows = model.table.select("term", F.explode(pairs).alias("p"))
    return rows.select("p.topic", "term", "p.theta")


def predict_term_bayes(postings: DataFrame, model: TermBayes, keys: Sequence[str]) -> DataFrame:
    """(keys…, topic, probability, log_scores) from (keys…, term, tf) rows.

    Unknown terms are ignored.  Rows made with ``term_freq(keep_empty=True)``
    give documents without any known term the prior.
    """
    size = len(model.topics)
    theta = model.table.select("term", "theta")
    if within(theta, rows_within(size)):
        joined = postings.join(F.broadcast(theta), "term", "left")
        sums = [
            (F.coalesce(F.sum(F.col("theta")[i] * F.col("tf")), F.lit(0.0)) + F.lit(model.priors[i])) for i in range(size)
        ]
        scored = joined.groupBy(*keys).agg(F.array(*sums).alias("log_scores"))
    else:
        # A posting carries a hash and a count, never a vector or a text.
        added = vector_sums(postings, theta.select(F.col("term").alias("word"), F.col("theta").alias("vector")), keys, size)
        scores = F.zip_with("vector", literal_array(model.priors), lambda s, p: s + p)
        scored = added.select(*keys, scores.alias("log_scores"))
    rounded = F.transform("log_scores", lambda s: F.round(s, 6))
    best = F.array_position(rounded, F.array_max(rounded)).cast("int")
    highest = F.array_max("log_scores")
    mass = F.aggregate("log_scores", F.lit(0.0), lambda a, s: a + F.exp(s - highest))
    names = F.array(*[F.lit(t) for t in model.topics])
    return scored.select(
        *keys,
        F.element_at(names, best).alias("topic"),
        (F.exp(F.element_at("log_scores", best) - highest) / mass).alias("probability"),
        "log_scores",
    )


def _points(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector(as_doubles("vector")))


def fit_bayes(df: DataFrame, smoothing: float = 1.0):
    """Multinomial naive Bayes on (label, vector) rows."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial").fit(_points(df))


def fit_tree(df: DataFrame, depth: int = 5, bins: int = 32, seed: int = 11):
    """Decision tree with Gini impurity."""
    return DecisionTreeClassifier(impurity="gini", maxDepth=depth, maxBins=bins, seed=seed).fit(_points(df))


def fit_forest(df: DataFrame, trees: int = 10, depth: int = 5, bins: int = 32, seed: int = 11):
    """Random forest with Gini impurity and the automatic feature subset."""
    forest = RandomForestClassifier(
        numTrees=trees, impurity="gini", maxDepth=depth, maxBins=bins, seed=seed, featureSubsetStrategy="auto"
    )
    return forest.fit(_points(df))


def predict(df: DataFrame, model) -> DataFrame:
    """Add ``prediction`` and the class ``probabilities`` of a fitted classifier to (…, vector) rows."""
    scored = model.transform(_points(df))
    return scored.select(*df.columns, "prediction", vector_to_array("probability").alias("probabilities"))
