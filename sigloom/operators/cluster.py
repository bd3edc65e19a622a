"""Clusters of vectors: k-means and reports on it."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions.vectors import as_doubles
from sigloom.operators.kernel import assign, unit_sums
from sigloom.scale import bounded_rows


def with_features(df: DataFrame, vector: str = "vector", features: str = "features") -> DataFrame:
    """Add the array column as an ML vector."""
    return df.withColumn(features, array_to_vector(as_doubles(vector)))


def fit_kmeans(df: DataFrame, k: int = 40, max_iter: int = 1000, seed: int = 11, vector: str = "vector") -> KMeansModel:
    """k-means on an array column; the trainer stops early once the centres rest."""
    return KMeans(k=k, maxIter=max_iter, seed=seed).fit(with_features(df, vector).select("features"))


def kmeans_assign(
    df: DataFrame, centers: np.ndarray, keys: Sequence[str], vector: str = "vector", cluster: str = "cluster"
) -> DataFrame:
    """(keys…, cluster, dist): the nearest centre and the squared distance; ties go to the first centre."""
    return assign(df, keys, vector, centers, unit=cluster)


def kmeans_step(df: DataFrame, centers: np.ndarray, vector: str = "vector") -> np.ndarray:
    """One Lloyd step: the mean of the rows of each centre; a centre without rows stays."""
    fresh = np.array(centers, dtype="float64")
    for r in bounded_rows(unit_sums(df, vector, fresh), len(fresh), "cluster sums"):
        fresh[r["unit"]] = np.array(r["s"]) / r["n"]
    return fresh


def wssse(assigned: DataFrame, dist: str = "dist") -> DataFrame:
    """Within-set sum of squared errors."""
    return assigned.agg(F.sum(dist).alias("wssse"))


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows per cluster."""
    return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def center_matrix(model: KMeansModel) -> np.ndarray:
    """Centres as a matrix."""
    return np.array(model.clusterCenters())


def centers_table(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    """Centres as rows (cluster, center)."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def model_assign(df: DataFrame, model, keys: Sequence[str], vector: str = "vector", cluster: str = "cluster") -> DataFrame:
    """(keys…, cluster) by a fitted k-means model."""
    return model.transform(with_features(df, vector)).select(*keys, F.col("prediction").cast("int").alias(cluster))
