"""Gaussian mixtures by expectation maximization over soft sums.

A round is one pass: every task holds the model (k components, broadcast), computes the responsibilities of its rows with
log-sum-exp, and adds up for each component the responsibilities, the weighted rows and their weighted squares.  One row
per component and task is shuffled; the driver gets k rows and makes the next model.  Covariances are diagonal (one
variance per component and dimension) or tied (one full matrix that all components share), so a component needs no more
rows than dimensions, and k = 100 works on a few hundred rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.functions.vectors import as_doubles, sum_vectors
from sigloom.operators.embed import vector_size
from sigloom.operators.kernel import MAX_CODEBOOK, matrix_of, unit_sums
from sigloom.operators.som import initial_codebook
from sigloom.scale import bounded_rows

# Share of the overall variance below which no variance falls.
FLOOR = 1e-3
# Mean log-likelihood a row that a round must gain to go on.
GAIN = 1e-4
# Rounds of nearest means before the first one of expectation maximization.
START_ROUNDS = 5
_BLOCK = 2_000_000


@dataclass
class Mixture:
    """``spread``: (k, d) variances of a diagonal mixture, or the (d, d) covariance of a tied one."""

    weights: np.ndarray
    means: np.ndarray
    spread: np.ndarray
    covariance: str = "diagonal"
    history: tuple[float, ...] = ()


def log_densities(points: np.ndarray, model: Mixture) -> np.ndarray:
    """Log of weight times density of each component (column) at each point (row)."""
    d = points.shape[1]
    # Around the common mean, so that the expanded squares keep their digits.
    middle = model.weights @ model.means
    points, means = points - middle, model.means - middle
    if model.covariance == "tied":
        root = np.linalg.cholesky(model.spread)
        points, means = np.linalg.solve(root, points.T).T, np.linalg.solve(root, means.T).T
        size = 2 * np.log(np.diag(root)).sum()
        far = (points**2).sum(axis=1)[:, None] - 2 * points @ means.T + (means**2).sum(axis=1)
    else:
        size = np.log(model.spread).sum(axis=1)
        sharp = 1 / model.spread
        far = points**2 @ sharp.T - 2 * points @ (means * sharp).T + (means**2 * sharp).sum(axis=1)
    with np.errstate(divide="ignore"):
        return np.log(model.weights) - 0.5 * (d * np.log(2 * np.pi) + size + np.maximum(far, 0.0))


def responsibilities(points: np.ndarray, model: Mixture) -> tuple[np.ndarray, np.ndarray]:
    """(share of each component in each point, log-likelihood of each point)."""
    scores = log_densities(points, model)
    top = scores.max(axis=1)
    parts = np.exp(scores - top[:, None])
    total = parts.sum(axis=1)
    return parts / total[:, None], top + np.log(total)


def _blocks(batches: Iterator[pa.RecordBatch], column: int, width: int, k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, _BLOCK // max(k, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, matrix_of(part.column(column), width)


def soft_sums(df: DataFrame, model: Mixture, vector: str = "vector") -> DataFrame:
    """(component, n, s, q, loglik): responsibilities, weighted rows and weighted squares added up, one row a component.

    ``loglik`` is the log-likelihood of all rows, held by component 0.
    """
    k, width = model.means.shape
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found = shared.value, 0.0
        n, s, q = np.zeros(k), np.zeros((k, width)), np.zeros((k, width))
        for _, points in _blocks(batches, 0, width, k):
            share, likelihood = responsibilities(points, own)
            n += share.sum(axis=0)
            s += share.T @ points
            q += share.T @ points**2
            found += likelihood.sum()
        offsets = pa.array(np.arange(0, k * width + 1, width), pa.int32())
        logs = np.zeros(k)
        logs[0] = found
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (s, q)]
        yield pa.record_batch([pa.array(np.arange(k), pa.int32()), pa.array(n), *lists, pa.array(logs)], names=["component", "n", "s", "q", "loglik"])

    schema = "component int, n double, s array<double>, q array<double>, loglik double"
    partial = df.select(as_doubles(vector).alias("_v")).mapInArrow(run, schema)
    return partial.groupBy("component").agg(
        F.sum("n").alias("n"), sum_vectors(F.col("s"), width).alias("s"), sum_vectors(F.col("q"), width).alias("q"), F.sum("loglik").alias("loglik")
    )


def second_moments(df: DataFrame, middle: np.ndarray, vector: str = "vector") -> np.ndarray:
    """The sum of (x - middle)(x - middle)' over all rows."""
    width = len(middle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, points in _blocks(batches, 0, width, width):
            total += (points - middle).T @ (points - middle)
        yield pa.record_batch([pa.array(np.arange(width), pa.int32()), pa.array(total.tolist())], names=["place", "s"])

    rows = df.select(as_doubles(vector).alias("_v")).mapInArrow(run, "place int, s array<double>")
    added = rows.groupBy("place").agg(sum_vectors(F.col("s"), width).alias("s"))
    out = np.zeros((width, width))
    for row in bounded_rows(added, width, "second moments"):
        out[row["place"]] = row["s"]
    return out


def mixture_step(df: DataFrame, model: Mixture, floor: np.ndarray, moments: np.ndarray | None = None, vector: str = "vector") -> tuple[Mixture, float]:
    """(next model, mean log-likelihood of the given one); ``floor``: least variance of each dimension.

    A tied model needs ``moments``: the second moments of the rows around the origin.
    """
    k, width = model.means.shape
    n, s, q, total = np.zeros(k), np.zeros((k, width)), np.zeros((k, width)), 0.0
    for row in bounded_rows(soft_sums(df, model, vector), k, "mixture components"):
        i = row["component"]
        n[i], s[i], q[i] = row["n"], row["s"], row["q"]
        total += row["loglik"]
    count = n.sum()
    # A component without rows keeps its place.
    held = n > 1e-10
    means = np.where(held[:, None], s / np.where(held, n, 1.0)[:, None], model.means)
    if model.covariance == "tied":
        spread = (moments - (means * n[:, None]).T @ means) / count
        spread = (spread + spread.T) / 2 + np.diag(floor)
    else:
        squares = q / np.where(held, n, 1.0)[:, None] - means**2
        spread = np.where(held[:, None], np.maximum(squares, floor), model.spread)
    mean = total / count
    return Mixture(n / count, means, spread, model.covariance, (*model.history, mean)), mean


def fit_gmm(
    df: DataFrame, k: int = 100, max_iter: int = 100, seed: int = 11, vector: str = "vector", covariance: str = "diagonal"
) -> Mixture:
    """A mixture of ``k`` components.

    It starts from the ``k`` distinct vectors with the smallest hashes, moved to the means of the rows nearest to them a
    few times, and from the overall variance.
    """
    if covariance not in ("diagonal", "tied"):
        raise ValueError(f"unknown covariance: {covariance}")
    rows = df.select(as_doubles(vector).alias("vector")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        width = vector_size(rows)
        if k * width > MAX_CODEBOOK:
            raise ValueError(f"{k} components of {width} numbers are more than a model may have")
        told = F.concat_ws(":", F.lit(seed), F.col("vector").cast("string")).alias("key")
        # Equal starts would stay equal for ever.
        starts = initial_codebook(rows.select(told, "vector").dropDuplicates(["key"]), k, 1, "key").weights
        starts = np.unique(starts, axis=0)
        k = len(starts)
        for _ in range(START_ROUNDS):
            for row in bounded_rows(unit_sums(rows, "vector", starts), k, "start sums"):
                starts[row["unit"]] = np.array(row["s"]) / row["n"]
        whole = Mixture(np.ones(1), starts[:1] * 0, np.ones((1, width)))
        one, _ = mixture_step(rows, whole, np.zeros(width))
        variance = np.maximum(one.spread[0], 1e-12)
        floor = FLOOR * variance
        moments = second_moments(rows, np.zeros(width)) if covariance == "tied" else None
        spread = np.diag(variance) if covariance == "tied" else np.tile(variance, (k, 1))
        model, last = Mixture(np.full(k, 1.0 / k), starts, spread, covariance), -np.inf
        for _ in range(max_iter):
            model, now = mixture_step(rows, model, floor, moments)
            if now - last < GAIN:
                break
            last = now
        return model
    finally:
        rows.unpersist()


def mixture_assign(df: DataFrame, model: Mixture, keys: Sequence[str], vector: str = "vector", cluster: str = "cluster") -> DataFrame:
    """(keys…, cluster, probability): the component with the largest responsibility; ties go to the first."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(*keys, as_doubles(vector).alias("_v"))
    out = T.StructType([source.schema[c] for c in keys]).add(cluster, T.IntegerType()).add("probability", T.DoubleType())
    k, width = model.means.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, points in _blocks(batches, len(keys), width, k):
            share, _ = responsibilities(points, shared.value)
            best = np.round(share, 9).argmax(axis=1)
            columns = [part.column(i) for i in range(len(keys))]
            columns += [pa.array(best, pa.int32()), pa.array(share[np.arange(len(best)), best])]
            yield pa.record_batch(columns, names=[*keys, cluster, "probability"])

    return source.mapInArrow(run, out)


def save_mixture(model: Mixture, spark: SparkSession, path: str) -> None:
    """The model as one line of JSON."""
    parts = {n: getattr(model, n).tolist() for n in ("weights", "means", "spread")} | {"covariance": model.covariance, "history": list(model.history)}
    spark.createDataFrame([(json.dumps(parts),)], "value string").write.mode("overwrite").text(path)


def load_mixture(spark: SparkSession, path: str) -> Mixture:
    """The model that ``save_mixture`` wrote."""
    parts = json.loads(spark.read.text(path, wholetext=True).filter("value <> ''").first()[0])
    arrays = {n: np.array(parts[n]) for n in ("weights", "means", "spread")}
    return Mixture(**arrays, covariance=parts["covariance"], history=tuple(parts["history"]))
