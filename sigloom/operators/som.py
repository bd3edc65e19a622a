"""Self-organizing map trained in batches.

The neighbourhood weight of a row depends only on the unit it falls on, so an
epoch needs just the row count and vector sum of each unit: one distributed
pass, then a smoothing of the model-sized grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions.vectors import as_doubles, unit_x, unit_y
from sigloom.operators.kernel import MAX_CODEBOOK, assign, unit_sums
from sigloom.scale import bounded_rows


@dataclass
class Codebook:
    """Weights of a grid of ``width`` rows by ``height`` columns; unit = x * height + y."""

    width: int
    height: int
    weights: np.ndarray
    history: list[tuple[int, float, float, float]] = field(default_factory=list)

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(u, u // self.height, u % self.height, [float(v) for v in w]) for u, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, "unit int, x int, y int, weight array<double>")

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "epoch int, rate double, radius double, error double")


def codebook_from_table(table: DataFrame) -> Codebook:
    """A codebook from (unit, x, y, weight) rows; the grid shape is read from the rows."""
    rows = sorted(bounded_rows(table.select("unit", "x", "y", "weight"), MAX_CODEBOOK, "codebook"))
    width, height = max(r.x for r in rows) + 1, max(r.y for r in rows) + 1
    return Codebook(width, height, np.array([r.weight for r in rows], dtype="float64"))


def write_packed_codebook(codebook: Codebook, spark: SparkSession, path: str) -> None:
    """All weights, unit by unit, one number per line."""
    lines = [(repr(float(v)),) for v in codebook.weights.ravel()]
    # A codebook is model-sized, and the order of its lines is its meaning, so it is one file.
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)


def read_packed_codebook(spark: SparkSession, path: str, width: int, height: int) -> Codebook:
    """A codebook from one number per line; the grid shape must be given, the vector size follows from it."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    numbers = [float(v) for r in sorted(bounded_rows(files, 10_000, "codebook files")) for v in r["value"].split()]
    return Codebook(width, height, np.array(numbers).reshape(width * height, -1))


def decay(epoch: int, epochs: int, first: float, last: float) -> float:
    """Linear decay from ``first`` to ``last`` over the epochs, then constant."""
    if epochs <= 1 or epoch >= epochs - 1:
        return first if epochs <= 1 else last
    return first + (last - first) * epoch / (epochs - 1)


def initial_codebook(df: DataFrame, width: int, height: int, key: str, vector: str = "vector") -> Codebook:
    """Start from the rows with the smallest key hash, reused in turn when there are fewer rows than units.

    Only rows below a hash bound are ordered: about four times as many as
    units, however many rows there are.
    """
    units = width * height
    df = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    total = df.count()
    if not total:
        raise ValueError("no rows to train on")
    digest = F.md5(F.col(key).cast("string"))
    hashed = df.select(digest.alias("h"), F.col(key).alias("k"), as_doubles(vector).alias("v"))
    wanted = min(units, total)
    rows: list = []
    share = 4.0 * units / total
    while len(rows) < wanted:
        below = F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint") < int(min(share, 1.0) * 2**32)
        rows = hashed.filter(below).orderBy("h", "k").limit(wanted).collect()
        share *= 4
    return Codebook(width, height, np.array([rows[u % len(rows)]["v"] for u in range(units)]))


def _gauss(n: int, radius: float) -> np.ndarray:
    at = np.arange(n, dtype="float64")
    return np.exp(-((at[:, None] - at[None, :]) ** 2) / (2.0 * radius * radius))


def smooth(codebook: Codebook, counts: np.ndarray, sums: np.ndarray, radius: float, rate: float = 1.0) -> np.ndarray:
    """New weights: neighbourhood-weighted mean of the rows, blended with the old weights by ``rate``.

    The Gaussian is a product over the two grid axes, so two small matrix
    products replace a units x units one.  Units that no row reaches keep their weights.
    """
    w, h, d = codebook.width, codebook.height, codebook.weights.shape[1]
    across, along = _gauss(w, radius), _gauss(h, radius)
    mass = across @ counts.reshape(w, h).astype("float64") @ along
    pulled = np.tensordot(across, sums.reshape(w, h, d), axes=(1, 0))
    pulled = np.einsum("xyd,yz->xzd", pulled, along, optimize=True)
    mass, pulled = mass.reshape(-1), pulled.reshape(-1, d)
    target = np.where(mass[:, None] > 0, pulled / np.where(mass > 0, mass, 1.0)[:, None], codebook.weights)
    return codebook.weights + rate * (target - codebook.weights)


def som_epoch(
    df: DataFrame, codebook: Codebook, radius: float, rate: float = 1.0, vector: str = "vector"
) -> tuple[Codebook, float]:
    """One batch epoch: the new codebook and the mean distance to the old one."""
    units, size = codebook.weights.shape
    rows = bounded_rows(unit_sums(df, vector, codebook.weights), units, "unit sums")
    counts, sums = np.zeros(units, dtype="int64"), np.zeros((units, size))
    for r in rows:
        counts[r["unit"]], sums[r["unit"]] = r["n"], r["s"]
    total = int(counts.sum())
    error = sum(r["dist"] for r in rows) / total if total else 0.0
    fresh = smooth(codebook, counts, sums, radius, rate) if total else codebook.weights
    return Codebook(codebook.width, codebook.height, fresh, list(codebook.history)), error


def fit_som(
    df: DataFrame,
    key: str,
    width: int = 100,
    height: int = 100,
    epochs: int = 20,
    rate: tuple[float, float] = (1.0, 1.0),
    radius: tuple[float, float] = (30.0, 5.0),
    vector: str = "vector",
    start: Codebook | None = None,
) -> Codebook:
    """Train a map; rate and radius fall linearly.

    A height or width of 1 gives a one-dimensional map, as used for a second
    level over (x, y).
    """
    rows = df.select(key, as_doubles(vector).alias("vector")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        codebook = start or initial_codebook(rows, width, height, key)
        for epoch in range(epochs):
            r, a = decay(epoch, epochs, *radius), decay(epoch, epochs, *rate)
            codebook, error = som_epoch(rows, codebook, r, a)
            codebook.history.append((epoch, a, r, error))
        return codebook
    finally:
        rows.unpersist()


def som_assign(df: DataFrame, codebook: Codebook, keys: Sequence[str], vector: str = "vector") -> DataFrame:
    """(keys…, unit, x, y, dist): the best unit of each vector and its place on the grid."""
    found = assign(df, keys, vector, codebook.weights)
    return found.select(
        *keys, "unit", unit_x("unit", codebook.height).alias("x"), unit_y("unit", codebook.height).alias("y"),
        F.sqrt("dist").alias("dist"),
    )


def som_error(assigned: DataFrame) -> DataFrame:
    """Mean and largest distance of the rows to their units."""
    return assigned.agg(F.avg("dist").alias("mean_error"), F.max("dist").alias("max_error"))


def som_occupancy(assigned: DataFrame) -> DataFrame:
    """Rows per grid place."""
    return assigned.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
