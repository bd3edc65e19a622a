"""Nearest-unit search against a model-sized codebook.

Spark deals the rows; each task multiplies its Arrow batches with the
broadcast codebook.  ``unit_sums`` also adds the rows up inside the task, so
at most one row per unit and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.functions.vectors import as_doubles, sum_vectors

# Largest codebook (numbers) sent to the tasks: 64 million doubles are 512 MB.
MAX_CODEBOOK = 64_000_000
# Numbers in one block of the distance matrix: a few MB, which stay in the cache of a core.
_BLOCK = 1_000_000
# Distances so near to the smallest one may be equal to it after rounding.
_CLOSE = 4e-9


def shared_codebook(spark: SparkSession, codebook: np.ndarray):
    """Broadcast a codebook after checking its size."""
    codebook = np.ascontiguousarray(codebook, dtype="float64")
    if codebook.ndim != 2 or codebook.size == 0:
        raise ValueError("a codebook is a non-empty matrix")
    if codebook.size > MAX_CODEBOOK:
        raise ValueError(f"codebook of {codebook.size} numbers is larger than {MAX_CODEBOOK}")
    return spark.sparkContext.broadcast(codebook)


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch as a matrix; a vector that is null or has another length is an error."""
    if column.null_count or not np.all(column.value_lengths().to_numpy(zero_copy_only=False) == width):
        raise ValueError(f"vectors must have {width} numbers, and none may be null")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def nearest(points: np.ndarray, codebook: np.ndarray, norm: str) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest codebook row and the distance (squared for l2), rounded to 9 digits; ties go to the first."""
    if norm == "l2":
        return _nearest_l2(points, codebook)
    if norm != "l1":
        raise ValueError(f"unknown norm: {norm}")
    rows = max(1, _BLOCK // (len(codebook) * points.shape[1]))
    best = np.empty(len(points), dtype="int64")
    dist = np.empty(len(points), dtype="float64")
    for start in range(0, len(points), rows):
        block = points[start : start + rows]
        d = np.round(np.abs(block[:, None, :] - codebook[None, :, :]).sum(axis=2), 9)
        chosen = d.argmin(axis=1)
        best[start : start + rows] = chosen
        dist[start : start + rows] = d[np.arange(len(block)), chosen]
    return best, dist


def _nearest_l2(points: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same by squared distances: one matrix product and one sum in place; only near ties are rounded one by one."""
    rows = max(1, _BLOCK // len(codebook))
    best = np.empty(len(points), dtype="int64")
    least = np.empty(len(points), dtype="float64")
    own, lengths = (points**2).sum(axis=1), (codebook**2).sum(axis=1)
    turned = np.ascontiguousarray(-2.0 * codebook.T)
    room = np.empty((min(rows, len(points)), len(codebook)))
    # How near a tie is grows with the numbers, as their rounding does.
    close = _CLOSE + 1e-14 * (own + lengths.max())
    for start in range(0, len(points), rows):
        block = points[start : start + rows]
        # The squared length of the point is the same for all units, so it is added to the smallest sum only.
        d = np.matmul(block, turned, out=room[: len(block)])
        d += lengths
        chosen = d.argmin(axis=1)
        low = d[np.arange(len(block)), chosen]
        near = d <= (low + close[start : start + rows])[:, None]
        for i in np.flatnonzero(np.count_nonzero(near, axis=1) > 1):
            units = np.flatnonzero(near[i])
            rounded = np.round(np.maximum(d[i, units] + own[start + i], 0.0), 9)
            chosen[i] = units[rounded.argmin()]
            low[i] = d[i, chosen[i]]
        best[start : start + rows], least[start : start + rows] = chosen, low
    return best, np.round(np.maximum(least + own, 0.0), 9)


def assign(
    df: DataFrame, keys: Sequence[str], vector: str, codebook: np.ndarray, norm: str = "l2",
    unit: str = "unit", dist: str = "dist",
) -> DataFrame:
    """(keys…, unit, dist): the nearest codebook row of each vector; dist is squared for l2."""
    shared = shared_codebook(df.sparkSession, codebook)
    width = codebook.shape[1]
    source = df.select(*keys, as_doubles(vector).alias("_v"))
    out = T.StructType([source.schema[k] for k in keys])
    out = out.add(unit, T.IntegerType()).add(dist, T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            best, d = nearest(matrix_of(batch.column(len(keys)), width), table, norm)
            columns = [batch.column(i) for i in range(len(keys))]
            columns += [pa.array(best, pa.int32()), pa.array(d, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, unit, dist])

    return source.mapInArrow(run, out)


def unit_sums(df: DataFrame, vector: str, codebook: np.ndarray) -> DataFrame:
    """(unit, n, dist, s): rows, summed distance and vector sum of each codebook row that won any."""
    shared = shared_codebook(df.sparkSession, codebook)
    units, width = codebook.shape
    source = df.select(as_doubles(vector).alias("_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        count = np.zeros(units, dtype="int64")
        error = np.zeros(units)
        total = np.zeros((units, width))
        for batch in batches:
            points = matrix_of(batch.column(0), width)
            best, d = nearest(points, table, "l2")
            count += np.bincount(best, minlength=units)
            error += np.bincount(best, weights=np.sqrt(d), minlength=units)
            order = np.argsort(best, kind="stable")
            starts = np.flatnonzero(np.diff(best[order], prepend=-1))
            if len(order):
                total[best[order][starts]] += np.add.reduceat(points[order], starts, axis=0)
        won = np.flatnonzero(count)
        flat = pa.array(total[won].ravel(), pa.float64())
        offsets = pa.array(np.arange(0, len(won) * width + 1, width), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(won, pa.int32()),
                pa.array(count[won], pa.int64()),
                pa.array(error[won], pa.float64()),
                pa.ListArray.from_arrays(offsets, flat),
            ],
            ["unit", "n", "dist", "s"],
        )

    partial = source.mapInArrow(run, "unit int, n bigint, dist double, s array<double>")
    return partial.groupBy("unit").agg(
        F.sum("n").alias("n"), F.sum("dist").alias("dist"), sum_vectors(F.col("s"), width).alias("s")
    )
