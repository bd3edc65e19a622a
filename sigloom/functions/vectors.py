"""Vectors as array columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column | str) -> Column:
    """An array column as array<double>."""
    return (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")


def sum_vectors(vector: Column, size: int, weight: Column | None = None) -> Column:
    """Aggregate: element-wise sum, combined on the map side, no explode."""
    parts = [vector[i] if weight is None else vector[i] * weight for i in range(size)]
    return F.array(*[F.sum(p) for p in parts])


def literal_array(values: Sequence[float]) -> Column:
    """A numeric sequence as an array literal."""
    return F.lit(np.asarray(values, dtype="float64"))


def unit_x(unit: Column | str, height: int) -> Column:
    """Grid row of a unit number: unit div height."""
    return F.floor((F.col(unit) if isinstance(unit, str) else unit) / height).cast("int")


def unit_y(unit: Column | str, height: int) -> Column:
    """Grid column of a unit number: unit mod height."""
    return F.pmod(F.col(unit) if isinstance(unit, str) else unit, F.lit(height)).cast("int")
