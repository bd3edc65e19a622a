"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of rows that are sent to a Python worker at a time: texts are long, and a worker holds them in several forms.
BATCH_BYTES = 4 << 20
# Largest side table that is broadcast: rows of a few numbers each, counted before every broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column without nulls."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(text: Column) -> list[Column]:
    """Two independent hashes and the byte length that together stand for a whole text."""
    return [
        F.xxhash64(text).alias("_h1"),
        F.crc32(text.cast("binary")).alias("_h2"),
        F.octet_length(text).alias("_len"),
    ]


KEY = ["_h1", "_h2", "_len"]


def small(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side`` (a settled table) with a broadcast hint if it is counted to be small; else left to the planner."""
    return F.broadcast(side) if side.count() <= rows else side


def small_bytes(side: DataFrame, row_bytes: str, most: int) -> DataFrame:
    """``side`` (a settled table) with a broadcast hint if its rows, each of ``row_bytes`` (SQL), add up to at most ``most``."""
    total = side.agg(F.sum(F.expr(row_bytes))).first()[0] or 0
    return F.broadcast(side) if total <= most else side


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python workers in batches of at most ``BATCH_BYTES`` (or less, if so set)."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(setting).removesuffix("b")
    if not own.isdigit() or int(own) > BATCH_BYTES:
        spark.conf.set(setting, BATCH_BYTES)
