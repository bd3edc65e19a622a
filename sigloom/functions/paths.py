"""Columns derived from file paths, URLs and row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_of_path(path: Column | str) -> Column:
    """Name of the parent folder."""
    return F.get(F.slice(F.split(path, "/"), -2, 1), F.lit(0))


def doc_key(path: Column | str) -> Column:
    """Short document key: the last two path segments."""
    return F.array_join(F.slice(F.split(path, "/"), -2, 2), "/")


def key_percent(key: Column | str) -> Column:
    """A number in 0..99 that depends only on the key, for splits that do not move with partitioning."""
    digest = F.md5((F.col(key) if isinstance(key, str) else key).cast("string"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(100)).cast("int")


def md5_levels(title: Column | str) -> tuple[Column, Column]:
    """Two folder levels of two hex digits each from the md5 of a title."""
    digest = F.md5(title)
    return F.substring(digest, 1, 2).alias("l1"), F.substring(digest, 3, 2).alias("l2")
