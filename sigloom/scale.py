"""Helpers that keep plans safe when data, groups and side tables grow.

* ``settle``       writes an intermediate table to the shared folder and reads it back.
* ``settings``     holds settings of the session for a while.
* ``sized_join``   broadcasts a side only after counting it, else joins with hot keys spread.
* ``spread_join``  joins on a key whose heaviest values are split over several lanes.
* ``top_n`` / ``top_per_group``  exact top-k that cuts rows before they meet in one task.
* ``bounded_rows`` collects a model-sized table, refusing anything larger.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

# Largest side table (rows of a word and a few numbers, below 100 MB) that is broadcast; counted before every broadcast.
BROADCAST_ROWS = 1_000_000
# Largest table, in bytes of its numbers, that is broadcast when its rows are wide.
BROADCAST_BYTES = 256 << 20
# A join key is hot when it holds at least this share of the rows, so at most 1/HOT_SHARE keys are hot.
HOT_SHARE = 1e-4
# Largest k handed straight to one ordered limit or one ranked window.
DIRECT_K = 1_000
# Lanes used to cut a large top-k before the final ranking, where no digits are given.
CUT_LANES = 64
# A selection ends when the rows beside the k-th are at most this many times k.
SPARE = 0.5
# Lanes for rows whose join key is null.
NULL_LANES = 10_000
# Shuffle files go when the execution that wrote them has ended, not when the driver happens to collect its garbage.
NO_SHUFFLES_LEFT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# For tables whose rows hold many numbers: how many rows are written before a page or a row group is measured, bytes that
# are sent to Python at once, and rows that are decoded at once.
LONG_ROWS = {
    "parquet.page.size.row.check.min": "8", "parquet.block.size.row.check.min": "8", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
SMALL_BATCHES = LONG_ROWS | {"spark.sql.parquet.columnarReaderBatchSize": "16"}
# Where the settled tables lie that a caller still holds.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
# Folders of local sessions that name none.
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="sigloom-")
        atexit.register(shutil.rmtree, _local_dirs[application], ignore_errors=True)
    return _local_dirs[application]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the application's folder in the shared folder; that folder may go when the application ends."""
    return os.path.join(shared_dir(spark), "sigloom", spark.sparkContext.applicationId, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what is run inside; afterwards they are as before."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a scan of it.

    This cuts lineage, survives the loss of executors and gives Catalyst the
    real size of the table for its join choice.  The shuffle files of the write
    go with its end.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with settings(spark, NO_SHUFFLES_LEFT):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes what ``settle`` wrote for these tables; whatever was read from them must have been settled itself by then."""
    for table in tables:
        remove(table.sparkSession, _paths.pop(table))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``fresh_path`` named."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def handed(df: DataFrame, table: DataFrame) -> DataFrame:
    """``df``, which reads the settled ``table`` and nothing else: it is discarded in its place."""
    _paths[df] = _paths.pop(table)
    return df


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over all cores by a hash of its keys, if it is a scan with fewer splits than that; a larger scan stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def partition_keys(spark: SparkSession, n: int) -> Column:
    """An array of ``n`` whole numbers: ``repartition(n, number)`` gives each of them a partition of its own.

    The numbers 0 to n - 1 themselves meet in some partitions and leave others empty.
    """
    held: dict[int, int] = {}
    size = 16 * n
    while len(held) < n:
        place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("place")
        rows = spark.range(size).select("id", place).groupBy("place").agg(F.min("id").alias("id")).collect()
        held, size = {r["place"]: r["id"] for r in rows}, 4 * size
    return F.array(*[F.lit(held[i]).cast("int") for i in range(n)])


def bounded_rows(df: DataFrame, max_rows: int, what: str) -> list[Row]:
    """Collect a table that must be model-sized; raise when it is not."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows")
    return rows


def within(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A plain count adds up in the tasks; a limit would send its rows through one.
    """
    return df.count() <= max_rows


def rows_within(numbers: int) -> int:
    """Rows of a word and so many numbers that fit BROADCAST_BYTES, at most BROADCAST_ROWS."""
    return min(BROADCAST_ROWS, BROADCAST_BYTES // (8 * numbers + 100))


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    weight: str | None = None,
) -> DataFrame:
    """Join ``big`` with ``small`` (unique on ``on``) without piling a hot key on one task.

    ``weight`` names the column of ``small`` that holds how many rows of
    ``big`` carry the key (pass a settled table then, it is read several
    times); without it the keys of ``big`` are counted.  A key
    holding a share s >= HOT_SHARE of the rows gets ceil(s / HOT_SHARE)
    lanes: its rows in ``big`` are dealt over the lanes by a hash of
    ``spread_by`` and its row in ``small`` is repeated once per lane.  At most
    1/HOT_SHARE keys can be hot, which bounds the broadcast list of lanes.
    """
    on = list(on)
    if weight is None:
        counted = settle(big.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), "keycounts")
    else:
        counted = small.select(*on, F.col(weight).alias("_rows"))
    total = counted.agg(F.sum("_rows").alias("total")).first()["total"] or 0
    unit = max(float(total) * HOT_SHARE, 1.0)
    hot = counted.filter(F.col("_rows") > F.lit(unit)).select(
        *on, F.ceil(F.col("_rows") / F.lit(unit)).cast("int").alias("_lanes")
    )
    hot = F.broadcast(hot)

    def dealt_at(lanes: Column) -> Column:
        return F.pmod(F.xxhash64(*spread_by), lanes.cast("bigint")).cast("int")

    dealt = big.join(hot, on, "left").withColumn(
        "_lane",
        # Rows without a key match nothing in any lane, so they are dealt over many.
        F.when(reduce(or_, [F.col(c).isNull() for c in on]), dealt_at(F.lit(NULL_LANES)))
        .when(F.col("_lanes").isNull(), F.lit(0))
        .otherwise(dealt_at(F.col("_lanes"))),
    )
    repeated = small.join(hot, on, "left").withColumn(
        "_lane", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_lanes"), F.lit(1)) - 1))
    )
    return dealt.drop("_lanes").join(repeated.drop("_lanes"), [*on, "_lane"], how).drop("_lane")


def sized_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    weight: str | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Broadcast ``small`` when it is counted to be small, else use ``spread_join``."""
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    if within(small.select(*on), limit):
        return big.join(F.broadcast(small), list(on), how)
    return spread_join(big, small, on, spread_by, how, weight)


def score_digits(score: str) -> list[Column]:
    """Digits of a falling order by a score of at least 0: whole numbers, thousandths, millionths, the score itself."""
    value = F.col(score).cast("double")
    return [-F.floor(F.log2(value + 1)), -F.floor(value * 16), -F.floor(value * 4096), -value]


def name_digits(name: str) -> list[Column]:
    """Digits of a rising order by a text: ever longer beginnings."""
    return [F.substring(name, 1, n) for n in (1, 2, 3, 5, 8)]


def select_first(df: DataFrame, group: Sequence[str], digits: Sequence[Column], k: int) -> DataFrame:
    """A table that holds the first ``k`` rows of every group, and few others, in the order that the digits refine.

    Each pass counts the rows of every value of one digit, adds the counts up within the group, and finds the value that
    the k-th row has; rows before it are in, rows behind it are out, and only those beside it meet the next digit.  No
    rows are sorted but counts.  A digit that is given the earlier ones' order must only refine it.
    """
    rows = settle(df, "scored")
    names = [f"_d{i}" for i in range(len(digits))]
    # One key, in which nulls are equal to each other.
    own = F.struct(*group) if group else F.lit(0)
    keyed = rows.select("*", own.alias("_g"), *[d.alias(n) for d, n in zip(digits, names, strict=True)])
    cells = None
    for i, name in enumerate(names):
        # Of every group: the digits of the k-th row so far, and how many rows of that cell are wanted.
        beside = keyed if cells is None else _beside(keyed, cells, ["_g", *names[:i]])
        need = F.lit(k).cast("long") if cells is None else F.col("_need")
        counts = beside.groupBy("_g", *names[: i + 1], need.alias("_need")).agg(F.count(F.lit(1)).alias("_n"))
        so_far = Window.partitionBy("_g").orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
        reached = counts.withColumn("_sum", F.sum("_n").over(so_far))
        # The cell of the k-th row, or the last one of a group that has fewer.
        last = F.row_number().over(Window.partitionBy("_g").orderBy(F.desc(name))) == 1
        kth = (F.col("_sum") >= F.col("_need")) & (F.col("_sum") - F.col("_n") < F.col("_need"))
        met = reached.withColumn("_last", last).filter(kth | (F.col("_last") & (F.col("_sum") < F.col("_need"))))
        rest = (F.col("_need") - F.col("_sum") + F.col("_n")).alias("_need")
        cells = settle(met.select("_g", *names[: i + 1], rest, (F.col("_sum") - F.col("_need")).alias("_spare")), "cells")
        if (cells.agg(F.max("_spare")).first()[0] or 0) <= SPARE * k:
            break
    found = names[: i + 1]
    joined = _beside(keyed, cells.select("_g", *[F.col(n).alias(f"{n}_") for n in found]), ["_g"])
    inside = F.lit(True)
    for name in reversed(found):
        bound = F.col(f"{name}_")
        inside = (F.col(name) < bound) | ((F.col(name) == bound) & inside)
    return joined.filter(inside).select(*rows.columns)


def _beside(keyed: DataFrame, cells: DataFrame, on: list[str]) -> DataFrame:
    """Rows that meet a cell; there is one cell a group, so they are broadcast unless the groups are very many."""
    return keyed.join(F.broadcast(cells) if within(cells, BROADCAST_ROWS) else cells, on)


def top_n(
    df: DataFrame, order: Sequence[Column], n: int, spread_by: Sequence[str], digits: Sequence[Column] = ()
) -> DataFrame:
    """The first ``n`` rows in a total order.

    A large ``n`` is selected by ``digits`` first, or without them cut inside
    CUT_LANES lanes, so the last task sees few more rows than it returns.
    """
    if n > DIRECT_K:
        df = select_first(df, [], digits, n) if digits else _cut(df, [], order, n, spread_by)
    return df.orderBy(*order).limit(n)


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    spread_by: Sequence[str],
    rank: str = "rank",
    digits: Sequence[Column] = (),
) -> DataFrame:
    """The first ``k`` rows of every group with their rank.

    For small ``k`` Spark itself keeps only k rows per group and task before the
    shuffle; a larger ``k`` is selected by ``digits`` first (see ``select_first``), or without them cut inside lanes of the group.
    """
    if k > DIRECT_K:
        df = select_first(df, group, digits, k) if digits else _cut(df, group, order, k, spread_by)
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def _cut(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, spread_by: Sequence[str]
) -> DataFrame:
    lane = F.pmod(F.xxhash64(*spread_by), F.lit(CUT_LANES)).alias("_lane")
    window = Window.partitionBy(*group, "_lane").orderBy(*order)
    return (
        df.select("*", lane)
        .withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") <= k)
        .drop("_lane", "_place")
    )
