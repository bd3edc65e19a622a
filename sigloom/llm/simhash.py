"""SimHash near-duplicates with a one-wildcard segment index.

A fingerprint has 64 bits.  Links differ in at most three, so of two segments of 32 bits one differs in at most one.
The index holds each segment as it is and once per bit with that bit as a wildcard.  Two fingerprints of an equal segment
share its plain entry; two whose segments differ in one bit share the entry of that bit, which counts only if both values
of the bit occur in it.  Rows that share an entry are verified on all 64 bits, and components of links are the groups.

Only distinct fingerprints are indexed, so copies cost nothing.  The fingerprints of a crowded entry (more than ``TILE``)
are indexed again by the other segment, whose bits are still free, cut in two halves in the same way, and so on.  An entry
with at most eight free bits is compared whole: it holds less than 2,048 fingerprints, because each wildcard only doubles
what the free bits allow.  A compared entry returns a spanning forest of its links, not all its pairs.

Null texts count as empty; a text without words has fingerprint zero, linked like any other; null ids keep their row
and are no candidates for the smallest id (a group of null ids alone has a null component); repeated rows are one
fingerprint and keep one result row each; an empty table gives an empty result; columns of any other names may be there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sigloom.llm.common import bounded_batches, small, text_of
from sigloom.llm.components import connected_components
from sigloom.scale import settle

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Fingerprints of one index entry that are compared in one go, and free bits up to which any entry is.
TILE = 4096
LAST_BITS = 8
# Fingerprints that one task of the index starts from.
_DEALT = 20_000
# Rows of two numbers, one for each document that stays, that may be broadcast.
KEPT_ROWS = 500_000
# Shingles whose bits are counted at a time.
_BLOCK = 1 << 16


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` words, repeats included; fewer words give one run, none give nothing."""
    # Of bytes, lower() changes A-Z alone and split() cuts at space and 0x09-0x0D.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - size + 1
    spans = zip(starts[:count].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], SEED) for a, b in spans), dtype=np.uint64, count=count)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The signed 64-bit SimHash: a bit is set if it is set in over half the hashes."""
    hashes = shingle_hashes(text or "", size)
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, size: int = SHINGLE) -> Column:
    @pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return simhash(text)


def entries(rows: DataFrame, size: int) -> DataFrame:
    """(entry, side, fp, free): the index entries of the ``size`` bits from bit ``free`` on of (key, fp, free) rows.

    Each half gives a plain entry (side null) and one for each of its bits as the wildcard, with the bit's value as the
    side; the other half stays free.
    """
    half = size // 2
    which = F.explode(F.sequence(F.lit(0), F.lit(2 * half + 1))).alias("which")
    rows = rows.select("key", "fp", "free", which)
    rows = rows.select("*", F.expr(f"free + {half} * (which div {half + 1})").alias("at"), F.expr(f"which % {half + 1} - 1").alias("bit"))
    mask = f"({(1 << half) - 1}L & ~if(bit < 0, 0L, shiftleft(1L, cast(bit as int))))"
    entry = F.expr(f"xxhash64(key, which, shiftrightunsigned(fp, cast(at as int)) & {mask})")
    side = F.expr("if(bit < 0, null, cast(shiftrightunsigned(fp, cast(at + bit as int)) & 1 as int))")
    other = F.expr(f"cast(2 * free + {half} - at as int)")
    return rows.select(entry.alias("entry"), side.alias("side"), "fp", other.alias("free"))


def _forest(marks: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among a tile's fingerprints: breadth first, one vector of distances per mark."""
    left, found = marks, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            mark = queue.pop()
            near = np.bitwise_count(left ^ mark) <= max_bits
            if near.any():
                found += [(int(mark), int(x)) for x in left[near]]
                queue += list(left[near])
                left = left[~near]
    return found


def _tile_links(max_bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            frame = batch.to_pandas()
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = (rest["entry"] == rest["entry"].iloc[-1]).to_numpy() if len(rest) else np.empty(0, bool)
            done, rest = rest[~last], rest[last]
            yield from _emit(done)
        if rest is not None:
            yield from _emit(rest)

    def _emit(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        if not len(frame):
            return
        keys = frame["entry"].to_numpy()
        marks = frame["fp"].to_numpy().astype(np.uint64, casting="unsafe")
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        ends = np.append(starts[1:], len(marks))
        two = starts[ends - starts == 2]
        two = two[np.bitwise_count(marks[two] ^ marks[two + 1]) <= max_bits]
        pairs = [np.stack([marks[two], marks[two + 1]], axis=1)]
        for a, b in zip(starts, ends, strict=True):
            if b - a > 2 and (found := _forest(marks[a:b], max_bits)):
                pairs.append(np.array(found, dtype=np.uint64))
        pairs = np.concatenate(pairs)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0).astype(np.int64, casting="unsafe")
        if len(pairs):
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return links


def links(marks: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints (fp), enough to join all that a chain of links joins."""
    if max_bits > 3:
        raise ValueError("two segments with one wildcard find at most three differing bits")
    rows = marks.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("free"))
    size, found = 64, []
    while True:
        index = entries(_dealt(rows), size)
        sides = index.groupBy("entry").agg(F.count(F.lit(1)).alias("n"), F.min("side").alias("low"), F.max("side").alias("high"))
        shared = settle(sides.filter("n > 1 and (low is null or low < high)").select("entry", "n"), "entries")
        size //= 2
        last = size <= LAST_BITS
        small_enough = shared if last else shared.filter(F.col("n") <= TILE)
        together = index.select("entry", "fp").join(small_enough.select("entry"), "entry")
        together = together.repartition("entry").sortWithinPartitions("entry")
        found.append(settle(together.mapInArrow(_tile_links(max_bits), "a long, b long").distinct(), "links"))
        crowded = shared.filter(F.col("n") > TILE)
        if last or crowded.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()
        rows = index.join(crowded.select("entry"), "entry").select(F.col("entry").alias("key"), "fp", "free")
        rows = settle(rows, "crowded")


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` (a settled table) over enough tasks for the entries that each row becomes."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // _DEALT)
    return rows.repartition(tasks, "key", "fp")


def _components(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, label) of every fingerprint of a settled table."""
    marks = settle(rows.select("fp").distinct(), "marks")
    joined = connected_components(links(marks, max_bits)).withColumnRenamed("node", "fp")
    return settle(marks.join(joined, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label")), "components")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fp, component): the group of every row; its name is the smallest id that a chain of links reaches."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), fingerprints(text_of(text_col), size).alias("fp"))
    rows = settle(rows, "fingerprints")
    groups = _components(rows, max_bits)
    least = rows.groupBy("fp").agg(F.min("_id").alias("_least")).join(groups, "fp")
    names = least.groupBy("label").agg(F.min("_least").alias("component"))
    named = settle(groups.join(names, "label").select("fp", "component"), "groups")
    return rows.join(small(named), "fp").select(F.col("_id").alias(id_col), "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id (nulls last); all columns stay.

    Rows are told apart by two hashes of all their columns; of rows equal in every column one stays.
    """
    bounded_batches(docs.sparkSession)
    mark = [F.xxhash64(*docs.columns).alias("_k1"), F.xxhash64(F.lit(1), *docs.columns).alias("_k2")]
    slim = settle(docs.select(*mark, F.col(id_col).alias("_id"), fingerprints(text_of(text_col)).alias("fp")), "rows")
    groups = small(_components(slim))
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_k1", "_k2")
    first = slim.join(groups, "fp").groupBy("label").agg(F.min(order).alias("_first"))
    first = first.select("_first._k1", "_first._k2").join(slim.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("n")), ["_k1", "_k2"])
    first = settle(first, "kept")
    rows = docs.select(F.struct("*").alias("_row"), *mark)
    single = first.filter("n = 1").select("_k1", "_k2")
    kept = rows.join(small(single, KEPT_ROWS), ["_k1", "_k2"], "left_semi")
    repeated = first.filter("n > 1")
    if repeated.limit(1).count():
        again = rows.join(small(repeated), ["_k1", "_k2"], "left_semi").groupBy("_k1", "_k2").agg(F.first("_row").alias("_row"))
        kept = kept.select("_row").unionByName(again.select("_row"))
    return kept.select("_row.*")
