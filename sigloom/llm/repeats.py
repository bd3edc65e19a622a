"""Suffix-array dedup: removal of every byte that a repeated string of ``width`` bytes covers.

Suffixes are ordered only through their first ``width`` bytes, by radix passes whose digits are hashes; suffixes that
are equal after the last pass are exactly the repeated windows, and those alone in their bucket leave after any pass.

1. The first digit of a window is its anchor: the run of ``gram`` bytes in it with the smallest hash (the leftmost of
   equals).  Equal windows have equal anchors at equal places, and neighbouring windows share one, so one row stands for
   all windows of an anchor (about one row for 70 bytes).
2. The second digit is all bytes that the windows of an anchor cover.  Anchors equal in both digits are repeated with all
   their windows, and need no further pass; anchors whose first digit occurs once leave.
3. Only anchors that are repeated in other surroundings send these bytes, less than 400, to the bucket of the first
   digit.  The windows of a bucket differ in how many bytes they take from the left of the anchor, and the others from its
   right.  In a bucket of at most ``bucket`` surroundings each window is the last digit.
4. A larger bucket is dealt again: the windows that take more from the left by the bytes that all of them share (half of
   a window at first), those that take more from the right by theirs; then each half of the halves, and so on.  The bytes
   that a piece shares with its bucket stay behind as its digit, so pieces shrink as their number grows, and a piece
   that is alone in its bucket, or equal as a whole to another one, leaves.  At most about eight passes reach one window.

Equal texts send equal rows, which are counted in the tasks before they are shuffled.  The digits are 64 bits each: the first
two are compared together, the hash of a window (mixed with its bucket's digit and place) alone.

Null and empty texts have no bytes; texts shorter than ``width`` keep all of theirs; a repeated row makes each of the two
a repeat of the other; null ids keep their row; an empty table gives an empty result; columns of any names may be there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sigloom.llm.common import bounded_batches, small_bytes, text_of
from sigloom.scale import discard, settle

WIDTH = 200
GRAM = 32
# Surroundings of one digit that are compared in one task.
BUCKET = 512
# Bytes of a list of numbers, one or few for each crowded bucket, that may be broadcast.
BROADCAST_BYTES = 64 << 20
# Windows that are read together; longer texts are read in overlapping parts.
_PART = 1 << 20
_PLACE = 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ODD = np.uint64(0xD6E8FEB86659FD93)
_KEY = ["k1", "k2"]


def mixed(x: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """Hashes of any runs of bytes, from running sums of bytes times powers."""

    def __init__(self, data: np.ndarray):
        powers = np.full(len(data) + 1, _BASE)
        powers[0] = 1
        steps = np.cumprod(powers)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * steps[:-1], out=self.sums[1:])
        powers[1:] = _INVERSE
        self.back = np.cumprod(powers)

    def of(self, starts, ends) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


def anchors(data: np.ndarray, sizes: np.ndarray, width: int, gram: int):
    """(text, lo, hi, place, first digit, second digit) of all anchors of texts joined in ``data``.

    The windows that start at lo..hi have their anchor at place; positions count from the start of the text.
    """
    hashes, count, reach = Hashes(data), len(data) - width + 1, width - gram + 1
    places = np.arange(len(data) - gram + 1)
    digit = hashes.of(places, places + gram)
    # The smallest hash in every run of ``reach`` places, with its place in the low bits.
    order = (digit >> np.uint64(_PLACE) << np.uint64(_PLACE)) | places.astype(np.uint64)
    filled = np.concatenate((order, np.full(reach + -len(order) % reach, np.iinfo(np.uint64).max))).reshape(-1, reach)
    before = np.minimum.accumulate(filled, axis=1).ravel()
    after = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:count], before[reach - 1 : reach - 1 + count])
    chosen = (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.flatnonzero(text[:count] == text[width - 1 :])
    chosen = chosen[inside]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(chosen) != 0) | (np.diff(inside) != 1))))
    lo, place = inside[new], chosen[new]
    hi = inside[np.append(new[1:], len(inside)) - 1]
    second = mixed(hashes.of(lo, hi + width) + (place - lo).astype(np.uint64) * _ODD + (hi - lo).astype(np.uint64))
    own = text[lo]
    begin = np.concatenate(([0], np.cumsum(sizes)))[own]
    return own, lo - begin, hi - begin, place - begin, digit[place], second


def _parts(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, sizes, row, offset in the row) of groups of texts; long texts come in parts that share width - 1 bytes."""
    data = [np.frombuffer(b, dtype=np.uint8) for b in (x.as_buffer() for x in texts)]
    group, rows, offsets, room = [], [], [], _PART
    for row, own in enumerate(data):
        for at in range(0, max(len(own) - width + 1, 0), _PART):
            part = own[at : at + _PART + width - 1]
            if group and len(part) > room:
                yield np.concatenate(group), np.array([len(x) for x in group]), np.array(rows), np.array(offsets)
                group, rows, offsets, room = [], [], [], _PART
            group.append(part)
            rows.append(row)
            offsets.append(at)
            room -= len(part)
    if group:
        yield np.concatenate(group), np.array([len(x) for x in group]), np.array(rows), np.array(offsets)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int64, casting="unsafe") if x.dtype == np.uint64 else x)


def _anchor_rows(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in _KEY)
            for data, sizes, rows, offsets in _parts(batch.column("data"), width):
                own, lo, hi, place, a, c = anchors(data, sizes, width, gram)
                at = (lo + offsets[own]) << 16 | (hi - lo) << 8 | (place - lo)
                row = rows[own]
                columns = [_signed(a), _signed(c), pa.array(k1[row]), pa.array(k2[row]), pa.array(at)]
                yield pa.record_batch(columns, names=["a", "c", *_KEY, "at"])

    return run


# Mark of a wanted piece beside its place: no other has both of its digits.
_OPEN = 1 << 61
# A piece: its bucket, the text and the place of its first window, whether that is open (not known to be repeated), the least
# and most bytes left of the anchor in the windows of its bucket, those of its own first window, and its bytes without
# those that its bucket shares.
_PIECE = "key: bigint, k1: bigint, k2: bigint, at: bigint, open: boolean, low: int, high: int, far: int, bytes: binary"
_PIECES = f"array<struct<{_PIECE.replace('k1: bigint, k2: bigint, ', '')}>>"
_PIECE_KINDS = [
    ("key", pa.int64()), ("at", pa.int64()), ("open", pa.bool_()), ("low", pa.int32()), ("high", pa.int32()),
    ("far", pa.int32()), ("bytes", pa.binary()),
]


def _pieces(width: int, gram: int):
    def cut(data: pa.Array, wanted: pa.Array) -> pa.Array:
        """The surroundings that a text is asked for (two numbers each: the first digit and the place), without anchors."""
        out = []
        for text, own in zip(data, wanted, strict=True):
            whole, own = text.as_py(), own.as_py()
            found = []
            for a, at in zip(own[::2], own[1::2], strict=True):
                lo, far = (at & (_OPEN - 1)) >> 16, at & 255
                anchor, end = lo + far, lo + (at >> 8 & 255) + width
                found.append(
                    {
                        "key": a, "at": lo, "open": at & _OPEN != 0, "low": 0, "high": width - gram, "far": far,
                        "bytes": whole[lo:anchor] + whole[anchor + gram : end],
                    }
                )
            out.append(found)
        return pa.array(out, type=pa.list_(pa.struct(_PIECE_KINDS)))

    return cut


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece as one or two, of the windows that take more from the left of the anchor and of those that take less."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            low, high, far, data = row["low"], row["high"], row["far"], row["bytes"]
            border = far - low  # bytes left of the anchor
            last = far - (len(data) - (high - low))  # bytes left of it in the last window
            middle = (low + high) // 2
            for first_low, first_high in ((middle + 1, high), (low, middle)):
                most, least = min(far, first_high), max(last, first_low)
                if least > most:
                    continue
                left, right = border - (first_low - low), border + high - first_high
                shared = f"{row['key']},{first_low},{first_high},".encode() + data[left:right]
                out.append(
                    row | {
                        "key": xxhash.xxh64_intdigest(shared) - (1 << 63), "at": row["at"] + far - most, "low": first_low,
                        "high": first_high, "far": most,
                        "bytes": data[border - (most - low) : left] + data[right : border + high - least],
                    }
                )
        yield pa.RecordBatch.from_pylist(out, schema=batch.schema)


def _resolve(width: int):
    """Spans of repeated windows in buckets that arrive sorted by their digit."""
    names = [*_KEY, "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            keys = table["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            # Whole buckets, some thousand rows at a time.
            at = 0
            while at < cut:
                to = cut if cut - at <= 4096 else int(np.searchsorted(keys, keys[at + 4096]))
                to = to if to > at else int(np.searchsorted(keys, keys[at], side="right"))
                yield from spans(table.slice(at, to - at))
                at = to
            rest = table.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from spans(rest)

    def spans(table: pa.Table) -> Iterator[pa.RecordBatch]:
        own = {c: table[c].to_numpy() for c in ("key", *_KEY, "at", "open", "low", "high", "far")}
        data = table["bytes"].to_pylist()
        sizes = np.array([len(x) for x in data], dtype=np.int64)
        hashes = Hashes(np.frombuffer(b"".join(data), dtype=np.uint8))
        span = (own["high"] - own["low"]).astype(np.int64)
        counts = sizes - span + 1
        row = np.repeat(np.arange(len(sizes)), counts)
        number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = (np.cumsum(sizes) - sizes)[row] + number
        left = (own["far"][row] - number).astype(np.uint64)
        bucket = mixed(own["key"].astype(np.uint64, casting="unsafe")[row] + left * _ODD)
        _, back, times = np.unique(mixed(hashes.of(start, start + span[row]) + bucket), return_inverse=True, return_counts=True)
        wanted = np.flatnonzero((times[back] > 1) & own["open"][row])
        if not len(wanted):
            return
        row, number = row[wanted], number[wanted]
        first = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(number) != 1))))
        last = np.append(first[1:], len(row)) - 1
        lo = own["at"][row[first]]
        columns = [own["k1"][row[first]], own["k2"][row[first]], lo + number[first], lo + number[last] + width]
        yield pa.record_batch([pa.array(x) for x in columns], names=names)

    return run


def _bucket_spans(pieces: DataFrame, width: int, bucket: int) -> DataFrame:
    """(k1, k2, start, end): repeated windows of pieces (a settled table), each bucket by itself."""
    spans = "k1 long, k2 long, start long, end long"
    windows = "length(bytes) - high + low"
    found = []
    while True:
        sizes = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.bool_or("open").alias("any"))
        sizes = settle(sizes.filter("kinds > 1 and any").select("key", "kinds"), "buckets")
        few = pieces.join(sizes.filter(F.col("kinds") <= bucket).select("key"), "key", "left_semi")
        found.append(few.repartition("key").sortWithinPartitions("key").mapInArrow(_resolve(width), spans))
        crowded = sizes.filter(F.col("kinds") > bucket).select("key")
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, found)
        # A bucket above the bound has that many pieces at least, so the list is short beside them.
        crowded = pieces.join(small_bytes(crowded, "8", BROADCAST_BYTES), "key", "left_semi")
        parts = settle(crowded.mapInArrow(_halves, pieces.schema), "halves")
        # Pieces that are equal as a whole are repeated in all their windows, and one of them stands for all.
        whole = [F.col("key"), F.col("far"), F.xxhash64("bytes").alias("whole")]
        parts = parts.withColumn("whole", whole[2])
        rest = [c for c in pieces.columns if c not in ("key", "far")]
        alike = parts.groupBy("key", "far", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(rest)).alias("one"))
        alike = settle(alike, "alike")
        again = alike.filter("n > 1").select("key", "far", "whole")
        again = parts.filter("open").join(small_bytes(again, "24", BROADCAST_BYTES), ["key", "far", "whole"], "left_semi")
        end = F.expr(f"at + {windows} + {width}").alias("end")
        found.append(again.select(*_KEY, F.col("at").alias("start"), end))
        pieces = alike.select("key", "far", "n", "one.*").withColumn("open", F.expr("open and n = 1")).select(pieces.columns)


def repeated_spans(texts: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(k1, k2, start, end): bytes of texts (k1, k2, data: binary) that repeated windows cover; spans may overlap."""
    if not 8 <= gram < width or width - gram > 255:
        raise ValueError("gram must be at least 8 and less than width, by at most 255")
    bounded_batches(texts.sparkSession)
    # Passes 1 and 2: both digits of every anchor; equal texts send equal rows.
    rows = texts.mapInArrow(_anchor_rows(width, gram), "a long, c long, k1 long, k2 long, at long")
    places = settle(rows.groupBy("a", "c", *_KEY, "at").agg(F.count(F.lit(1)).alias("n")), "places")
    both = places.groupBy("a", "c").agg(F.sum("n").alias("n"), F.min(F.struct(*_KEY, "at")).alias("one"))
    both = settle(both, "digits")
    settled = places.drop("n").join(both.filter("n > 1").select("a", "c"), ["a", "c"], "left_semi")
    done = settled.select(*_KEY, F.expr("at >> 16").alias("start"), F.expr(f"(at >> 16) + ((at >> 8) & 255) + {width}").alias("end"))
    done = settle(done, "done")
    # Pass 3: surroundings that occur once, beside others of the same first digit.
    buckets = both.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    buckets = buckets.filter("kinds > 1 and least = 1").select("a")
    marks = F.expr(f"one.at + if(n = 1, {_OPEN}L, 0L)")
    wanted = both.join(buckets, "a").select("one.k1", "one.k2", F.array("a", marks).alias("piece"))
    lists = settle(wanted.groupBy(*_KEY).agg(F.flatten(F.collect_list("piece")).alias("wanted")), "wanted")
    # From here on only the pieces and their texts are needed.
    discard(places, both)
    # Both lists grow with the texts, so they meet them by a sorted join at every size (Spark splits a hot text's rows).
    cut = texts.join(lists.hint("merge"), _KEY).select(*_KEY, F.explode(arrow_udf(_pieces(width, gram), _PIECES)("data", "wanted")).alias("x"))
    # Equal texts cut equal pieces.
    own = ["key", *_KEY, "at"]
    cut = cut.select(*_KEY, "x.*").dropDuplicates(own).select("key", *_KEY, "at", "open", "low", "high", "far", "bytes")
    return done.unionByName(_bucket_spans(settle(cut, "surroundings"), width, bucket))


def _without(data: pa.Array, spans: pa.Array) -> pa.Array:
    removed, runs, kept = [], [], []
    for text, own in zip(data, spans, strict=True):
        whole, own = text.as_py(), sorted((s["start"], s["end"]) for s in own.as_py() or ())
        parts, at, count, gone = [], 0, 0, 0
        for start, end in own:
            if start > at or not count:
                parts.append(whole[at:start])
                gone, count, at = gone + end - start, count + 1, end
            elif end > at:
                gone, at = gone + end - at, end
        parts.append(whole[at:])
        removed.append(gone)
        runs.append(count)
        kept.append(b"".join(parts))
    return pa.StructArray.from_arrays(
        [pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], names=["n_removed", "n_spans", "kept"]
    )


def keyed(text: Column) -> list[Column]:
    """Two numbers that stand for a text, and its bytes."""
    data = text.cast("binary")
    second = F.shiftleft(F.crc32(data), 31).bitwiseXOR(F.octet_length(text).cast("long"))
    return [F.xxhash64(text).alias("k1"), second.alias("k2"), data.alias("data")]


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): every text without its repeated bytes (which may cut characters)."""
    rows = docs.select(F.col(id_col).alias("_id"), *keyed(text_of(text_col)))
    spans = repeated_spans(rows.select(*_KEY, "data"), width, gram, bucket)
    spans = spans.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.join(settle(spans, "spans").hint("merge"), _KEY, "left")
    without = arrow_udf(_without, "struct<n_removed: bigint, n_spans: bigint, kept: binary>")("data", "spans")
    out = joined.select("_id", F.octet_length("data").cast("long").alias("n_bytes"), without.alias("_w"))
    return out.select(F.col("_id").alias(id_col), "n_bytes", "_w.n_removed", "_w.n_spans", "_w.kept")
