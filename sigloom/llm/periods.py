"""Detection of periodic runs of words, by seeds on diagonals.

A run of period q and at least ``repeats`` * q words matches itself, q words on, over (repeats - 1) * q words or more.  So
for all lags of one octave (q <= lag < 2q) every run holds a seed: a k-gram of that guaranteed overlap which comes back
after ``lag`` words.

1. Index.  The k-grams of an octave are hashed and sorted, and the occurrences of one k-gram in one document stand side by
   side.  Only places whose shorter k-gram came back go on to the next octave.
2. Occurrence pairs.  Each occurrence is paired with the next one of the same document, so there are at most as many pairs
   as words: k exceeds the lag, and a k-gram inside a run that came back sooner would give the run a smaller period.
3. Diagonals.  Along a lag, the furthest word that is covered so far suppresses seeds that lie on a stretch already found;
   the others begin a new stretch.  Stretches that are long enough are extended to both sides and compared word by word.

Words are runs of characters other than ASCII white space, compared exactly.  Null and empty texts have no words and no
runs; long texts are searched whole; repeated rows and null ids give one result row each; an empty table gives an empty
result; only the two named columns are read, so others may have any names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sigloom.llm.common import bounded_batches, text_of

# A run has at least this many periods and this many words.
REPEATS = 4
LEAST = 6
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
# Bytes of text that are searched together.
_CHUNK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in _FACTORS:
        x = (x ^ (x >> np.uint64(33))) * factor
    return x ^ (x >> np.uint64(33))


def _doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Hashes of grams of twice ``size`` from those of ``size``."""
    return _mixed(names[:-size] * _BASE + names[size:]) if len(names) > size else names[:0]


def octaves(most: int, repeats: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag, k) of every octave of lags up to ``most``; k is the least overlap of their runs."""
    first = 1
    while first <= most:
        yield first, 2 * first - 1, min(max(least - q, (repeats - 1) * q) for q in range(first, min(2 * first, first + least)))
        first *= 2


def _next_places(codes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, next place with the same code) of the places (in rising order) whose code comes back."""
    order = np.argsort(codes, kind="stable")
    same = np.flatnonzero(codes[order[1:]] == codes[order[:-1]])
    here, there = places[order[same]], places[order[same + 1]]
    return here, there


def word_runs(words: np.ndarray, sizes: np.ndarray, repeats: int = REPEATS, least: int = LEAST):
    """(text, start, length, period) arrays of all runs of some texts, whose word numbers are joined in ``words``.

    A text's runs come by start, then period.
    """
    text = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(sizes) - sizes
    end = begin + sizes
    # Equal words of two texts have different codes, so no k-gram is shared by two texts.
    codes = _mixed(words.astype(np.uint64) * _BASE + text.astype(np.uint64) * _FACTORS[0] + np.uint64(1))
    powers = [codes]
    alive = np.arange(len(words))
    found: list[tuple[int, int, int]] = []
    for first, last, k in octaves(int(sizes.max(initial=0)) // repeats, repeats, least):
        while 2 << (len(powers) - 1) <= k:
            powers.append(_doubled(powers[-1], 1 << (len(powers) - 1)))
        half = k.bit_length() - 1
        # A k-gram is named by its two halves, which overlap unless k is a power of two.
        alive = alive[alive + k <= len(words)]
        alive = alive[alive + k <= end[text[alive]]]
        grams = _mixed(powers[half][alive] * _FACTORS[1] + powers[half][alive + k - (1 << half)])
        here, there = _next_places(grams, alive)
        back = np.zeros(len(words), dtype=bool)
        back[here] = back[there] = True
        alive = alive[back[alive]]
        lag = there - here
        seeds = (lag >= first) & (lag <= last)
        here, lag = here[seeds], lag[seeds]
        order = np.lexsort((here, lag))
        here, lag = here[order], lag[order]
        # A seed up to the furthest covered word of its lag lies on a known stretch.
        new = np.ones(len(here), dtype=bool)
        new[1:] = (lag[1:] != lag[:-1]) | (here[1:] > here[:-1] + k) | (text[here[1:]] != text[here[:-1]])
        at = np.flatnonzero(new)
        start, lag, reach = here[at], lag[at], here[np.append(at[1:], len(here))[: len(at)] - 1] + k
        long = reach - start >= np.maximum(least - lag, (repeats - 1) * lag)
        found += zip(start[long].tolist(), reach[long].tolist(), lag[long].tolist(), strict=True)
    runs = []
    for s, t, q in found:
        own = text[s]
        while s > begin[own] and words[s - 1] == words[s - 1 + q]:
            s -= 1
        while t + q < end[own] and words[t] == words[t + q]:
            t += 1
        if np.array_equal(words[s:t], words[s + q : t + q]):
            runs.append((own, s - begin[own], t + q - s, q))
    return np.array(sorted(set(runs), key=lambda r: (r[0], r[1], r[3])), dtype=np.int64).reshape(-1, 4).T


def _collapsed(words: list[bytes], runs: list[dict]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    kept, at = [], 0
    for start, end in sorted((r["start"] + r["period"], r["start"] + r["length"]) for r in runs):
        kept += words[at : max(start, at)]
        at = max(at, end)
    return b" ".join(kept + words[at:])


def _search(texts: list[bytes], repeats: int, least: int) -> Iterator[tuple[int, list[dict], bytes]]:
    cut = [t.split() for t in texts]
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = np.array([len(c) for c in cut], dtype=np.int64)
    words = np.fromiter((numbers[w] for c in cut for w in c), dtype=np.int64, count=int(sizes.sum()))
    found: list[list[dict]] = [[] for _ in texts]
    for own, start, length, period in zip(*(x.tolist() for x in word_runs(words, sizes, repeats, least)), strict=True):
        found[own].append({"start": start, "length": length, "period": period})
    for own, runs in zip(cut, found, strict=True):
        yield len(own), runs, _collapsed(own, runs)


def periodic(text: Column, repeats: int = REPEATS, least: int = LEAST) -> Column:
    """struct<n_words, runs, collapsed> of a text; ``runs`` by start, then period."""

    @arrow_udf(f"struct<n_words: bigint, runs: {RUNS}, collapsed: string>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for column in batches:
            out, group, room = [], [], _CHUNK
            for value in column:
                own = b"" if value.as_py() is None else value.as_buffer().to_pybytes()
                if group and len(own) > room:
                    out += _search(group, repeats, least)
                    group, room = [], _CHUNK
                group.append(own)
                room -= len(own)
            out += _search(group, repeats, least)
            counts, runs, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(runs, kinds), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["n_words", "runs", "collapsed"],
            )

    return search(text)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """(id, n_words, runs, collapsed): the periodic runs of every text, and the text without what they repeat."""
    if repeats < 3:
        raise ValueError("repeats must be at least 3: a seed must be longer than its lag")
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), periodic(text_of(text_col), repeats, least).alias("_p"))
    return rows.select(F.col("_id").alias(id_col), "_p.n_words", "_p.runs", "_p.collapsed")
