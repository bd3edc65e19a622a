"""Benchmark decontamination by template windows.

A text becomes a template: its words lose case and punctuation; numbers, names (capitalised words inside a
sentence) and units become typed placeholders.  Windows of ``size`` template words (whole items if they are shorter, but
no shorter than ``least_words``; half of items of 12 to 15 words, so that one changed word leaves a window) are hashed
and joined with the windows of the benchmark.  The values behind the placeholders of joined windows must agree: along one
alignment of a text with an item, one value of the item may stand for one value of the text only, so a question with
other numbers is found and an unrelated text of the same shape is not.

Which words are names depends on capitals and on the marks before them, so every text is read in three ways: plain (no
names), by sentence (a capital makes a name, but not where a sentence begins) and by capital (every capital makes a
name).  Windows join with windows of the same reading, and an alignment has one reading.  A copy in other case or with
other marks agrees in the plain reading, whatever its other readings are.

A text leaks an item when a consistent alignment covers a run of ``run`` of the item's words (the whole item if it is
shorter), as a passage copied word for word does, or when consistent alignments together cover at least ``share`` of its
words, as a copy with changed words does.  Windows that are mostly placeholders count for a run only if all values are
equal, else any two lists of numbers would match.  Windows of fewer than ``PLAIN_WORDS`` plain words are hashed with their
values, so a list of numbers joins the same numbers only and not every other list: changed values are found as long as
three words of a window are words.

A bitmap of fixed size, made from the benchmark windows, drops windows of documents that cannot join before they leave
the task; it has no false negatives.  Equal texts are decided once.

Null and empty texts leak nothing; items of fewer than ``least_words`` words cannot be told from chance and match
nothing; null ids and repeated rows give one result row each; an empty benchmark or document table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sigloom.llm.common import KEY, bounded_batches, small, text_key, text_of
from sigloom.scale import settle

SIZE = 8
LEAST_WORDS = 5
# Words of an item in one run, and share of its words in any windows, that make a leak.
RUN = 13
SHARE = 0.5
# Windows with fewer words that are no placeholders join by their values.
PLAIN_WORDS = 3
# Items of at least twice as many words have no windows shorter than this.
LEAST_HALF = 6
# Bits of the bitmap; it is fixed, so the bitmap is 4 MB for any benchmark.
BITMAP_BITS = 25
# Bytes of text that are read together.
_CHUNK = 1 << 18
# Written units of measure.
UNITS = (
    "mm cm m km kg g mg lb lbs oz ml l mph hz khz mhz ghz kb mb gb tb s sec secs min mins h hr hrs second seconds minute"
    " minutes hour hours day days week weeks month months year years metre metres meter meters kilometre kilometres kilometer"
    " kilometers mile miles foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces litre"
    " litres liter liters gallon gallons dollar dollars cent cents euro euros percent degree degrees usd eur gbp"
).split()
NUM, NAME, UNIT = 1, 2, 3
# The readings, as bits of a mask.
SENTENCE, PLAIN, CAPITAL = 1, 2, 4
WINDOWS = "array<struct<hash:bigint,at:int,words:int,slots:array<string>,readings:int>>"
_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_SMALL = (_BYTES >= 97) & (_BYTES <= 122)
_WORD = _DIGIT | _UPPER | _SMALL | (_BYTES >= 128)
_MARK = np.isin(_BYTES, list(b".!?:\0"))
_JOINS = np.isin(_BYTES, list(b".,:/"))
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


_known_powers = [np.ones(1, dtype=np.uint64)] * 2


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those of one chunk are kept."""
    if len(_known_powers[0]) >= size:
        return _known_powers[0][:size], _known_powers[1][:size]
    found = []
    for base in (_BASE, _INVERSE):
        powers = np.full(max(size, _CHUNK), base)
        powers[0] = 1
        found.append(np.cumprod(powers, out=powers))
    if size <= 2 * _CHUNK:
        _known_powers[:] = found
    return found[0][:size], found[1][:size]


class Words:
    """The template words of some texts.

    A word is a run of letters and digits; the case of ASCII and Latin-1 letters does not count.  Numbers with points or
    commas inside are one word.  ``codes`` are hashes (of the placeholder where there is one), ``kinds`` its type or 0, both
    by sentence; ``readings`` has them for every reading.
    """

    def __init__(self, texts: list[str]):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.raw = b"\0".join(parts) + b"\0\0\0"
        self.offsets = np.cumsum([0] + [len(x) + 1 for x in parts])
        a = np.frombuffer(self.raw, dtype=np.uint8)
        word, low = _WORD[a], _LOWER[a]
        two = np.flatnonzero(a == 0xC2)  # signs up to U+00BF
        three = np.flatnonzero(a == 0xE2)
        three = three[a[three + 1] == 0x80]  # general punctuation
        for gaps in (two, two + 1, three, three + 1, three + 2):
            word[gaps] = False
        accented = np.flatnonzero(a == 0xC3)
        large = (a[accented + 1] >= 0x80) & (a[accented + 1] <= 0x9E) & (a[accented + 1] != 0x97)
        latin = accented[large]
        low[latin + 1] += 0x20
        edges = np.flatnonzero(np.diff(word, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        hashes = self._hashes(low, starts, ends)
        digit = _DIGIT[a[starts]]
        # A number goes on behind a single point, comma, colon or slash.
        more = np.zeros(len(starts), dtype=bool)
        more[1:] = digit[1:] & digit[:-1] & (starts[1:] - ends[:-1] == 1) & _JOINS[a[ends[:-1]]]
        first = np.flatnonzero(~more)
        last = np.append(first[1:], len(starts))[: len(first)] - 1
        # The value of a number of several parts is that of all of them.
        hashes = np.where(first == last, hashes[first], self._hashes(low, starts[first], ends[last]))
        self.starts, self.ends, digit, self.values = starts[first], ends[last], digit[first], hashes
        self.low = low.tobytes()
        self.doc = np.searchsorted(self.offsets, self.starts, side="right") - 1
        marks = np.concatenate(([0], np.cumsum(_MARK[a], dtype=np.int32)))
        opens = np.ones(len(first), dtype=bool)
        opens[1:] = marks[self.starts[1:]] > marks[self.ends[:-1]]
        upper, lower = _UPPER[a], _SMALL[a]
        upper[latin] = True
        lower[accented[~large]] = True
        # One capital before a small letter; words all in capitals are ordinary words.
        second = self.starts + np.where(a[self.starts] == 0xC3, 2, 1)
        self.capital = capital = upper[self.starts] & lower[second]
        # A capital makes a name, but not at the start of a text or of a sentence.
        unit = np.where(np.isin(hashes, _UNIT_CODES), UNIT, 0)
        self.readings = []
        for reading, names in ((SENTENCE, capital & ~opens), (PLAIN, np.zeros_like(capital)), (CAPITAL, capital)):
            kinds = np.where(digit, NUM, np.where(names, NAME, unit))
            self.readings.append((reading, np.where(kinds > 0, _PLACES[kinds], hashes), kinds))
        _, self.codes, self.kinds = self.readings[0]

    @staticmethod
    def _hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each run of bytes, from running sums of bytes times powers."""
        powers, back = _powers(len(low))
        sums = np.zeros(len(low) + 1, dtype=np.uint64)
        np.multiply(low + np.uint64(1), powers, out=sums[1:])
        np.cumsum(sums, out=sums)
        return _mixed((sums[ends] - sums[starts]) * back[starts])

    def value(self, place: int) -> str:
        return self.low[self.starts[place] : self.ends[place]].decode("utf-8", "replace")


def _unit_codes() -> np.ndarray:
    line = " ".join(UNITS).encode()
    ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
    starts = ends - [len(u) for u in UNITS]
    return Words._hashes(np.frombuffer(line, dtype=np.uint8), starts, ends)


_UNIT_CODES = _unit_codes()
# Codes that stand for numbers, names and units; the first is unused.
_PLACES = _mixed(np.arange(4, dtype=np.uint64) + np.uint64(0x51))


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` codes."""
    count = max(len(codes) - size + 1, 0)
    total = np.full(count, size, dtype=np.uint64)
    for i in range(size):
        total = total * _BASE + codes[i : i + count]
    return _mixed(total)


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def windows(text: Column, sizes: list[int], bitmap=None) -> Column:
    """Windows of whole texts: hash, place, number of words, placeholder values, readings that give this window.

    With a broadcast ``bitmap`` only the windows whose bit is set, of all ``sizes``; without it, as for the benchmark,
    all windows of the size that ``item_size`` gives for the largest one.
    """

    @pandas_udf(WINDOWS)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = bitmap.value if bitmap else None
        for texts in batches:
            if bits is None:
                yield pd.Series([_item_windows(Words([t]), max(sizes)) for t in texts], dtype=object)
                continue
            out, at, texts = [], 0, list(texts)
            while at < len(texts):
                to, room = at + 1, _CHUNK - len(texts[at])
                while to < len(texts) and len(texts[to]) <= room:
                    room -= len(texts[to])
                    to += 1
                out += _held_windows(Words(texts[at:to]), to - at, sizes, bits)
                at = to
            yield pd.Series(out, dtype=object)

    return cut(text)


def _window(words: Words, code: int, kinds: np.ndarray, at: int, first: int, size: int, readings: int):
    slots = [f"{kinds[i]}{words.value(i)}" for i in range(at, at + size) if kinds[i]]
    return code, at - first, size, slots, readings


def _read_windows(words: Words, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, kinds, readings, fresh) of all windows; a window is fresh in the first of the readings that agree on it."""
    hashes = [_template_hashes(codes, kinds, words.values, size) for _, codes, kinds in words.readings]
    for i, (_, _, kinds) in enumerate(words.readings):
        readings = sum(r * (hashes[j] == hashes[i]) for j, (r, _, _) in enumerate(words.readings))
        fresh = np.ones(len(hashes[i]), dtype=bool)
        for earlier in hashes[:i]:
            fresh &= earlier != hashes[i]
        yield hashes[i], kinds, readings, fresh


def _template_hashes(codes: np.ndarray, kinds: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of the template, and of its values too where fewer than ``PLAIN_WORDS`` words are plain."""
    out = window_hashes(codes, size)
    plain = np.concatenate(([0], np.cumsum(kinds == 0)))
    few = np.flatnonzero(plain[size:][: len(out)] - plain[: len(out)] < PLAIN_WORDS)
    if len(few):
        own = np.full(len(few), size, dtype=np.uint64)
        for i in range(size):
            own = own * _BASE + values[few + i]
        out[few] = _mixed(out[few] + own)
    return out


def _held_windows(words: Words, texts: int, sizes: list[int], bits: np.ndarray) -> list[list]:
    out = [[] for _ in range(texts)]
    begin = np.searchsorted(words.doc, np.arange(texts))
    for size in sizes:
        for hashes, kinds, readings, fresh in _read_windows(words, size):
            some = np.flatnonzero(fresh)
            hits = some[_in_bitmap(bits, hashes[some])]
            for at in hits[words.doc[hits] == words.doc[hits + size - 1]].tolist():
                doc = words.doc[at]
                code = int(hashes[at].astype(np.int64))
                out[doc].append(_window(words, code, kinds, at, int(begin[doc]), size, int(readings[at])))
    return out


def item_size(words: int, size: int) -> int:
    """Words in a window of an item: ``size``, or the whole item, or half of it where a change would leave no window."""
    return min(size, words if words < 2 * LEAST_HALF else words // 2)


def _item_windows(words: Words, size: int) -> list:
    size = item_size(len(words.codes), size)
    if not size:
        return []
    found = []
    for hashes, kinds, readings, fresh in _read_windows(words, size):
        signed = hashes.astype(np.int64).tolist()
        found += [_window(words, signed[at], kinds, at, 0, size, int(readings[at])) for at in np.flatnonzero(fresh).tolist()]
    if words.capital[0] and not words.kinds[0]:
        # Inside another text the capital of an item's first word would make it a name: that window counts as well.
        codes, kinds = words.codes[:size].copy(), words.kinds.copy()
        codes[0], kinds[0] = _PLACES[NAME], NAME
        code = _template_hashes(codes, kinds[:size], words.values, size)[0]
        found.append(_window(words, int(code.astype(np.int64)), kinds, 0, 0, size, SENTENCE))
    return found


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(item, of, hash, at, words, slots, readings): every window of every item, ``of`` the number of its places."""
    rows = benchmark.select(F.col(id_col).alias("item"), text_of(text_col).alias("_text"))
    cut = rows.select("item", windows(F.col("_text"), [size]).alias("_w"))
    return cut.select("item", F.expr("array_max(_w.at) + 1").alias("of"), F.inline("_w")).filter(F.col("words") >= min(LEAST_WORDS, size))


def bitmap_of(grams: DataFrame) -> np.ndarray:
    """The bitmap of fixed size with a bit for each window hash, put together by Spark in words of 32 bits."""
    bit = f"shiftrightunsigned(hash, {64 - BITMAP_BITS})"
    words = grams.select(F.expr(f"{bit} >> 5").alias("word"), F.expr(f"shiftleft(1L, cast({bit} & 31 as int))").alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 5), dtype="<u4")
    for row in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        out[row.word] = row.bits
    return out.view(np.uint8)


def leaked_texts(texts: DataFrame, grams: DataFrame, share: float = SHARE, run: int = RUN) -> DataFrame:
    """(_h1, _h2, _len, item, covered, exact): the texts (_text) that leak an item of ``grams`` (a settled table), settled.

    ``covered`` is the share of the item's words that is found; ``exact`` tells that all placeholder values are equal.
    """
    sizes = sorted(r.words for r in grams.select("words").distinct().collect())
    bounded_batches(texts.sparkSession)
    bitmap = texts.sparkSession.sparkContext.broadcast(bitmap_of(grams))
    cut = texts.select(*text_key(F.col("_text")), windows(F.col("_text"), sizes, bitmap).alias("_w"))
    held = cut.select(*KEY, F.inline("_w")).withColumnsRenamed({"at": "there", "slots": "values", "readings": "read"})
    joined = held.join(small(grams), ["hash", "words"])
    common = F.expr(f"filter(array({SENTENCE}, {PLAIN}, {CAPITAL}), r -> r & readings & read > 0)")
    joined = joined.withColumn("reading", F.explode(common))
    # Value pairs along one alignment: one value of the item may stand for one value of the text.
    pairs = F.expr("transform(arrays_zip(slots, values), p -> struct(p.slots as old, p.values as new))")
    sure = F.expr("if(slots = values or 2 * size(slots) <= words, at, null)")
    aligned = joined.groupBy(*KEY, "item", "of", "words", F.expr("there - at").alias("shift"), "reading").agg(
        F.collect_set("at").alias("ats"),
        F.array_sort(F.collect_set(sure)).alias("sure"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
    )
    firm = aligned.filter("size(pairs) = size(array_distinct(transform(pairs, p -> p.old)))")
    # Windows in a row that cover the run; places are distinct and sorted, so only the first and the last are compared.
    need = f"greatest(least({run}, of + words - 1) - words + 1, 1)"
    run_found = f"size(filter(sure, (at, i) -> get(sure, i + {need} - 1) = at + {need} - 1)) > 0"
    firm = firm.withColumn("ran", F.expr(run_found))
    places = F.array_distinct(F.flatten(F.collect_list(F.expr("flatten(transform(ats, at -> sequence(at, at + words - 1)))"))))
    found = firm.groupBy(*KEY, "item", "of", "words").agg(
        (F.size(places) / F.expr("of + words - 1")).alias("covered"),
        F.bool_or("ran").alias("ran"),
        F.bool_and(F.expr("forall(pairs, p -> p.old = p.new)")).alias("exact"),
    )
    found = found.filter(F.col("ran") | (F.col("covered") >= share)).select(*KEY, "item", "covered", "exact")
    found = settle(found, "leaks")
    bitmap.destroy()
    return found


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = SIZE,
    share: float = SHARE,
    run: int = RUN,
) -> DataFrame:
    """(id, item, covered, exact): one row for each document and benchmark item that it leaks."""
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    grams = settle(benchmark_windows(benchmark, item_col, item_text_col, size), "windows")
    leaks = leaked_texts(rows.select("_text"), grams, share, run)
    named = rows.select("_id", *text_key(F.col("_text"))).join(small(leaks), KEY)
    return named.select(F.col("_id").alias(id_col), F.col("item").alias(item_col), "covered", "exact")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text leaks a benchmark item; all columns stay, whatever their names."""
    rows = docs.select(F.struct("*").alias("_row"), text_of(text_col).alias("_text"))
    grams = settle(benchmark_windows(benchmark), "windows")
    leaks = settle(leaked_texts(rows.select("_text"), grams).select(*KEY).distinct(), "leaks")
    kept = rows.select("_row", *text_key(F.col("_text"))).join(small(leaks), KEY, "left_anti")
    return kept.select("_row.*")
