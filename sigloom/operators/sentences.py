"""Sentence boundaries by statistics of words and periods.

``abbreviations`` learns from the corpus, in one aggregation over its words, which of them carry a period without ending a
sentence: short words that hardly ever stand without one, and are often followed by a small letter.  ``sentences`` cuts at
line ends and behind words that end in a full stop, question or exclamation mark, unless the word is such an abbreviation or
a single letter.  Both read words as rows; the table of abbreviations is joined, by broadcast only if it is counted to be small.
Patterns are matched on distinct words, or on the words that can end a sentence.  Words are dealt and sorted once, by their
key, and joined to sentences as they stream by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.scale import settle, sized_join

# Longest abbreviation, least number of times with a period, least share with one, least share before a small letter.
LONGEST = 6
LEAST = 3
SHARE = 0.8
BEFORE_SMALL = 0.3
CORE = r"^[^\p{L}]*(\p{L}+)[^\p{L}]*$"
WITH_PERIOD = r"^[^\p{L}]*\p{L}+\.$"
ENDING = r"""[.!?]["'»”’)\]]*$"""
SMALL = r"^\p{Ll}"
# The characters that ENDING allows at the end.
LAST = tuple(".!?\"'»”’)]")


def word_rows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line, pos, token, core, period, small): every word of every line with its letters and what follows it."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line", "_line"))
    tokens = lines.select(key, "line", F.filter(F.split("_line", r"\s+"), lambda t: t != "").alias("_t")).filter("size(_t) > 0")
    after = F.concat(F.slice("_t", F.lit(2), F.size("_t")), F.array(F.lit("")))
    rows = tokens.select(key, "line", F.posexplode(F.arrays_zip(F.col("_t").alias("token"), after.alias("next"))).alias("pos", "_p"))
    token: Column = F.col("_p.token")
    return rows.select(
        key, "line", "pos", token.alias("token"), _core(token).alias("core"), _period(token).alias("period"),
        F.col("_p.next").rlike(SMALL).alias("small"),
    )


def _core(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, CORE, 1))


def _period(token: Column) -> Column:
    return token.endswith(".") & token.rlike(WITH_PERIOD)


def abbreviations(words: DataFrame) -> DataFrame:
    """(core, n_period, n_plain, n_small): the words of ``word_rows`` that a period does not end a sentence behind."""
    small = F.when(F.col("token").endswith("."), F.col("small").cast("int"))
    # Letters and period follow from the word, so they are found once for a distinct one.
    tokens = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(small), F.lit(0)).alias("small"))
    known = tokens.select(_core(F.col("token")).alias("core"), _period(F.col("token")).alias("period"), "n", "small")
    n, period = F.col("n"), F.col("period")
    counted = known.filter((F.col("core") != "") & (F.length("core") <= LONGEST)).groupBy("core").agg(
        F.sum(F.when(period, n).otherwise(0)).alias("n_period"), F.sum(F.when(period, 0).otherwise(n)).alias("n_plain"),
        F.sum(F.when(period, F.col("small")).otherwise(0)).alias("n_small"),
    )
    often = F.col("n_period") >= SHARE * (F.col("n_period") + F.col("n_plain"))
    return counted.filter((F.col("n_period") >= LEAST) & often & (F.col("n_small") >= BEFORE_SMALL * F.col("n_period")))


def sentences(words: DataFrame, known: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, sent_no, sentence): the sentences of ``word_rows`` in order, their words joined by one space.

    ``known``: (core) abbreviations.  Lines without words give no sentence.
    """
    # Settled, since it is counted before it is joined.
    short = settle(known.select(F.col("core").alias("_core"), F.lit(True).alias("_short")), "abbreviations")
    token = F.col("token")
    core = F.when(token.endswith("."), F.when(F.col("period"), F.col("core")))
    narrow = words.select(key, "line", "pos", "token", core.alias("_core"))
    marked = sized_join(narrow, short, ["_core"], [key, "line", "pos"], "left")
    held = F.coalesce("_short", F.lit(False)) | F.coalesce(F.length("_core") == 1, F.lit(False))
    ends = F.right(token, F.lit(1)).isin(*LAST) & token.rlike(ENDING) & ~held
    dealt = marked.select(key, "line", "pos", "token", ends.alias("ends")).repartition(key)
    schema = T.StructType([words.schema[key]]).add("sent_no", T.IntegerType()).add("sentence", T.StringType())
    return dealt.sortWithinPartitions(key, "line", "pos", "token").mapInArrow(_joined(key), schema)


def _whole_places(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches that end where a place ends, with the rows at which a key and a place (key, line, pos) begin."""
    rest = None
    for batch in batches:
        if rest is not None and batch.num_rows:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        codes = batch.column(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        line, pos = (batch.column(c).to_numpy() for c in ("line", "pos"))
        keys = np.append(True, codes[1:] != codes[:-1])
        places = keys | np.append(True, (line[1:] != line[:-1]) | (pos[1:] != pos[:-1]))
        cut = int(np.flatnonzero(places)[-1])
        if cut:
            yield batch.slice(0, cut), keys[:cut], places[:cut]
        rest = batch.slice(cut)
    if rest is not None:
        first = np.arange(rest.num_rows) == 0
        yield rest, first, first


def _joined(key: str):
    """Sentences of sorted words: one begins with a key, with a line, and behind an end.

    Words of repeated keys share their places; the words of a place are in one sentence, whose number counts all that begin there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The key, how many sentences have begun, the words of the last one, and whether the last word was an end.
        last, begun, held, ended = None, 0, [], True
        for batch, new, places in _whole_places(batches, key):
            keys, tokens = batch.column(key), batch.column("token")
            ends = batch.column("ends").to_numpy(zero_copy_only=False).astype(bool)
            new = new.copy()
            new[0] = not held or keys[0].as_py() != last
            begins = new | (batch.column("pos").to_numpy() == 0) | np.append(ended, ends[:-1])
            place = np.flatnonzero(places)
            here = np.add.reduceat(begins.astype(np.int64), place)
            count, new = np.cumsum(here), new[place]
            # Numbers go on from the last batch, or begin anew with a key.
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            sums = np.where(first >= 0, count - count[first] + here[first], begun + count)
            starts, numbers = place[here > 0], sums[here > 0] - 1
            if not len(starts):
                held.append(tokens)
            else:
                if held:
                    whole = [*held, tokens.slice(0, starts[0])]
                    yield made(pa.array([last], keys.type), [begun - 1], pa.chunked_array(whole).combine_chunks(), [0, sum(map(len, whole))])
                done = starts[:-1]
                if len(done):
                    yield made(keys.take(pa.array(done)), numbers[:-1], tokens.slice(starts[0], starts[-1] - starts[0]), starts - starts[0])
                held = [tokens.slice(starts[-1])]
            last, begun, ended = keys[-1].as_py(), int(sums[-1]), bool(ends[-1])
        if held:
            yield made(pa.array([last], keys.type), [begun - 1], pa.chunked_array(held).combine_chunks(), [0, sum(map(len, held))])

    def made(keys: pa.Array, numbers, tokens: pa.Array, offsets) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens)
        return pa.record_batch([keys, pa.array(numbers, pa.int32()), pc.binary_join(lists, " ")], names=[key, "sent_no", "sentence"])

    return run


def split_by_statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sent_no, sentence) with the abbreviations of the same texts."""
    words = word_rows(df, key, text)
    return sentences(words, abbreviations(words), key)
