"""Names of several words: leftmost-longest matches of a phrase list, by a token automaton.

The phrases form a trie over tokens with failure links (Aho-Corasick), so a text is read once however many phrases there
are.  The automaton is sent to the tasks after a check of its size; a longer list is cut by a hash of the first word into parts
that fit, each of which reads the texts, and the longest match from each place is chosen among the parts' finds.  Of matches that begin
further left the longest one is taken, and the next begins behind it.

Null and empty texts have no matches; of two tags for one phrase the smaller one holds; an empty phrase list finds nothing.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.scale import bounded_rows

# Phrases in one automaton: some tens of MB.
PART = 200_000
# Texts whose words a task holds at once.
_TEXTS = 128
MATCHES = "array<struct<start: int, words: int, tag: string>>"


class Automaton:
    """All phrases that end at each token.

    Steps lie in one table, from a state and the number of a word to a state, so a state is a few numbers.
    """

    def __init__(self, phrases: Iterable[tuple[list[str], str]]):
        self.numbers: dict[str, int] = {}
        numbered = []
        for words, tag in phrases:
            numbered.append((array("i", [self.numbers.setdefault(w, len(self.numbers)) for w in words]), tag))
        self.width = max(len(self.numbers), 1)
        self.next: dict[int, int] = {}
        kinds: dict[tuple[int, str], tuple[int, str]] = {}
        self.own: list[tuple[int, str] | None] = [None]
        # The steps into the states of each depth.
        levels: list[list[int]] = []
        for words, tag in numbered:
            state = 0
            for depth, word in enumerate(words):
                step = state * self.width + word
                state = self.next.setdefault(step, len(self.own))
                if state == len(self.own):
                    self.own.append(None)
                    if depth == len(levels):
                        levels.append([])
                    levels[depth].append(step)
            if state and (self.own[state] is None or tag < self.own[state][1]):
                kind = (len(words), tag)
                self.own[state] = kinds.setdefault(kind, kind)
        self.back = array("i", bytes(4 * len(self.own)))
        # The nearest state along the failure links, itself included, where a phrase ends.
        self.ends = array("i", (i if own else 0 for i, own in enumerate(self.own)))
        for depth, steps in enumerate(levels):
            for step in steps:
                state, word = divmod(step, self.width)
                child = self.next[step]
                if depth:
                    self.back[child] = self.step(self.back[state], word)
                self.ends[child] = self.ends[child] or self.ends[self.back[child]]

    def step(self, state: int, word: int) -> int:
        """The longest beginning of a phrase that ends with this word, given by its number."""
        while (found := self.next.get(state * self.width + word)) is None:
            if not state:
                return 0
            state = self.back[state]
        return found

    def matches(self, words: list[str]) -> list[tuple[int, int, str]]:
        """(start, words, tag) of the longest phrase from each token where one begins."""
        best: dict[int, tuple[int, str]] = {}
        state = 0
        for at, word in enumerate(words):
            number = self.numbers.get(word)
            # A word of no phrase ends them all.
            state = 0 if number is None else self.step(state, number)
            end = self.ends[state]
            while end:
                size, tag = self.own[end]
                best[at - size + 1] = (size, tag)
                end = self.ends[self.back[end]]
        return [(start, *best[start]) for start in sorted(best)]


def leftmost(found: list[dict]) -> list[dict]:
    """Of matches by start, those that do not begin inside one taken before."""
    kept, free = [], 0
    for match in found:
        if match["start"] >= free:
            kept.append(match)
            free = match["start"] + match["words"]
    return kept


def _packed(rows: list) -> tuple[str, array, list[str]]:
    """Phrases as one text, a line each, with places in a list of tags; their words hold no white space."""
    tags: dict[str, int] = {}
    places = array("i", [tags.setdefault(r["tag"], len(tags)) for r in rows])
    return "\n".join(" ".join(r["words"]) for r in rows), places, list(tags)


def _finder(shared, keys: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, places, tags = shared.value
        listed = texts.split("\n") if places else []
        automaton = Automaton((text.split(" "), tags[i]) for text, i in zip(listed, places, strict=True))
        del texts, listed
        kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("tag", pa.string())]))
        for batch in (whole.slice(at, _TEXTS) for whole in batches for at in range(0, whole.num_rows, _TEXTS)):
            out = []
            for tokens, before in zip(batch.column("_t").to_pylist(), batch.column("_m").to_pylist(), strict=True):
                longest = {m["start"]: m for m in before}
                for start, size, tag in automaton.matches(tokens or []):
                    if start not in longest or longest[start]["words"] < size:
                        longest[start] = {"start": start, "words": size, "tag": tag}
                found = [longest[s] for s in sorted(longest)]
                out.append(leftmost(found) if last else found)
            columns = [batch.column(i) for i in range(keys + 1)]
            yield pa.record_batch([*columns, pa.array(out, kind)], names=batch.schema.names)

    return run


def find_names(
    docs: DataFrame, phrases: DataFrame, key: str = "doc_id", tokens: str = "tokens", part: int = PART, overlapping: bool = False
) -> DataFrame:
    """(key, start, words, phrase, tag): the names of (phrase, tag) in (key, tokens) rows; words of a phrase are cut at blanks.

    With ``overlapping`` the longest one from every place stays, also inside another.
    """
    listed = phrases.select(F.filter(F.split("phrase", r"\s+"), lambda w: w != "").alias("words"), "tag").filter("size(words) > 0 and tag is not null")
    parts = max(1, -(-listed.count() // part))
    none = F.array().cast(MATCHES)
    rows = docs.select(key, F.col(tokens).alias("_t"), none.alias("_m"))
    schema = T.StructType([rows.schema[key], rows.schema["_t"], rows.schema["_m"]])
    for number in range(parts):
        # Phrases of one first word stay together, so that parts compete by length only.
        own = listed.filter(F.pmod(F.xxhash64(F.col("words")[0]), F.lit(parts)) == number)
        shared = docs.sparkSession.sparkContext.broadcast(_packed(bounded_rows(own, 4 * part, "phrases of a part")))
        rows = rows.mapInArrow(_finder(shared, 1, number == parts - 1 and not overlapping), schema)
    found = rows.select(key, "_t", F.explode("_m").alias("m"))
    phrase = F.array_join(F.slice("_t", F.col("m.start") + 1, F.col("m.words")), " ").alias("phrase")
    return found.select(key, F.col("m.start").alias("start"), F.col("m.words").alias("words"), phrase, F.col("m.tag").alias("tag"))
