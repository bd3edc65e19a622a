"""Encoding to and decoding from a public SentencePiece vocabulary, by a forward pass over a trie of marked words.

Spaces become U+2581, one is put before the text, and the text is cut wherever no piece of the vocabulary has the two
neighbouring characters side by side; no piece can span such a cut, so the words in between are encoded on their own.
The distinct new words of a batch are sorted, which is the depth-first order of their trie: the forward state of a
prefix that two words share is computed once and kept on a stack.

The forward state at a position depends on the prefix alone.  For a unigram vocabulary it is the best score of any
segmentation (Viterbi).  For a BPE vocabulary best sums of scores would not give the merges' result; there the only
segmentation that counts is the one whose neighbouring pieces all survive the merges, so the state is the last piece of
that one: the piece that ends here, follows the state where it begins, and is not merged or cut there.

A character without a piece becomes its UTF-8 bytes, and so does a U+2581 of the text, which keeps decoding exact.
Null texts have null ids and decode to null; an empty text has no ids; any text, however long, is encoded whole; repeated
rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sigloom.llm.common import bounded_batches

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Encoded words (and twice as many checked pairs) that a task remembers; emptied when full.
_CACHE = 200_000


def read_model(path: str = MODEL_PATH) -> bytes:
    """The file, read on the driver; tasks get it by broadcast."""
    with open(os.fspath(path), "rb") as file:
        return file.read()


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        elif tag & 7 == 2:
            size, at = number(at)
            value, at = data[at : at + size], at + size
        else:
            size = 8 if tag & 7 == 1 else 4
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Vocabulary:
    """Pieces, scores and kinds of a model file, and the encoder built on them."""

    def __init__(self, model: bytes):
        # Field numbers and kinds of the published model format.
        pieces, kinds, scores = [], [], []
        self.bpe = False
        for field, value in _fields(model):
            if field == 1:
                own = dict(_fields(value))
                pieces.append(own[1].decode())
                scores.append(float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(own.get(3, 1))
            elif field == 2:
                self.bpe = dict(_fields(value)).get(3, 1) == 2
        normal = [i for i, kind in enumerate(kinds) if kind in (1, 4)]
        self.ids = {pieces[i]: i for i in normal}
        self.names, self.scores = pieces, scores
        self.bytes = {int(pieces[i][1:-1], 16): i for i, kind in enumerate(kinds) if kind == 6}
        self.unknown = next((i for i, kind in enumerate(kinds) if kind == 2), 0)
        self.longest = max(map(len, self.ids), default=1)
        # The length of the longest piece that ends with a character.
        self.reach: dict[str, int] = {}
        for piece in self.ids:
            self.reach[piece[-1]] = max(self.reach.get(piece[-1], 1), len(piece))
        self.worst = min(scores, default=0.0) - 10.0
        raw = [p.replace(SPACE, " ").encode() for p in pieces]
        for value, i in self.bytes.items():
            raw[i] = bytes([value])
        for i, kind in enumerate(kinds):
            if kind in (2, 3):
                raw[i] = b""
        self.raw = raw
        # Characters that stand beside another one in a piece are numbered from 1; 0 is cut off on both sides.
        beside = {pair for p in self.ids for pair in zip(p, p[1:], strict=False)}
        inside = sorted({c for pair in beside for c in pair})
        self.number = np.zeros(0x110000, dtype=np.int32)
        self.number[[ord(c) for c in inside]] = np.arange(1, len(inside) + 1)
        self.joined = np.zeros((len(inside) + 1, len(inside) + 1), dtype=bool)
        for a, b in beside:
            self.joined[self.number[ord(a)], self.number[ord(b)]] = True
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.spines: dict[str, tuple[list, list, bool, bool]] = {}

    # Words

    def cut(self, marked: str) -> list[str]:
        """The words of a marked text: between two of them no piece has the two neighbouring characters."""
        code = self.number[np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        ends = np.flatnonzero(~self.joined[code[:-1], code[1:]]) + 1
        places = [0, *ends.tolist(), len(marked)]
        return [marked[a:b] for a, b in zip(places, places[1:], strict=False)]

    def _loose(self, text: str) -> list[int]:
        """Ids of characters without a piece: their bytes, or the unknown id if the vocabulary has no bytes."""
        data = text.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in data] if self.bytes else [self.unknown] * len(text)

    def merged(self, word: str) -> list[str]:
        """The pieces that merging best pairs first (leftmost of equals) leaves."""
        parts: list[str | None] = list(word)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if 0 <= a and b < len(parts) and (i := self.ids.get(both := parts[a] + parts[b])) is not None:
                heapq.heappush(queue, (-self.scores[i], a, b, both))

        for a in range(len(parts) - 1):
            offer(a, a + 1)
        while queue:
            _, a, b, both = heapq.heappop(queue)
            if parts[a] is None or parts[b] is None or after[a] != b or parts[a] + parts[b] != both:
                continue
            parts[a], parts[b] = both, None
            after[a] = after[b]
            if after[b] < len(parts):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [p for p in parts if p is not None]

    def edges(self, piece: str) -> tuple[list, list, bool, bool]:
        """The symbols at the left and at the right end of a piece while it is merged: (symbol, made at, gone at).

        Also whether merging leaves the piece whole, and whether scores fall along both edges.  Scores stand for time:
        merges happen in falling order of their scores.
        """
        if (known := self.spines.get(piece)) is not None:
            return known
        parts = list(piece)
        left, right = [[parts[0], np.inf, -np.inf]], [[parts[-1], np.inf, -np.inf]]
        while len(parts) > 1:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                if (n := self.ids.get(parts[i] + parts[i + 1])) is not None and self.scores[n] > best:
                    best, at = self.scores[n], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left[-1][2] = best
                left.append([parts[0], best, -np.inf])
            if at == len(parts) - 1:
                right[-1][2] = best
                right.append([parts[-1], best, -np.inf])
        falling = all(made > gone for edge in (left, right) for _, made, gone in edge)
        known = self.spines[piece] = (left, right, parts == [piece], falling)
        return known

    def follows(self, left: int, right: int) -> bool:
        """True if merging two pieces leaves them as they are; left may be -1 for nothing or a loose character."""
        if left < 0:
            return self.edges(self.names[right])[2]
        a, b = self.names[left], self.names[right]
        return self._apart(a, b, self.edges(a), self.edges(b))

    def _apart(self, left: str, right: str, before: tuple, after: tuple) -> bool:
        if not (before[2] and after[2]):
            return False
        if not (before[3] and after[3]):
            return self.merged(left + right) == [left, right]
        # The border is crossed if two symbols stand there at one time and merge before either merges elsewhere; of
        # equal scores the merge further left comes first.
        for x, made_x, gone_x in before[1]:
            for y, made_y, gone_y in after[0]:
                if made_y > gone_x and made_x >= gone_y and (n := self.ids.get(x + y)) is not None:
                    score = self.scores[n]
                    if score > gone_x and score >= gone_y:
                        return False
        return True

    def _bpe_states(self, word: str, shared: int, starts: list[int], lasts: list[int]) -> None:
        """Extends the states (where the last piece begins, its id or -1) from the shared prefix to the whole word."""
        find, known, reach, pairs = self.ids.get, self.pairs.get, self.reach.get, self.pairs
        for at in range(shared + 1, len(word) + 1):
            start, last = at - 1, -1
            for begin in range(max(0, at - reach(word[at - 1], 1)), at):
                if (right := find(word[begin:at])) is not None:
                    key = (lasts[begin] << 24) + right
                    if (fits := known(key)) is None:
                        fits = pairs[key] = self.follows(lasts[begin], right)
                    if fits:
                        start, last = begin, right
                        break
            starts.append(start)
            lasts.append(last)

    def _best_state(self, word: str, at: int, best: list[float]) -> tuple[float, int]:
        """(best score, where the last piece begins) of the prefix ``word[:at]``."""
        found, where = -np.inf, at - 1
        for begin in range(max(0, at - self.longest), at):
            i = self.ids.get(word[begin:at])
            score = best[begin] + (self.scores[i] if i is not None else self.worst if begin == at - 1 else -np.inf)
            if score > found:
                found, where = score, begin
        return found, where

    def learn(self, words: set[str]) -> None:
        """Encodes new words in the order of their trie; the lists are stacks of forward states."""
        if len(self.pairs) >= 2 * _CACHE:
            self.pairs.clear()
        last, starts, lasts, best = "", [0], [-1], [0.0]
        for word in sorted(words):
            if self.bpe and word.startswith(SPACE * 2):
                # Runs of spaces all merge at one score, where only the order of the merges decides.
                self.words[word] = tuple(chain.from_iterable(self._piece_ids(p) for p in self.merged(word)))
                continue
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del starts[shared + 1 :], lasts[shared + 1 :], best[shared + 1 :]
            if self.bpe:
                self._bpe_states(word, shared, starts, lasts)
            else:
                for at in range(shared + 1, len(word) + 1):
                    score, where = self._best_state(word, at, best)
                    best.append(score)
                    starts.append(where)
            pieces, at = [], len(word)
            while at:
                pieces.append(word[starts[at] : at])
                at = starts[at]
            self.words[word] = tuple(chain.from_iterable(map(self._piece_ids, reversed(pieces))))
            last = word

    def _piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else self._loose(piece)

    # Texts

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        cuts = []
        for text in texts:
            parts = ((SPACE if not i else "") + p.replace(" ", SPACE) for i, p in enumerate(text.split(SPACE)))
            cuts.append([self.cut(p) if p else [] for p in parts] if text else [])
        if len(self.words) >= _CACHE:
            self.words.clear()
        self.learn({w for cut in cuts for words in cut for w in words}.difference(self.words))
        known, mark = self.words.__getitem__, tuple(self._loose(SPACE))
        out = []
        for cut in cuts:
            each = (chain(mark if i else (), chain.from_iterable(map(known, words))) for i, words in enumerate(cut))
            out.append(np.fromiter(chain.from_iterable(each), dtype=np.int32))
        return out

    def decode(self, ids) -> str:
        """The text of some ids."""
        data = b"".join([self.raw[i] for i in ids])
        return data.removeprefix(b" ").decode("utf-8", "replace")


def _runs(texts: pa.Array, room: int = 1 << 20) -> Iterator[pa.Array]:
    """Slices of about so many bytes."""
    at = 0
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + room, side="right")))
        yield texts[at:to]
        at = to


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    """An Arrow array of lists."""
    ends = np.cumsum([0] + [0 if x is None else len(x) for x in ids]).astype(np.int32)
    values = np.concatenate([x for x in ids if x is not None] or [np.empty(0, np.int32)])
    empty = pa.array([x is None for x in ids], type=pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=pa.int32()), mask=empty)


def _known(vocabulary: Vocabulary, run: pa.Array) -> tuple[list[str | None], list[np.ndarray | None]]:
    texts = run.to_pylist()
    ids = vocabulary.encode_all([t or "" for t in texts])
    return texts, [None if t is None else x for t, x in zip(texts, ids, strict=True)]


def encode(text: Column, model) -> Column:
    """array<int>: the ids of a text; ``model`` is the broadcast model file."""

    @arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Vocabulary(model.value)
        for texts in batches:
            for run in _runs(texts):
                yield _lists(_known(vocabulary, run)[1])

    return ids(text)


def encode_checked(text: Column, model) -> Column:
    """struct<ids, sha256, exact>: the ids, a digest of the text that they decode to, and whether it is the text."""

    @arrow_udf("struct<ids: array<int>, sha256: string, exact: boolean>")
    def checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Vocabulary(model.value)
        for texts in batches:
            for run in _runs(texts):
                own, ids = _known(vocabulary, run)
                back = [None if x is None else vocabulary.decode(x.tolist()) for x in ids]
                digests = [None if t is None else hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back]
                same = [a == b for a, b in zip(own, back, strict=True)]
                yield pa.StructArray.from_arrays(
                    [_lists(ids), pa.array(digests, type=pa.string()), pa.array(same)], names=["ids", "sha256", "exact"]
                )

    return checked(text)


def decode(ids: Column, model) -> Column:
    """The text of an array of ids."""

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Vocabulary(model.value)
        for arrays in batches:
            for at in range(0, len(arrays), 256):
                run = arrays[at : at + 256].to_pylist()
                yield pa.array([None if x is None else vocabulary.decode(x) for x in run], type=pa.string())

    return text(ids)


def tokenize(docs: DataFrame, text_col: str = "text", path: str = MODEL_PATH) -> DataFrame:
    """``docs`` with token_ids and n_tokens; own columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(read_model(path))
    rows = docs.select(F.struct("*").alias("_row"), encode(F.col(text_col).cast("string"), model).alias("_ids"))
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("token_ids", "n_tokens")]
    return rows.select(*kept, F.col("_ids").alias("token_ids"), F.coalesce(F.size("_ids"), F.lit(0)).alias("n_tokens"))


def detokenize(rows: DataFrame, ids_col: str = "token_ids", path: str = MODEL_PATH) -> DataFrame:
    """``rows`` with the column ``decoded``; an own column of this name is replaced."""
    model = rows.sparkSession.sparkContext.broadcast(read_model(path))
    kept = rows.select(F.struct("*").alias("_row"), decode(F.col(ids_col), model).alias("_text"))
    fields = [F.col("_row")[c].alias(c) for c in rows.columns if c != "decoded"]
    return kept.select(*fields, F.col("_text").alias("decoded"))
