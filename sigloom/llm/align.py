"""Alignment of two tokenizations of one text by token-byte incidence.

Tokens of A and B cover the bytes of the same text, so each tokenization is a sparse 0/1 matrix with a row for each token
and a column for each byte, held as compressed sparse rows (``Rows``).  Gustavson's row-by-row product of A with the
transpose of B has an entry where a token of A and one of B share bytes: these are the overlap links, the value is the
number of bytes.  Bytes after which tokens of A and B both end cut the text into groups; the product of the transposed
group incidence with the token order lists each group's tokens, and every A-B pair of one group is a shared-group link.
Groups are returned as their two lists, which holds all those links without writing each one.

One pass encodes and aligns the texts; it writes the tokens, packed, and the links counted by pair of ids, added up in the
tasks.  A second one joins each document's links with the corpus-wide counts, by broadcast if they are counted
to be few, else by a join that spreads frequent pairs.

Texts that are null or empty, or that either tokenizer does not give back byte by byte, have no tokens; any text, however
long, is encoded whole; strings of special tokens are plain text; repeated rows and null ids count as a document each; an
empty table gives an empty result; only the two named columns are read, so others may have any names.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.llm.common import bounded_batches, text_of
from sigloom.llm.pieces import read_model
from sigloom.scale import settle, sized_join

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: how the vocabulary of A cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes of text that are aligned together.
_CHUNK = 1 << 18
# Counts of id pairs that a task gathers before it adds them up.
_GATHERED = 1_000_000


# Tokenizers


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE vocabulary, whose ids rank the merges."""

    def __init__(self, data: bytes):
        own = json.loads(data)
        special = {x["id"] for x in own.get("added_tokens", ())}
        letters = byte_of_letter()
        ranks = {bytes(letters[c] for c in token): i for token, i in own["model"]["vocab"].items() if i not in special}
        self.raw = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.raw[i] = token
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """A SentencePiece vocabulary."""

    def __init__(self, data: bytes):
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.raw = []
        for i in range(self.encoder.get_piece_size()):
            piece = self.encoder.id_to_piece(i)
            if self.encoder.is_byte(i):
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif self.encoder.is_control(i) or self.encoder.is_unknown(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encoder.encode(texts, num_threads=1)


# Sparse matrices


@dataclass
class Rows:
    """A sparse matrix as compressed sparse rows: the entries of row i are at ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of_places(row: np.ndarray, column: np.ndarray, height: int, width: int) -> Rows:
        """A 0/1 matrix from the places of its entries, sorted by row."""
        starts = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=height))))
        return Rows(starts, column, np.ones(len(column), dtype=np.int64), width)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Rows(starts, self.rows()[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Rows) -> Rows:
        """Gustavson's product: each row is the sum of the rows of ``other`` that its entries name."""
        counts = np.diff(other.starts)[self.columns]
        taken, row, value = other.starts[self.columns], self.rows(), self.values
        if np.any(counts != 1):
            ends = np.cumsum(counts)
            taken = np.repeat(taken - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
            row, value = np.repeat(row, counts), np.repeat(value, counts)
        column, value = other.columns[taken], value * other.values[taken]
        key = row * other.width + column
        if np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, row, column, value = key[order], row[order], column[order], value[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[: len(key)]
        starts = np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=len(self.starts) - 1))))
        return Rows(starts, column[first], np.add.reduceat(value, first) if len(first) else value, other.width)


def incidence(sizes: np.ndarray) -> Rows:
    """Tokens by the bytes they cover, from the tokens' sizes in order."""
    width = int(sizes.sum())
    return Rows.of_places(np.repeat(np.arange(len(sizes)), sizes), np.arange(width), len(sizes), width)


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[Rows, Rows]:
    """Groups by the tokens of A and of B, cut after the bytes where tokens of both end."""
    ends = np.zeros((2, int(a_sizes.sum()) + 1), dtype=bool)
    places = np.cumsum(a_sizes), np.cumsum(b_sizes)
    for side, at in enumerate(places):
        ends[side, at] = True
    number = np.cumsum(ends[0] & ends[1])
    count = int(number[-1])
    sides = (Rows.of_places(np.arange(len(at)), number[at - 1], len(at), count) for at in places)
    a, b = (side.transposed() for side in sides)
    return a, b


def links_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Rows:
    """Overlap links of two tokenizations of the same bytes: tokens of A by tokens of B."""
    return incidence(a_sizes).times(incidence(b_sizes).transposed())


class Batch:
    """The tokens of some rows, joined: the rows' texts end in both tokenizations, so nothing links two of them."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], sizes: tuple[np.ndarray, np.ndarray]):
        none = np.empty(0, dtype=np.int64)
        self.a, self.b = (np.concatenate([none, *x]).astype(np.int64) for x in (a, b))
        self.a_counts, self.b_counts = (np.array([len(y) for y in x], dtype=np.int64) for x in (a, b))
        self.a_sizes, self.b_sizes = sizes[0][self.a], sizes[1][self.b]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pair, links) of every id pair that a row holds linked."""
        links = links_of(self.a_sizes, self.b_sizes)
        token = links.rows()
        row = np.repeat(np.arange(len(self.a_counts)), self.a_counts)[token]
        pair = self.a[token] << 32 | self.b[links.columns]
        order = np.lexsort((pair, row))
        row, pair = row[order], pair[order]
        first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (pair[1:] != pair[:-1]))))[: len(row)]
        return row[first], pair[first], np.diff(np.append(first, len(row)))

    def told(self, names: list[bytes], a_names: int) -> tuple[list[int], list[int], list[bytes]]:
        """(groups, shared-group links, groups as text) of every row; ``names`` has two of each id, those of A first."""
        a, b = groups_of(self.a_sizes, self.b_sizes)
        # In every group the tokens of A, then those of B; names end with the sign that follows in that place.
        a_sizes, b_sizes = np.diff(a.starts), np.diff(b.starts)
        codes = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        a_place = np.arange(len(self.a)) + np.repeat(b.starts[:-1], a_sizes)
        b_place = np.arange(len(self.b)) + np.repeat(a.starts[1:], b_sizes)
        codes[a_place] = 2 * self.a[a.columns]
        codes[b_place] = 2 * self.b[b.columns] + a_names
        codes[a_place[a.starts[1:] - 1]] += 1
        codes[b_place[b.starts[1:] - 1]] += 1
        a_at = np.concatenate(([0], np.cumsum(self.a_counts)))
        spots = (a_at + np.concatenate(([0], np.cumsum(self.b_counts)))).tolist()
        edges = np.searchsorted(a.starts, a_at)
        shared = np.concatenate(([0], np.cumsum(a_sizes * b_sizes)))
        name, codes = names.__getitem__, codes.tolist()
        texts = [b"".join(map(name, codes[x:y]))[:-1] for x, y in zip(spots, spots[1:], strict=False)]
        return np.diff(edges).tolist(), np.diff(shared[edges]).tolist(), texts


def _gathered(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, documents) of several such counts."""
    pair, back = np.unique(np.concatenate([x for x, _ in counts]), return_inverse=True)
    return pair, np.bincount(back, np.concatenate([y for _, y in counts]), len(pair)).astype(np.int64)


def _names(count: int, inside: str, last: str) -> list[bytes]:
    return list(chain.from_iterable((f"{i}{inside}".encode(), f"{i}{last}".encode()) for i in range(count)))


# Spark jobs


_TOKENS = [("row", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64()), ("pair", pa.int64()), ("docs", pa.int64())]


def _over_slices(work: Callable[[Batch, pa.RecordBatch], pa.RecordBatch], sizes: tuple[np.ndarray, np.ndarray], kind: np.dtype):
    """Applies ``work`` to slices of token rows of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, np.asarray(pc.binary_length(batch.column("a"))), _CHUNK // 2):
                ids = [[np.frombuffer(x.as_buffer(), dtype=kind) for x in part.column(c)] for c in ("a", "b")]
                yield work(Batch(*ids, sizes), part)

    return run


class Alignment:
    """Both tokenizations of all rows of a table, settled, with the links and groups that follow from them.

    ``rows`` has (row, id); row numbers are given once, so they stay the same when a task runs again.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = A_PATH, b_path: str = B_PATH):
        bounded_batches(docs.sparkSession)
        self._context = docs.sparkSession.sparkContext
        self._models = read_model(a_path), read_model(b_path)
        vocabularies = ByteLevel(self._models[0]), Pieces(self._models[1])
        self._sizes = tuple(np.array([len(x) for x in v.raw], dtype=np.int64) for v in vocabularies)
        # Packed ids: two bytes each where they fit.
        self._kind = np.dtype("<u2" if max(map(len, self._sizes)) <= 1 << 16 else "<u4")
        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        made = rows.mapInArrow(self._encode(), _schema(rows.schema["id"].dataType))
        made = settle(made, "tokens")
        self.tokens = made.filter("row is not null").select("row", "id", "a", "b", "links")
        self._linked = made.filter("row is null").select("pair", "docs")

    def _encode(self):
        models, sizes, kind = [self._context.broadcast(m) for m in self._models], self._sizes, self._kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a, b = ByteLevel(models[0].value), Pieces(models[1].value)
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for batch in batches:
                schema = pa.schema([_TOKENS[0], batch.schema.field("id"), *_TOKENS[1:]])
                for part in _slices(batch, np.asarray(pc.binary_length(batch.column("text"))), _CHUNK):
                    texts = part.column("text").to_pylist()
                    both = [own if _exact(t, *own, a, b) else ([], []) for t, own in zip(texts, zip(a.encode(texts), b.encode(texts)))]
                    ids = [[np.array(x[side], dtype=kind) for x in both] for side in (0, 1)]
                    row, pair, links = Batch(*ids, sizes).pairs()
                    counts = np.bincount(row, weights=links, minlength=len(texts)).astype(np.int64)
                    none = pa.nulls(len(texts), pa.int64())
                    packed = [pa.array([x.tobytes() for x in side], pa.binary()) for side in ids]
                    columns = [part.column("row"), part.column("id"), *packed, pa.array(counts), none, none]
                    yield pa.record_batch(columns, schema=schema)
                    held.append(np.unique(pair, return_counts=True))
                    if sum(len(x) for x, _ in held) > _GATHERED:
                        held = [_gathered(held)]
                        if len(held[0][0]) > _GATHERED // 2:
                            yield counted(schema, *held.pop())
            if held:
                yield counted(schema, *_gathered(held))

        def counted(schema: pa.Schema, pair: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
            empty = [pa.nulls(len(pair), f.type) for f in list(schema)[:5]]
            return pa.record_batch([*empty, pa.array(pair), pa.array(docs)], schema=schema)

        return run

    def groups(self) -> DataFrame:
        """(row, n_groups, n_shared, groups): the groups as text, ``a1,a2|b1;a3|b2,b3`` with ids in order.

        ``n_shared`` is the number of shared-group links.
        """
        sizes, kind = self._sizes, self._kind
        a_count, b_count = map(len, sizes)

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = [*_names(a_count, ",", "|"), *_names(b_count, ",", ";")]

            def work(batch: Batch, part: pa.RecordBatch) -> pa.RecordBatch:
                counts, shared, texts = batch.told(names, 2 * a_count)
                text = pa.array(texts, pa.binary()).cast(pa.string())
                columns = [part.column("row"), pa.array(counts, pa.int64()), pa.array(shared, pa.int64()), text]
                return pa.record_batch(columns, names=["row", "n_groups", "n_shared", "groups"])

            yield from _over_slices(work, sizes, kind)(batches)

        return self.tokens.select("row", "a", "b").mapInArrow(told, "row long, n_groups long, n_shared long, groups string")

    def pairs(self) -> DataFrame:
        """(row, pair, links): the id pairs (a << 32 | b) that each document holds linked, with the number of places."""

        def work(batch: Batch, part: pa.RecordBatch) -> pa.RecordBatch:
            row, pair, links = batch.pairs()
            return pa.record_batch([part.column("row").take(pa.array(row)), pa.array(pair), pa.array(links)], names=["row", "pair", "links"])

        return self.tokens.select("row", "a", "b").mapInArrow(_over_slices(work, self._sizes, self._kind), "row long, pair long, links long")

    def counts(self) -> DataFrame:
        """(pair, docs, best): in how many documents a pair is linked, and whether that is the most for its id of A."""
        found = settle(self._linked.groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs")
        most = found.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("docs").alias("most"))
        ranked = found.withColumn("a", F.shiftright("pair", 32)).join(most, "a")
        return settle(ranked.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "counts")

    def scores(self) -> DataFrame:
        """(row, n_best, count_sum) of every document with links."""
        scored = sized_join(self.pairs(), self.counts(), ["pair"], ["row"], weight="docs")
        best = F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best")
        return scored.groupBy("row").agg(best, F.sum(F.col("links") * F.col("docs")).alias("count_sum"))

    def sizes(self) -> DataFrame:
        """(row, id, n_a, n_b, n_links) of every row."""
        counts = [(F.octet_length(c) / self._kind.itemsize).cast("long").alias(f"n_{c}") for c in ("a", "b")]
        return self.tokens.select("row", "id", *counts, F.col("links").alias("n_links"))


def _schema(id_type) -> T.StructType:
    out = T.StructType().add("row", T.LongType()).add("id", id_type).add("a", T.BinaryType()).add("b", T.BinaryType())
    return out.add("links", T.LongType()).add("pair", T.LongType()).add("docs", T.LongType())


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, room: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose rows, of the given sizes, add up to about ``room``."""
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + room, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _exact(text: str, a_ids: list[int], b_ids: list[int], a: ByteLevel, b: Pieces) -> bool:
    """True if both tokenizations give the text back."""
    whole = (" " + text).encode()
    return text != "" and b"".join(map(a.raw.__getitem__, a_ids)) == whole == b"".join(map(b.raw.__getitem__, b_ids))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """(id, n_a, n_b, n_links, n_groups, n_shared, groups, n_best, count_sum) of every document."""
    found = Alignment(docs, id_col, text_col, a_path, b_path)
    out = found.sizes().join(found.groups(), "row").join(found.scores(), "row", "left").fillna(0, ["n_best", "count_sum"])
    return out.drop("row").withColumnRenamed("id", id_col)
