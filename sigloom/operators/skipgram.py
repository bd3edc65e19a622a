"""Word vectors by skip-gram with negative sampling, without a vocabulary on the driver.

Words are known by a 64-bit hash, so tokens need no join.  One pass counts how often two words stand within a window; the
counts, not the tokens, are what is trained on.  Words are dealt into blocks by their hash, and the vectors of a block, as
words and as contexts, are one row each of a table.  An epoch has as many passes as there are blocks: in a pass every task
has one block of word vectors, one of context vectors, and the counted pairs between the two, packed as places in the
blocks, which it reads as a stream; no two tasks of a pass share a vector.  Noise words come from the context block by an
alias table of counts to the power of 3/4, and are shared by the pairs of a step.  Steps are scaled by the squared gradients of the row so far.

The number of blocks follows from the vocabulary, starting vectors and orders come from hashes and seeds, and pairs are
sorted before they are packed, so the same corpus gives the same model on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.scale import NO_SHUFFLES_LEFT, SMALL_BATCHES, discard, fresh_path, partition_keys, remove, settings, settle

WINDOW = 5
NOISE = 5
RATE = 0.08
# Words in a block, about, and the least number of blocks.
BLOCK_WORDS = 100_000
LEAST_BLOCKS = 4
# Blocks that a vocabulary of some size is cut into at least, one for each so many words.
SPREAD_BLOCKS = 12
SPREAD_WORDS = 10_000
# Pairs of one update, noise words of one update, and pairs counted together before they are added up.
_STEP = 4096
_DRAWN = 64
# Longest run of rows that is added up together with others.
_SHORT = 8
_COUNTED = 1 << 20
# Pairs of one packed row, and pairs that are sorted together for it.
_PACKED = 1 << 14
_GATHERED = 1 << 18
_WORDS, _CONTEXTS, _PAIRS = 0, 1, 2
_PLACES = ("words", "sizes", "contexts", "n")
_ROWS = "shift int, task int, part int, words binary, sizes binary, contexts binary, n binary"
# Words of one row of a block: a hundred rows are a page of Parquet at least, which is compressed outside the heap.
_PART_WORDS = 128
_STATE = "kind int, block int, part int, ids binary, counts binary, vectors binary, squares binary"


def _one_way(docs: DataFrame, window: int, tokens: str) -> DataFrame:
    """(word, context, n): partial counts of pairs in one order each, the smaller hash first, not yet divided by the window.

    Tokens are paired some at a time, so a task holds about _COUNTED pairs however many rows or tokens come at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, some = [], 0, max(1, _COUNTED // (2 * max(window, 1)))
        for batch in batches:
            lists = batch.column(0)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            words = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            for start in range(0, len(words), some):
                for far in range(1, min(window, len(words) - start - 1) + 1):
                    stop = min(start + some, len(words) - far)
                    near = start + np.flatnonzero(row[start + far : stop + far] == row[start:stop])
                    a, b = words[near], words[near + far]
                    held.append((np.minimum(a, b), np.maximum(a, b), np.full(len(near), window + 1 - far)))
                    size += len(near)
                if size > _COUNTED // 2:
                    yield added(held)
                    held, size = [], 0
        if size:
            yield added(held)

    def added(held) -> pa.RecordBatch:
        a, b, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((b, a))
        a, b, n = a[order], b[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        return pa.record_batch([pa.array(a[first]), pa.array(b[first]), pa.array(np.add.reduceat(n, first))], names=["word", "context", "n"])

    hashed = docs.select(F.transform(tokens, lambda t: F.xxhash64(t)).alias("w"))
    return hashed.mapInArrow(run, "word long, context long, n long")


def pair_counts(docs: DataFrame, window: int = WINDOW, tokens: str = "tokens") -> DataFrame:
    """(word, context, n): how often two hashed tokens stand within the window, near ones counting more.

    A distance d counts (window + 1 - d) / window, which is what windows of random width give on average.
    """
    counted = _one_way(docs, window, tokens).groupBy("word", "context").agg(F.sum("n").alias("n"))
    # A word beside itself is met from both sides.
    own = F.when(F.col("word") == F.col("context"), 2 * F.col("n")).otherwise(F.col("n"))
    there = counted.select("word", "context", (own / window).alias("n"))
    back = counted.filter("word != context").select(F.col("context").alias("word"), F.col("word").alias("context"), (F.col("n") / window).alias("n"))
    return there.unionByName(back)


def alias_table(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(share, other): place i is drawn as i with that share, else as its other; places are drawn evenly."""
    scaled = weights * (len(weights) / weights.sum())
    share, other = np.ones(len(weights)), np.arange(len(weights))
    low, high = [list(np.flatnonzero(scaled < 1)), list(np.flatnonzero(scaled >= 1))]
    while low and high:
        a, b = low.pop(), high[-1]
        share[a], other[a] = scaled[a], b
        scaled[b] -= 1 - scaled[a]
        if scaled[b] < 1:
            low.append(high.pop())
    return share, other


def _starting(vocabulary: DataFrame, size: int, seed: int) -> DataFrame:
    """The words and the contexts of every block, in parts: ids in order, counts, vectors and squared gradients."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = [], None

        def parts():
            ids, n = (np.concatenate(x) for x in zip(*held, strict=True))
            draw = np.random.default_rng([seed, block])
            for part, at in enumerate(range(0, len(ids), _PART_WORDS)):
                own, counts = ids[at : at + _PART_WORDS], n[at : at + _PART_WORDS].astype(np.float64)
                first = ((draw.random((len(own), size)) - 0.5) / size).astype("<f4")
                ones = np.full(len(own), 1e-6, dtype="<f4")
                row = {"block": block, "part": part, "ids": own.tobytes(), "counts": counts.tobytes(), "squares": ones.tobytes()}
                yield _state_batch([row | {"kind": kind, "vectors": v.tobytes()} for kind, v in ((_WORDS, first), (_CONTEXTS, first * 0))])

        for batch in batches:
            blocks, ids, n = (batch.column(c).to_numpy() for c in ("block", "id", "n"))
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                if held and blocks[a] != block:
                    yield from parts()
                    held = []
                block = int(blocks[a])
                held.append((ids[a:b], n[a:b]))
        if held:
            yield from parts()

    return vocabulary.select("id", "block", "n").repartition("block").sortWithinPartitions("block", "id").mapInArrow(pack, _STATE)


def _state_batch(rows: list[dict]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _STATE.split(", ")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([*((c, pa.int32()) for c in names[:3]), *((c, pa.binary()) for c in names[3:])]))


class _Block:
    """The vectors of one block, as they are trained, from the rows of its parts."""

    def __init__(self, *rows: dict):
        self.rows = [{k: v for k, v in row.items() if k not in ("vectors", "squares")} for row in rows]
        parts = [np.frombuffer(row["ids"], dtype=np.int64) for row in rows]
        self.ids, self.sizes = np.concatenate(parts), [len(p) for p in parts]
        self.vectors = np.concatenate([np.frombuffer(row["vectors"], dtype="<f4").reshape(n, -1) for row, n in zip(rows, self.sizes, strict=True)])
        self.squares = np.concatenate([np.frombuffer(row["squares"], dtype="<f4") for row in rows])

    def move(self, own: np.ndarray, steps: np.ndarray) -> None:
        """One step of distinct rows, scaled by their squared gradients so far."""
        squares = self.squares[own] + np.einsum("ij,ij->i", steps, steps) / max(steps.shape[1], 1)
        self.squares[own] = squares
        steps *= (RATE / np.sqrt(squares))[:, None]
        self.vectors[own] += steps

    def packed(self) -> Iterator[dict]:
        at = 0
        for row, n in zip(self.rows, self.sizes, strict=True):
            yield row | {"vectors": self.vectors[at : at + n].tobytes(), "squares": self.squares[at : at + n].tobytes()}
            at += n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _runs(values: np.ndarray) -> np.ndarray:
    """Where the values of a sorted array change."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


def _summed(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at ``starts``: short runs row by row, all at once, long ones each by itself."""
    sizes = np.diff(np.append(starts, len(rows)))
    out = rows[starts]
    short = np.flatnonzero((sizes > 1) & (sizes <= _SHORT))
    for place in range(1, _SHORT):
        short = short[sizes[short] > place]
        if not len(short):
            break
        out[short] += rows[starts[short] + place]
    for i in np.flatnonzero(sizes > _SHORT):
        out[i] = rows[starts[i] : starts[i] + sizes[i]].sum(axis=0)
    return out


def train_block(words: _Block, contexts: _Block, noise: tuple, draw, word: np.ndarray, context: np.ndarray, n: np.ndarray) -> None:
    """One pass over some pairs, given by the places of their words.

    The pairs of a step share _DRAWN noise words, each of which weighs as much as makes NOISE words a pair: what the noise
    asks for is the same on average as with words drawn for every pair, and is two matrix products for the words of a step.
    """
    share, other = noise
    order = draw.permutation(len(word))
    for at in range(0, len(order), _STEP):
        some = np.sort(order[at : at + _STEP])
        some = some[np.argsort(word[some], kind="stable")]
        w, c, weight = word[some], context[some], n[some].astype(np.float32)
        starts = _runs(w)
        u, sizes = w[starts], np.diff(np.append(starts, len(w)))
        own = words.vectors[u]
        each, near = np.repeat(own, sizes, axis=0), contexts.vectors[c]
        error = (1 - _sigmoid(np.einsum("ij,ij->i", each, near))) * weight
        near *= error[:, None]
        up = _summed(near, starts)
        each *= error[:, None]
        by = np.argsort(c, kind="stable")
        met = _runs(c[by])
        told, back = c[by][met], _summed(each[by], met)
        if NOISE:
            place = draw.integers(0, len(share), _DRAWN)
            drawn, times = np.unique(np.where(draw.random(_DRAWN) < share[place], place, other[place]), return_counts=True)
            mass = np.repeat(np.add.reduceat(weight, starts)[:, None], len(drawn), axis=1)
            # Noise that is the context itself says nothing.
            at_noise = np.minimum(np.searchsorted(drawn, c), len(drawn) - 1)
            hit = np.flatnonzero(drawn[at_noise] == c)
            np.subtract.at(mass, (np.repeat(np.arange(len(u)), sizes)[hit], at_noise[hit]), weight[hit])
            far = contexts.vectors[drawn]
            push = _sigmoid(own @ far.T) * mass * (times * (NOISE / _DRAWN)).astype(np.float32)
            up -= push @ far
            away = push.T @ own
            # A noise word that is also a context of the step moves once.
            spot = np.minimum(np.searchsorted(told, drawn), len(told) - 1)
            same = told[spot] == drawn
            back[spot[same]] -= away[same]
            contexts.move(drawn[~same], -away[~same])
        contexts.move(told, back)
        words.move(u, up)


def _packer(blocks: int, window: int):
    """Pairs of two blocks, behind the ids of both, as rows of places: one row for each _PACKED pairs and direction.

    Pairs come sorted, as partial counts, which are added up first.
    """
    names = ["shift", "task", "part", "words", "sizes", "contexts", "n"]
    schema = pa.schema([("shift", pa.int32()), ("task", pa.int32()), ("part", pa.int32()), *((c, pa.binary()) for c in names[3:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, parts, held, size, part = None, {}, {}, [], 0, 0

        def rows(some):
            """Both directions of some pairs: sorted by word, cut into parts."""
            nonlocal part
            (low, high), (a, b, n) = task, some
            n = n / window
            ways = [(low, high, a, b, n), (high, low, b, a, n)]
            if low == high:
                apart = a != b
                ways = [(low, low, np.concatenate((a, b[apart])), np.concatenate((b, a[apart])), np.concatenate((np.where(apart, n, 2 * n), n[apart])))]
            out = []
            for own, other, w, c, weight in ways:
                order = np.lexsort((c, w))
                w, c, weight = w[order], c[order], weight[order]
                small = "<u2" if len(ids[other]) <= 1 << 16 else "<u4"
                for at in range(0, len(w), _PACKED):
                    cut = slice(at, at + _PACKED)
                    starts = _runs(w[cut])
                    sizes = np.diff(np.append(starts, len(w[cut])))
                    out.append({"shift": (other - own) % blocks, "task": own, "part": part, "words": w[cut][starts].astype("<u4").tobytes(),
                                "sizes": sizes.astype("<u4").tobytes(), "contexts": c[cut].astype(small).tobytes(),
                                "n": weight[cut].astype("<f4").tobytes()})
                    part += 1
            return pa.RecordBatch.from_pylist(out, schema=schema)

        def added(a, b, n):
            """Sums of equal pairs side by side; those of the pair that is held last go on there."""
            starts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            a, b, n = a[starts], b[starts], np.add.reduceat(n, starts)
            if size and (held[-1][0][-1], held[-1][1][-1]) == (a[0], b[0]):
                held[-1][2][-1] += n[0]
                a, b, n = a[1:], b[1:], n[1:]
            return [a, b, n]

        def cut(least):
            """What is held, in pieces of a size that does not depend on how rows arrive; the last pair may go on."""
            nonlocal held, size
            while size >= least:
                together = [np.concatenate(x) for x in zip(*held, strict=True)]
                yield rows([x[:_GATHERED] for x in together])
                size = max(0, size - _GATHERED)
                held = [[x[_GATHERED:].copy() for x in together]] if size else []

        for batch in batches:
            low, high, kinds = (batch.column(c).to_numpy() for c in ("low", "high", "kind"))
            cuts = np.flatnonzero((np.diff(low) != 0) | (np.diff(high) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                if (own := (int(low[a]), int(high[a]))) != task:
                    yield from cut(1)
                    task, ids, parts, held, size, part = own, {}, {}, [], 0, 0
                rest = batch.slice(a, b - a)
                if kinds[a] != _PAIRS:
                    for row in rest.select(["block", "ids"]).to_pylist():
                        parts.setdefault(row["block"], []).append(np.frombuffer(row["ids"], dtype=np.int64))
                    continue
                if parts:
                    ids, parts = {block: np.concatenate(own) for block, own in parts.items()}, {}
                # Words that are not in the vocabulary have no place.
                found, known = [], np.ones(rest.num_rows, dtype=bool)
                for block, column in zip(own, ("word", "context"), strict=True):
                    value = rest.column(column).to_numpy()
                    if block not in ids:
                        known[:] = False
                        continue
                    place = np.minimum(np.searchsorted(ids[block], value), len(ids[block]) - 1)
                    known &= ids[block][place] == value
                    found.append(place)
                if known.any():
                    fresh = added(*[x[known] for x in (*found, rest.column("n").to_numpy())])
                    if len(fresh[0]):
                        held.append(fresh)
                        size += len(fresh[0])
                        yield from cut(_GATHERED + 1)
        yield from cut(1)

    return run


def _packed_pairs(docs: DataFrame, state: DataFrame, block_of, blocks: int, window: int, tokens: str) -> str:
    """Writes the counted pairs as rows of places, in a folder for each shift between the blocks of word and context."""
    counted = _one_way(docs, window, tokens).select("word", "context", "n", block_of("word").alias("a"), block_of("context").alias("b"))
    turned = F.col("a") > F.col("b")
    null = F.lit(None)
    met = counted.select(
        F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"), F.lit(_PAIRS).alias("kind"), null.cast("int").alias("block"),
        null.cast("int").alias("place"), null.cast("binary").alias("ids"), F.when(turned, F.col("context")).otherwise(F.col("word")).alias("word"),
        F.when(turned, F.col("word")).otherwise(F.col("context")).alias("context"), "n",
    )
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    sides = state.filter(F.col("kind") == _WORDS).select("block", "part", "ids", others).select(
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), F.lit(_WORDS).alias("kind"), "block", F.col("part").alias("place"), "ids",
        *[null.cast("long").alias(c) for c in ("word", "context", "n")],
    )
    met = sides.unionByName(met)
    # Every pair of blocks has a partition of its own.
    number = F.col("low") * blocks + F.col("high") - (F.col("low") * (F.col("low") + 1) / 2).cast("int")
    tasks = blocks * (blocks + 1) // 2
    spread = met.withColumn("_at", F.get(partition_keys(docs.sparkSession, tasks), number.cast("int"))).repartition(tasks, "_at").drop("_at")
    dealt = spread.sortWithinPartitions("low", "high", "kind", "block", "place", "word", "context")
    path = fresh_path(docs.sparkSession, "pairs")
    with settings(docs.sparkSession, NO_SHUFFLES_LEFT):
        dealt.mapInArrow(_packer(blocks, window), _ROWS).write.partitionBy("shift").parquet(path)
    return path


def _trainer(seed: int, turn: int):
    """Rows of one block of words after another: its vectors, those of a block of contexts, the pairs between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parts, sides, noise, draw = None, {}, {}, None, None
        names = [c.split()[0] for c in _STATE.split(", ")]

        def whole():
            """The blocks of a task, when all their parts are there."""
            nonlocal parts, noise
            for kind in list(parts):
                own = parts.pop(kind)
                if kind == _CONTEXTS:
                    noise = alias_table(np.concatenate([np.frombuffer(row["counts"]) for row in own]) ** 0.75)
                sides[kind] = _Block(*own)

        def done():
            whole()
            for side in sides.values():
                for row in side.packed():
                    yield _state_batch([row])

        for batch in batches:
            tasks, kinds = batch.column("task").to_numpy(), batch.column("kind").to_numpy()
            for i in range(batch.num_rows):
                if tasks[i] != task:
                    yield from done()
                    task, parts, sides, draw = tasks[i], {}, {}, np.random.default_rng([seed, turn, int(tasks[i])])
                if kinds[i] != _PAIRS:
                    row = batch.slice(i, 1).select(names).to_pylist()[0]
                    parts.setdefault(row["kind"], []).append(row)
                    continue
                whole()
                w, sizes, c, n = (batch.column(x)[i].as_py() for x in ("words", "sizes", "contexts", "n"))
                w, n = np.repeat(np.frombuffer(w, "<u4").astype(np.int64), np.frombuffer(sizes, "<u4")), np.frombuffer(n, "<f4")
                c = np.frombuffer(c, f"<u{len(c) // len(n)}").astype(np.int64)
                train_block(sides[_WORDS], sides[_CONTEXTS], noise, draw, w, c, n)
        yield from done()

    return run


def train_vectors(
    docs: DataFrame,
    size: int = 100,
    min_count: int = 0,
    seed: int = 11,
    epochs: int = 3,
    window: int = WINDOW,
    tokens: str = "tokens",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(word, vector) of every word of (…, tokens) rows that occurs at least ``min_count`` times."""
    # Rows of vectors and pairs are long, so few of them are decoded and sent to Python at once.
    with settings(docs.sparkSession, SMALL_BATCHES):
        words, state = _trained(docs, size, min_count, seed, epochs, window, tokens, block_words)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = _Block(batch.slice(i, 1).to_pylist()[0])
                offsets = pa.array(np.arange(len(own.ids) + 1, dtype=np.int32) * size)
                yield pa.record_batch([pa.array(own.ids), pa.ListArray.from_arrays(offsets, pa.array(own.vectors.ravel()))], names=["id", "vector"])

    found = state.filter(F.col("kind") == _WORDS).mapInArrow(unpack, "id long, vector array<float>")
    return words.select("word", "id").join(found, "id").select("word", F.col("vector").cast("array<double>").alias("vector"))


def _trained(docs: DataFrame, size: int, min_count: int, seed: int, epochs: int, window: int, tokens: str, block_words: int) -> tuple[DataFrame, DataFrame]:
    """(word, n, id) rows of the vocabulary, and its trained blocks."""
    counted = docs.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    words = settle(counted.select("word", "n", F.xxhash64("word").alias("id")), "words")
    row = words.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")).first()
    if row["n"] != row["ids"]:
        raise ValueError("two words share a hash")
    # Small vocabularies have few blocks, since every block is one more pass; others at least SPREAD_BLOCKS, which work at once.
    blocks = max(LEAST_BLOCKS, min(SPREAD_BLOCKS, -(-row["n"] // SPREAD_WORDS)), -(-row["n"] // block_words))

    def block_of(column: str):
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")

    state = settle(_starting(words.withColumn("block", block_of("id")), size, seed), "vectors")
    path = _packed_pairs(docs, state, block_of, blocks, window, tokens)
    null = F.lit(None)
    keys = partition_keys(docs.sparkSession, blocks)
    for turn in range(epochs * blocks):
        shift = turn % blocks
        own = F.when(F.col("kind") == _WORDS, F.col("block")).otherwise(F.pmod(F.col("block") - shift, F.lit(blocks))).cast("int")
        sides = state.select(own.alias("task"), "*", *[null.cast("binary").alias(c) for c in _PLACES])
        pairs = docs.sparkSession.read.schema(_ROWS).parquet(path).filter(F.col("shift") == shift)
        met = pairs.select(
            "task", F.lit(_PAIRS).alias("kind"), null.cast("int").alias("block"), "part",
            *[null.cast("binary").alias(c) for c in ("ids", "counts", "vectors", "squares")], *_PLACES,
        )
        # Every task has a partition of its own.
        spread = sides.unionByName(met).withColumn("_at", F.get(keys, F.col("task"))).repartition(blocks, "_at").drop("_at")
        dealt = spread.sortWithinPartitions("task", "kind", "part")
        fresh = settle(dealt.mapInArrow(_trainer(seed, turn), _STATE), "vectors")
        discard(state)
        state = fresh
    remove(docs.sparkSession, path)
    return words, state
