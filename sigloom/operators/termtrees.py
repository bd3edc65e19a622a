"""Decision trees and forests on term counts, grown level by level over sparse rows.

A document is one row of hashed terms and counts, and the trees so far, which are small, place it anew in every level.  A
level counts the documents of each open node by term, count and class, and the best split of a node is found where the counts
of a term lie together: a term costs what its postings cost, never a number for every document.  Splits lie half way between
the counts that a term has in the corpus, at most ``bins - 1`` of them; impurity is Gini's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.scale import settle, top_n

# Documents that are worked on at once, and rows of counts.
_PART, _BLOCK = 2_000, 200_000
_COUNTS = "tree int, node int, id long, tf long, label int, w long"
_BEST = "tree int, node int, gain double, total long, id long, threshold double, counts array<long>"


@dataclass
class TermTrees:
    """For every tree its splits, node -> (term hash, threshold), and the class counts of its nodes; node n has children 2n, 2n + 1."""

    classes: int
    splits: list[dict[int, tuple[int, float]]]
    counts: list[dict[int, np.ndarray]] = field(default_factory=list)

    def votes(self, docs: pa.RecordBatch) -> np.ndarray:
        """Summed class shares of the leaves that the documents of a packed batch fall into."""
        out = np.zeros((docs.num_rows, self.classes))
        for counts, places in zip(self.counts, _places(self.splits, docs), strict=True):
            shares = np.zeros((max(counts) + 1, self.classes))
            for node, held in counts.items():
                shares[node] = held / max(held.sum(), 1)
            out += shares[places]
        return out


def packed_documents(df: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """(keys…, ids, tfs): the hashed terms of each row, in order, and their counts."""
    ordered = df.select(*keys, F.sort_array(F.transform(F.coalesce(tokens, F.array().cast("array<string>")), lambda t: F.xxhash64(t))).alias("_s"))
    cuts = F.filter(F.transform("_s", lambda t, i: i), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    cut = ordered.withColumn("_cuts", cuts)
    tfs = F.transform("_cuts", lambda at, i: (F.coalesce(F.get("_cuts", i + 1), F.size("_s")) - at).cast("long"))
    return cut.select(*keys, F.transform("_cuts", lambda at: F.get("_s", at)).alias("ids"), tfs.alias("tfs"))


def _flat(docs: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, count) of every posting."""
    lists = docs.column(docs.schema.get_field_index("ids"))
    row = np.repeat(np.arange(docs.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    counts = docs.column(docs.schema.get_field_index("tfs")).flatten()
    return row, lists.flatten().to_numpy(zero_copy_only=False), counts.to_numpy(zero_copy_only=False)


def _inside(found: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(found), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)] == found


def _places(splits: list[dict[int, tuple[int, float]]], docs: pa.RecordBatch) -> list[np.ndarray]:
    """The node of every document in every tree."""
    row, ids, tfs = _flat(docs)
    asked = np.unique(np.array([term for tree in splits for term, _ in tree.values()], dtype=np.int64))
    values = np.zeros((docs.num_rows, len(asked) + 1))
    known = _inside(ids, asked)
    values[row[known], np.searchsorted(asked, ids[known])] = tfs[known]
    places = []
    for tree in splits:
        at = np.ones(docs.num_rows, dtype=np.int64)
        # A parent has a smaller number than its children.
        for node in sorted(tree):
            term, threshold = tree[node]
            here = np.flatnonzero(at == node)
            at[here] = 2 * node + (values[here, np.searchsorted(asked, term)] > threshold)
        places.append(at)
    return places


def _drawn(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws a document, with replacement: a Poisson number from a hash of the document."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    chance = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])
    return np.searchsorted(chance, (x >> np.uint64(11)).astype(float) / (1 << 53)).astype(np.int64)


def _counter(splits, open_nodes, chosen, seed: int, bagged: bool):
    """Rows of ``_COUNTS`` for the postings of documents in open nodes; without terms for their sums only (``open_nodes`` None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _PART):
                yield from counted(batch.slice(a, _PART))

    def rows(tree, nodes, ids, tfs, labels, w):
        columns = [np.full(len(nodes), tree, np.int32), nodes.astype(np.int32), ids, tfs, labels.astype(np.int32), w]
        return pa.record_batch([pa.array(c) for c in columns], names=[c.split()[0] for c in _COUNTS.split(", ")])

    def counted(docs: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        labels = docs.column(docs.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(np.int32)
        keys = docs.column(docs.schema.get_field_index("key")).to_numpy(zero_copy_only=False)
        if open_nodes is None:
            none = np.zeros(docs.num_rows, np.int64)
            for tree in range(len(splits)):
                yield rows(tree, none + 1, none, none, labels, _drawn(keys, tree, seed) if bagged else none + 1)
            return
        row, ids, tfs = _flat(docs)
        if chosen is not None:
            kept = _inside(ids, np.unique(np.concatenate([*chosen.values(), np.zeros(0, np.int64)])))
            row, ids, tfs = row[kept], ids[kept], tfs[kept]
        for tree, at in enumerate(_places(splits, docs)):
            w = _drawn(keys, tree, seed) if bagged else np.ones(docs.num_rows, np.int64)
            for node in open_nodes[tree]:
                own = np.flatnonzero(((at == node) & (w > 0))[row])
                if chosen is not None:
                    own = own[_inside(ids[own], chosen[tree, node])]
                if len(own):
                    yield rows(tree, np.full(len(own), node), ids[own], tfs[own], labels[row[own]], w[row[own]])

    return run


def thresholds(values: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """Where a term may split: half way between its counts, or where their sums come nearest to equal shares if there are too many."""
    middles = (values[1:] + values[:-1]) / 2
    if len(middles) < bins:
        return middles
    stride = n.sum() / bins
    found, target, so_far = [], stride, n[0]
    for i in range(1, len(values)):
        before, so_far = so_far, so_far + n[i]
        if abs(before - target) < abs(so_far - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _gini(counts: np.ndarray) -> np.ndarray:
    total = np.maximum(counts.sum(axis=-1, keepdims=True), 1)
    return 1.0 - ((counts / total) ** 2).sum(axis=-1)


def _splitter(totals: dict[tuple[int, int], np.ndarray], documents: int, bins: int):
    """The best split of every node among the terms of a task, from rows of ``_COUNTS`` by term behind those of its counts (tree -1)."""
    best: dict[tuple[int, int], tuple] = {}

    def meet(rows: np.ndarray) -> None:
        """The rows of one term."""
        tree, node, ids, tfs, labels, w = rows
        corpus = tree < 0
        values, n = tfs[corpus].astype(float), w[corpus]
        if n.sum() < documents:
            values, n = np.append(0.0, values), np.append(documents - n.sum(), n)
        cuts = thresholds(values, n, bins)
        if not len(cuts):
            return
        total = int((values * n).sum())
        for key in sorted(set(zip(tree[~corpus].tolist(), node[~corpus].tolist(), strict=True))):
            whole = totals[key]
            here = (tree == key[0]) & (node == key[1])
            held, size = w[here].sum(), whole.sum()
            # Taking d of N documents away cannot gain more than 2 d / (N - d).
            if key in best and held < size and 2 * held / (size - held) < best[key][0]:
                continue
            right = np.zeros((len(cuts), len(whole)), np.int64)
            # A count lies to the right of all thresholds below it.
            np.add.at(right, (np.searchsorted(cuts, tfs[here]) - 1, labels[here]), w[here] * (tfs[here] > cuts[0]))
            right = right[::-1].cumsum(axis=0)[::-1]
            left = whole - right
            a, b = left.sum(axis=1), right.sum(axis=1)
            gain = _gini(whole) - a / size * _gini(left) - b / size * _gini(right)
            gain[(a < 1) | (b < 1)] = -1
            at = int(np.argmax(gain))
            found = (float(gain[at]), total, -int(ids[0]), float(cuts[at]), left[at])
            if found[0] > 0 and (key not in best or found[:3] > best[key][:3]):
                best[key] = found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)]))
            size += batch.num_rows
            if size > _BLOCK:
                held = [ended(np.concatenate(held, axis=1), False)]
                size = held[0].shape[1]
        if size:
            ended(np.concatenate(held, axis=1), True)
        found = [(*key, gain, total, -term, cut, left.tolist()) for key, (gain, total, term, cut, left) in best.items()]
        names = [c.split()[0] for c in _BEST.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64())]
        columns = list(zip(*found, strict=True)) or [[]] * len(names)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def ended(rows: np.ndarray, last: bool) -> np.ndarray:
        """Works on whole terms and returns the rows of the last one, which may go on."""
        starts = np.flatnonzero(np.append(True, rows[2, 1:] != rows[2, :-1]))
        ends = np.append(starts[1:], rows.shape[1])
        # Terms whose documents are too few to gain more than what is found already need no look.
        for a, b in zip(starts, ends, strict=True) if last else zip(starts[:-1], ends[:-1], strict=True):
            meet(rows[:, a:b])
        return rows[:, :0] if last else rows[:, starts[-1] :]

    return run


def grow_trees(
    docs: DataFrame, classes: int, trees: int = 1, depth: int = 5, bins: int = 32, seed: int = 11, vocab_size: int | None = None
) -> TermTrees:
    """Trees on (doc_id, label, tokens) rows; more than one draw documents with replacement and, for every node, the root of the number of terms."""
    settled = settle(packed_documents(docs.select(F.xxhash64("doc_id").alias("key"), F.col("label").cast("int").alias("label"), "tokens"), ["key", "label"]), "packed")
    pairs = settled.select(F.explode(F.arrays_zip("ids", "tfs")).alias("p")).groupBy(F.col("p.ids").alias("id"), F.col("p.tfs").alias("tf"))
    values = settle(pairs.agg(F.count(F.lit(1)).alias("w")), "values")
    terms = values.groupBy("id").agg(F.sum(F.col("tf") * F.col("w")).alias("total"))
    if vocab_size is not None:
        terms = settle(top_n(terms, [F.desc("total"), F.asc("id")], vocab_size, ["id"]), "terms")
        values = values.join(terms.select("id"), "id", "left_semi")
    documents, vocabulary = settled.count(), terms.count()
    model = TermTrees(classes, [{} for _ in range(trees)])
    bagged = trees > 1

    def counted(open_nodes, chosen=None) -> DataFrame:
        rows = settled.mapInArrow(_counter(model.splits, open_nodes, chosen, seed, bagged), _COUNTS)
        return rows.groupBy("tree", "node", "id", "tf", "label").agg(F.sum("w").alias("w"))

    roots = [np.zeros(classes, np.int64) for _ in range(trees)]
    for r in counted(None).collect():
        roots[r["tree"]][r["label"]] = r["w"]
    model.counts = [{1: root} for root in roots]
    known = values.select(F.lit(-1).alias("tree"), F.lit(-1).alias("node"), "id", "tf", F.lit(-1).alias("label"), "w")
    open_nodes = [[1] for _ in range(trees)]
    for _ in range(depth):
        open_nodes = [[n for n in nodes if _gini(model.counts[t][n]) > 0] for t, nodes in enumerate(open_nodes)]
        if not any(open_nodes) or not vocabulary:
            break
        chosen = _chosen(terms, open_nodes, math.ceil(math.sqrt(vocabulary)), vocabulary, seed) if bagged else None
        rows = counted(open_nodes, chosen)
        if vocab_size is not None:
            rows = rows.join(terms.select("id"), "id", "left_semi").select("tree", "node", "id", "tf", "label", "w")
        met = known
        if bagged:
            asked = docs.sparkSession.createDataFrame([(int(i),) for i in np.unique(np.concatenate(list(chosen.values())))], "id long")
            met = known.join(F.broadcast(asked), "id", "left_semi").select(known.columns)
        near = met.unionByName(rows).repartition("id").sortWithinPartitions("id", "tree", "node", "tf")
        totals = {(t, n): model.counts[t][n] for t, nodes in enumerate(open_nodes) for n in nodes}
        found = near.mapInArrow(_splitter(totals, documents, bins), _BEST).collect()
        best = {}
        for r in sorted(found, key=lambda r: (r["gain"], r["total"], -r["id"])):
            best[r["tree"], r["node"]] = r
        open_nodes = [[] for _ in range(trees)]
        for (t, n), r in sorted(best.items()):
            left = np.array(r["counts"])
            model.splits[t][n] = (r["id"], r["threshold"])
            model.counts[t] |= {2 * n: left, 2 * n + 1: model.counts[t][n] - left}
            open_nodes[t] += [2 * n, 2 * n + 1]
    return model


def _chosen(terms: DataFrame, open_nodes: list[list[int]], size: int, vocabulary: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """For every open node ``size`` terms, those that come first by a hash of the term and the node."""
    nodes = [(t, n) for t, nodes in enumerate(open_nodes) for n in nodes]
    places = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(n).alias("node")) for t, n in nodes])).alias("p")
    drawn = terms.select("id", places).select("id", "p.tree", "p.node", F.xxhash64("id", "p.tree", "p.node", F.lit(seed)).alias("h"))
    # Far more than the wanted ones lie below this bound.
    share = min(1.0, (2 * size + 100) / vocabulary)
    first = Window.partitionBy("tree", "node").orderBy("h", "id")
    few = drawn.filter(F.col("h") <= min(int((share * 2 - 1) * (1 << 63)), (1 << 63) - 1)).withColumn("place", F.row_number().over(first))
    out = {node: [] for node in nodes}
    for r in few.filter(F.col("place") <= size).select("tree", "node", "id").collect():
        out[r["tree"], r["node"]].append(r["id"])
    return {node: np.sort(np.array(ids, dtype=np.int64)) for node, ids in out.items()}


def predict_trees(df: DataFrame, model: TermTrees, keys: list[str]) -> DataFrame:
    """(keys…, prediction): the class with the most votes for (keys…, tokens) rows; ties go to the first class."""
    schema = T.StructType([df.schema[c] for c in keys]).add("prediction", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _PART):
                docs = batch.slice(a, _PART)
                found = np.argmax(model.votes(docs), axis=1).astype(float)
                yield pa.record_batch([*[docs.column(c) for c in keys], pa.array(found)], names=[*keys, "prediction"])

    return packed_documents(df, keys).mapInArrow(run, schema)
