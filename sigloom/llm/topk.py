"""Exact top-k search by inner product over KD-trees.

The vectors are dealt into shards of about ``SHARD`` rows; each shard becomes a KD-tree in one row of a table in the shared
folder: median splits of the widest side, and a tight box round the points of every node.  Some trees make a group.

1. Every query searches one tree, in the tasks that hold the queries; its k-th score there is a floor for the true one.
2. A query goes to the groups whose box allows a score of at least that floor.
3. A task holds the trees of a group and takes the group's queries in blocks.  Each block walks the trees best first: a
   query descends to the leaf whose box promises most, then nodes come by the highest bound that any of their queries has
   left, each with the queries whose bound still reaches their k-th score so far.  That score carries over from leaf to leaf
   and from tree to tree, so whole subtrees and trees are left out.

All of this is one job for each step; the driver holds one tree and the groups' boxes.  A block of queries meets the trees
of a group, so nothing is joined pair by pair.

Vectors that are null or hold a null or a non-finite number take no part, nor do rows without an id; vectors meet those
of their own length only.  A row with the query's id is the query's own and no candidate of it.  An id that is asked
for twice is one query (the smaller vector); repeated candidate rows are candidates each.  Ties go to the smaller id.
An empty table gives an empty result; only the two columns are read, so others may have any names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.scale import bounded_rows, settle

SHARD = 8192
LEAF = 128
# Trees that a task holds at a time.
GROUP = 16
# Queries that walk the trees together.
BLOCK = 4096
# Groups whose boxes the driver may hold; a group has GROUP * SHARD vectors.
MAX_GROUPS = 200_000
FOUND = "query_id long, vec_id long, score double"
_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_TREE = "dim int, grp long, ids binary, points binary, nodes binary, high binary, low binary"


def usable(vector: Column) -> Column:
    """True for vectors of finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


@dataclass
class Tree:
    """Points in leaf order; ``nodes`` has (begin, end, left, right) of every node, the root first, -1 for no child."""

    ids: np.ndarray
    points: np.ndarray
    nodes: np.ndarray
    high: np.ndarray
    low: np.ndarray


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Median splits of the widest side until a node holds at most ``leaf`` points."""
    order, nodes, high, low = np.arange(len(points)), [], [], []
    todo = [(0, len(points), -1, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes)
        own = points[order[a:b]]
        high.append(own.max(axis=0, initial=-np.inf))
        low.append(own.min(axis=0, initial=np.inf))
        nodes.append([a, b, -1, -1])
        if b - a <= leaf:
            # By row number, so that a stable sort by score leaves equal scores by id.
            order[a:b].sort()
            continue
        spread = high[-1] - low[-1]
        middle = (b - a) // 2
        split = np.argpartition(own[:, spread.argmax()], middle) if spread.any() else np.arange(b - a)
        order[a:b] = order[a:b][split]
        here = len(nodes) - 1
        todo += [(a + middle, b, here, 1), (a, a + middle, here, 0)]
    shape = len(nodes), points.shape[1]
    return Tree(ids[order], points[order], np.array(nodes).reshape(-1, 4), np.array(high).reshape(shape), np.array(low).reshape(shape))


def _packed(frame: pd.DataFrame) -> pd.DataFrame:
    """A shard as one row."""
    frame = frame.sort_values("id", kind="stable")
    points = np.stack(frame["vector"].to_numpy()).astype(np.float64).reshape(len(frame), -1)
    tree = build_tree(frame["id"].to_numpy(dtype=np.int64), points)
    parts = {n: [getattr(tree, n).tobytes()] for n in ("ids", "points", "nodes", "high", "low")}
    return pd.DataFrame({"dim": [points.shape[1]], "grp": [int(frame["grp"].iloc[0])], **parts})


def _unpacked(row: dict) -> Tree:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    nodes = np.frombuffer(row["nodes"], dtype=np.int64).reshape(-1, 4)
    boxes = (np.frombuffer(row[n]).reshape(len(nodes), -1) for n in ("high", "low"))
    return Tree(ids, np.frombuffer(row["points"]).reshape(len(ids), -1), nodes, *boxes)


def build_trees(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per shard of ``vectors`` (id, vector); vectors of different lengths make different trees and groups."""
    count = vectors.count()
    number = F.pmod(F.xxhash64("id", "vector"), F.lit(-(-max(count, 1) // shard)))
    dealt = vectors.select("id", "vector", F.size("vector").alias("dim"), number.alias("shard"))
    dealt = dealt.withColumn("grp", F.xxhash64("dim", F.expr(f"shard div {GROUP}")))
    return dealt.groupBy("shard", "dim").applyInPandas(_packed, _TREE)


class Search:
    """The best candidates of a block of queries so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray):
        self.ids, self.queries, self.k = ids, queries, k
        self.least = least.copy()  # of each query: no candidate with a lower score is wanted
        self.high, self.low = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.leaves = 0  # visits of a query to a leaf

    def bounds(self, tree: Tree, node: int, own: np.ndarray) -> np.ndarray:
        """The highest score that a point in a node's box can have, for some queries."""
        return self.high[own] @ tree.high[node] + self.low[own] @ tree.low[node]

    def visit(self, tree: Tree) -> None:
        """A tree, best first."""
        everyone = np.arange(len(self.ids))
        start = everyone[self.bounds(tree, 0, everyone) >= self.least]
        if not len(start):
            return
        done = self._descend(tree, start)
        queue: list[tuple[float, int, np.ndarray, np.ndarray]] = [(-np.inf, 0, start, self.bounds(tree, 0, start))]
        while queue:
            _, node, own, bound = heapq.heappop(queue)
            # Equal scores may still win by their id.
            own = own[bound >= self.least[own]]
            if not len(own):
                continue
            begin, end, left, right = tree.nodes[node]
            if left < 0:
                self._leaf(tree, node, own[done[own] != node])
                continue
            for child in (left, right):
                bound = self.bounds(tree, child, own)
                near = bound >= self.least[own]
                if near.any():
                    heapq.heappush(queue, (-float(bound[near].max()), int(child), own[near], bound[near]))

    def _descend(self, tree: Tree, own: np.ndarray) -> np.ndarray:
        """Takes each query to the leaf that promises most on the way down; returns that leaf."""
        done = np.full(len(self.ids), -1)
        todo = [(0, own)]
        while todo:
            node, some = todo.pop()
            _, _, left, right = tree.nodes[node]
            if left < 0:
                self._leaf(tree, node, some)
                done[some] = node
                continue
            first = self.bounds(tree, left, some) >= self.bounds(tree, right, some)
            todo += [(child, part) for child, part in ((left, some[first]), (right, some[~first])) if len(part)]
        return done

    def _leaf(self, tree: Tree, node: int, own: np.ndarray) -> None:
        if not len(own):
            return
        self.leaves += len(own)
        begin, end = tree.nodes[node][:2]
        ids = tree.ids[begin:end]
        scores = self.queries[own] @ tree.points[begin:end].T
        scores[ids == self.ids[own, None]] = -np.inf
        better = (scores >= self.least[own, None]).any(axis=1)
        own, scores = own[better], scores[better]
        score = np.concatenate((self.score[own], scores), axis=1)
        found = np.concatenate((self.found[own], np.broadcast_to(ids, scores.shape)), axis=1)
        order = np.lexsort((found, -score), axis=1)[:, : self.k]
        self.score[own], self.found[own] = np.take_along_axis(score, order, 1), np.take_along_axis(found, order, 1)
        self.least[own] = np.maximum(self.least[own], self.score[own, -1])

    def rows(self) -> pa.RecordBatch:
        query, place = np.nonzero(self.score > -np.inf)
        return pa.record_batch([pa.array(self.ids[query]), pa.array(self.found[query, place]), pa.array(self.score[query, place])], schema=_SCHEMA)


def _block(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("id").to_numpy(), batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, dim)


def _floors(asked: DataFrame, first: dict[int, dict], boxes: dict[int, tuple], k: int) -> DataFrame:
    """(id, vector, dim, least, grps): the k-th score in one tree, and the groups that can reach it."""
    context = asked.sparkSession.sparkContext
    trees, boxes = context.broadcast(first), context.broadcast(boxes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in trees.value:
                    continue
                some = batch.take(pa.array(np.flatnonzero(dims == dim)))
                for at in range(0, some.num_rows, BLOCK):
                    part = some.slice(at, BLOCK)
                    ids, queries = _block(part, dim)
                    search = Search(ids, queries, k, np.full(len(ids), -np.inf))
                    search.visit(_unpacked(trees.value[dim]))
                    names, high, low = boxes.value[dim]
                    reached = search.high @ high.T + search.low @ low.T >= search.least[:, None]
                    groups = pa.array([names[r].tolist() for r in reached], pa.list_(pa.int64()))
                    yield pa.record_batch(
                        [part.column("id"), part.column("vector"), part.column("dim"), pa.array(search.least), groups],
                        names=["id", "vector", "dim", "least", "grps"],
                    )

    return asked.mapInArrow(run, "id long, vector array<double>, dim int, least double, grps array<long>")


def _walk(k: int):
    """Rows sorted by group, in each the trees before the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trees, held = None, [], []

        def searched():
            ids, queries, least = (np.concatenate(x) for x in zip(*held, strict=True))
            search = Search(ids, queries, k, least)
            for tree in trees:
                search.visit(tree)
            held.clear()
            return search.rows()

        for batch in batches:
            groups, kinds = batch.column("grp").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                if groups[a] != group:
                    if held:
                        yield searched()
                    group, trees = groups[a], []
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    trees += [_unpacked(row) for row in part.select(["ids", "points", "nodes", "high", "low"]).to_pylist()]
                    continue
                for at in range(0, part.num_rows, BLOCK):
                    some = part.slice(at, BLOCK)
                    held.append((*_block(some, trees[0].points.shape[1]), some.column("least").to_numpy()))
                    if sum(len(x[0]) for x in held) >= BLOCK:
                        yield searched()
        if held:
            yield searched()

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, *, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query with the rows of ``vectors``.

    Both tables: id, vector (array of doubles).
    """
    taken = F.col("id").isNotNull() & usable(F.col("vector"))
    trees = settle(build_trees(vectors.filter(taken).select("id", "vector"), shard), "trees")
    asked = queries.filter(taken).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = settle(asked.select("id", "vector", F.size("vector").alias("dim")), "queries")
    firsts = {r["dim"]: r.asDict() for r in trees.groupBy("dim").agg(F.min_by(F.struct(*trees.columns), "grp").alias("t")).select("t.*").collect()}
    floors = settle(_floors(asked, firsts, _group_boxes(trees), k), "floors")
    null = F.lit(None)
    walkers = floors.select(F.explode("grps").alias("grp"), F.lit(1).alias("kind"), "id", "vector", "least")
    walkers = walkers.select("*", *[null.cast("binary").alias(c) for c in ("ids", "points", "nodes", "high", "low")])
    held = trees.select(
        "grp", F.lit(0).alias("kind"), null.cast("long").alias("id"), null.cast("array<double>").alias("vector"),
        null.cast("double").alias("least"), "ids", "points", "nodes", "high", "low",
    )
    both = held.unionByName(walkers).repartition("grp").sortWithinPartitions("grp", "kind")
    found = both.mapInArrow(_walk(k), FOUND)
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _group_boxes(trees: DataFrame) -> dict[int, tuple]:
    """By vector length: (groups, highest and lowest numbers of each)."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            sides = [[np.frombuffer(r[n])[: r["dim"]].tolist() for r in rows] for n in ("high", "low")]
            columns = [batch.column("grp"), batch.column("dim"), *(pa.array(s, pa.list_(pa.float64())) for s in sides)]
            yield pa.record_batch(columns, names=["grp", "dim", "high", "low"])

    boxes = trees.select("grp", "dim", "high", "low").mapInArrow(roots, "grp long, dim int, high array<double>, low array<double>")
    ends = F.arrays_zip("high", "low")
    sides = boxes.select("grp", "dim", F.posexplode_outer(ends).alias("place", "end"))
    sides = sides.groupBy("grp", "dim", "place").agg(F.max("end.high").alias("high"), F.min("end.low").alias("low"))
    whole = sides.groupBy("grp", "dim").agg(F.sort_array(F.collect_list(F.struct("place", "high", "low"))).alias("sides"))
    out: dict[int, tuple[list, list, list]] = {}
    for row in bounded_rows(whole, MAX_GROUPS, "groups of trees"):
        names, high, low = out.setdefault(row["dim"], ([], [], []))
        own = [s for s in row["sides"] if s["place"] is not None]
        names.append(row["grp"])
        high.append([s["high"] for s in own])
        low.append([s["low"] for s in own])
    return {d: (np.array(n, dtype=np.int64), *(np.array(x, dtype=float).reshape(len(n), d) for x in (h, w))) for d, (n, h, w) in out.items()}
