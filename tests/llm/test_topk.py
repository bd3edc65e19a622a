import numpy as np
from pyspark.sql import functions as F

from sigloom.llm import topk


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-float(np.dot(v, x)), i) for i, x in rows if i != q and len(x) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_tree_covers_all_points():
    points = np.random.default_rng(1).integers(-9, 9, (1000, 3)).astype(float)
    tree = topk.build_tree(np.arange(1000), points, leaf=16)
    assert sorted(tree.ids) == list(range(1000)) and (points[tree.ids] == tree.points).all()
    leaves = tree.nodes[tree.nodes[:, 2] < 0]
    assert (leaves[:, 1] - leaves[:, 0] <= 16).all() and (leaves[:, 1] - leaves[:, 0]).sum() == 1000
    for i, (a, b, left, right) in enumerate(tree.nodes):
        assert (tree.points[a:b].max(axis=0) == tree.high[i]).all() and (tree.points[a:b].min(axis=0) == tree.low[i]).all()
        assert left < 0 or (tree.nodes[left][0], tree.nodes[left][1], tree.nodes[right][1]) == (a, tree.nodes[right][0], b)
    assert len(topk.build_tree(np.arange(500), np.ones((500, 2)), leaf=16).nodes) > 30


def test_subtrees_are_left_out():
    """Far fewer leaves are visited than there are, and a k-th score that is known leaves out more."""
    draw = np.random.default_rng(3)
    points = np.concatenate([draw.normal(c, 0.05, (512, 4)) for c in draw.normal(0, 3, (32, 4))])
    tree = topk.build_tree(np.arange(len(points)), points, leaf=64)
    queries = points[::97]
    search = topk.Search(np.arange(len(points))[::97], queries, 5, np.full(len(queries), -np.inf))
    search.visit(tree)
    leaves = int((tree.nodes[:, 2] < 0).sum())
    assert search.leaves < 0.15 * leaves * len(queries)
    again = topk.Search(search.ids, queries, 5, search.least)
    again.visit(tree)
    assert again.leaves <= search.leaves and (again.found == search.found).all()
    other = topk.build_tree(np.arange(len(points)), points * 0.1, leaf=64)
    again.leaves = 0
    again.visit(other)
    assert again.leaves < 0.02 * leaves * len(queries)


def test_ties_copies_lengths_and_small_blocks(spark, monkeypatch):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.integers(-4, 5, 6)]) for i in range(300)]
    rows += [(i, [4.0] * 6) for i in range(300, 500)] + [(7, [9.0] * 6), (7, [9.0] * 6)]
    rows += [(i, [1.0, float(i)]) for i in range(600, 604)] + [(i, []) for i in range(700, 703)]
    queries = [r for r in rows if r[0] % 20 == 0]
    odd = [(None, [99.0] * 6), (None, None), (800, None), (820, [1.0, None]), (840, [float("nan")] * 6), (860, [1.0] * 9)]
    vectors = spark.createDataFrame([(*r, 5, "x") for r in rows + odd], "id long, vector array<double>, grp int, least string")
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "GROUP", 2)
    got = topk.nearest(vectors, vectors.filter("id is null or id % 20 = 0"), 20, shard=64)
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, 20)
    assert topk.nearest(vectors.limit(0), vectors.limit(0), 5).count() == 0
    assert topk.nearest(vectors.limit(0), vectors, 5).count() == 0


def test_usable(spark):
    rows = [(1, [1.0]), (2, None), (3, [float("nan")]), (4, [None, 1.0]), (5, [float("-inf")]), (6, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert sorted(r.id for r in df.filter(topk.usable(F.col("v"))).collect()) == [1, 6]
