import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from sigloom.operators import termtrees


def rows_of(spark, n, seed):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = int(draw.integers(3))
        words = [f"w{int(w)}" for w in draw.poisson(3 + 2 * label, 12)] + [f"c{int(draw.integers(4)) + label}"] * int(draw.integers(1, 5))
        rows.append((i, float(label), words if i % 17 else []))
    return spark.createDataFrame(rows, "doc_id long, label double, tokens array<string>")


def test_a_tree_decides_as_that_of_spark(spark):
    df = rows_of(spark, 300, 4)
    features = CountVectorizer(inputCol="tokens", outputCol="features").fit(df).transform(df)
    known = DecisionTreeClassifier(maxDepth=5, maxBins=32, seed=11).fit(features)
    expected = {r.doc_id: r.prediction for r in known.transform(features).collect()}
    model = termtrees.grow_trees(df, 3)
    got = {r.doc_id: r.prediction for r in termtrees.predict_trees(df, model, ["doc_id"]).collect()}
    right = {r.doc_id: r.label for r in df.collect()}
    # Spark joins leaves that decide alike.
    assert len(model.splits[0]) >= known.numNodes // 2
    assert sum(got[i] == right[i] for i in right) == sum(expected[i] == right[i] for i in right)
    # Splits of equal gain may fall to another term.
    assert sum(got[i] != expected[i] for i in right) <= 15


def test_a_forest_draws_documents_and_terms(spark):
    df = rows_of(spark, 300, 5)
    model = termtrees.grow_trees(df, 3, trees=6)
    again = termtrees.grow_trees(df.repartition(5), 3, trees=6)
    assert model.splits == again.splits and len({tuple(sorted(t.items())) for t in model.splits}) == 6
    sizes = [int(c[1].sum()) for c in model.counts]
    assert len(set(sizes)) > 1 and all(200 < s < 400 for s in sizes)
    found = termtrees.predict_trees(df, model, ["doc_id", "label"])
    assert found.filter("prediction = label").count() > 200


def test_no_number_for_every_document_and_term(spark):
    # 3,000 documents with 100 terms of their own each: 300,000 terms, 3.6 GB as dense rows of ints.
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("double").alias("label"),
        F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: F.concat_ws("_", "id", i)).alias("own"),
    )
    df = df.select("doc_id", "label", F.when(F.col("label") == 1, F.array_append("own", "yes")).otherwise(F.col("own")).alias("tokens"))
    model = termtrees.grow_trees(df, 2)
    assert [t for _, t in model.splits[0].values()] == [0.5] and [c.tolist() for c in model.counts[0].values()] == [[1500, 1500], [1500, 0], [0, 1500]]
    assert sorted({len(r.ids) for r in termtrees.packed_documents(df, ["doc_id"]).collect()}) == [100, 101]


def test_odd_rows(spark):
    kind = "doc_id long, label double, tokens array<string>"
    empty = spark.createDataFrame([(1, 0.0, []), (2, 1.0, None)], kind)
    model = termtrees.grow_trees(empty, 2)
    assert [r.prediction for r in termtrees.predict_trees(empty, model, ["doc_id"]).collect()] == [0.0, 0.0]
    same = spark.createDataFrame([(1, 0.0, ["a"]), (1, 1.0, ["a", "a"]), (1, 1.0, ["a", "a"])], kind)
    model = termtrees.grow_trees(same, 2, vocab_size=1)
    assert [t for _, t in model.splits[0].values()] == [1.5]


@pytest.mark.parametrize("seed", range(3))
def test_thresholds_and_gains(seed):
    draw = np.random.default_rng(seed)
    values, n = np.arange(50.0), draw.integers(1, 9, 50)
    cuts = termtrees.thresholds(values, n, 32)
    assert 0 < len(cuts) < 32 and (np.diff(cuts) > 0).all()
    assert termtrees.thresholds(values[:4], n[:4], 32).tolist() == [0.5, 1.5, 2.5]
    keys = draw.integers(-(1 << 62), 1 << 62, 20_000)
    drawn = termtrees._drawn(keys, seed, 11)
    assert abs(drawn.mean() - 1) < 0.05 and abs((drawn == 0).mean() - np.exp(-1)) < 0.02
