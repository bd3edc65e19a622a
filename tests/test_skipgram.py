import numpy as np
from pyspark.sql import functions as F

from sigloom.operators import skipgram


def test_pair_counts_equal_a_loop(spark):
    texts = [["a", "b", "c", "a", "d"], [], ["b"], ["a", "a", "b"], None]
    docs = spark.createDataFrame([(t,) for t in texts], "tokens array<string>")
    want = {}
    for words in texts:
        for i, w in enumerate(words or []):
            for j in range(max(0, i - 3), min(len(words), i + 4)):
                if i != j:
                    want[w, words[j]] = want.get((w, words[j]), 0) + (4 - abs(i - j)) / 3
    names = {r.h: r.w for r in spark.createDataFrame([(w,) for w in "abcd"], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    got = {(names[r.word], names[r.context]): r.n for r in skipgram.pair_counts(docs, 3).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_alias_table_keeps_the_shares():
    weights = np.array([1.0, 5.0, 0.5, 3.5, 10.0])
    share, other = skipgram.alias_table(weights)
    chance = share / 5
    np.add.at(chance, other, (1 - share) / 5)
    assert np.allclose(chance, weights / weights.sum())


def test_gradient_equals_finite_differences(monkeypatch):
    """One small step raises the objective by what its gradient says."""
    draw = np.random.default_rng(2)

    def block(n):
        ids, f = np.arange(n), draw.normal(0, 0.5, (n, 4)).astype("<f4")
        return skipgram._Block({"ids": ids.tobytes(), "vectors": f.tobytes(), "squares": np.full(n, 1e8, "<f4").tobytes()})

    words, contexts = block(5), block(6)
    w, c, n = np.array([0, 1, 1, 4]), np.array([2, 3, 0, 5]), np.array([1.0, 2.0, 1.0, 3.0])
    old = words.vectors.copy()
    monkeypatch.setattr(skipgram, "NOISE", 0)
    monkeypatch.setattr(skipgram, "RATE", 1.0)

    def loss(vectors):
        return sum(k * np.log(1 / (1 + np.exp(-(vectors[a] @ before[b])))) for a, b, k in zip(w, c, n))

    before = contexts.vectors.copy()
    skipgram.train_block(words, contexts, skipgram.alias_table(np.ones(6)), np.random.default_rng(0), w, c, n)
    step = (words.vectors - old).astype(float) * 1e4
    for place in np.ndindex(old.shape):
        up, down = old.astype(float).copy(), old.astype(float).copy()
        up[place] += 1e-4
        down[place] -= 1e-4
        assert abs((loss(up) - loss(down)) / 2e-4 - step[place]) < 1e-2


def test_planted_pairs_are_neighbours_on_any_cluster(spark):
    """Words that stand in the same places are each other's nearest; partitions do not change the model."""
    draw = np.random.default_rng(5)
    rows = []
    for i in range(900):
        topic = i % 6
        words = [f"c{topic}{draw.integers(8)}" for _ in range(12)]
        words[draw.integers(12)] = f"{'xy'[draw.integers(2)]}{topic}"
        rows.append((i, [str(w) for w in words]))
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    first = {r.word: np.array(r.vector) for r in skipgram.train_vectors(docs, 16, epochs=6, block_words=15).collect()}
    assert len(first) == 60 and all(len(v) == 16 for v in first.values())

    def cosine(a, b):
        return first[a] @ first[b] / np.linalg.norm(first[a]) / np.linalg.norm(first[b])

    for topic in range(6):
        assert max((f"y{t}" for t in range(6)), key=lambda w: cosine(f"x{topic}", w)) == f"y{topic}"
    again = {r.word: np.array(r.vector) for r in skipgram.train_vectors(docs.repartition(7), 16, epochs=6, block_words=15).collect()}
    assert all(np.array_equal(first[w], again[w]) for w in first)
    assert {r.word for r in skipgram.train_vectors(docs, 4, min_count=100, epochs=1).collect()} < set(first)
    assert skipgram.train_vectors(docs.limit(0), 4).count() == 0


def test_packed_pairs_are_the_counted_pairs(spark):
    """Every pair of words is packed once for its direction, in the folder of its shift; a word beside itself counts twice."""
    texts = [["a", "b", "c", "a", "d"], ["a", "a", "b"], ["e"] * 9, None]
    docs = spark.createDataFrame([(t,) for t in texts], "tokens array<string>")
    words = spark.createDataFrame([(w, 1) for w in "abce"], "word string, n long").withColumn("id", F.xxhash64("word"))

    def block_of(column):
        return F.pmod(F.xxhash64(column), F.lit(3)).cast("int")

    state = skipgram.settle(skipgram._starting(words.withColumn("block", block_of("id")), 2, 1))
    ids = {r.block: np.frombuffer(r.ids, np.int64) for r in state.collect()}
    got = {}
    for r in spark.read.parquet(skipgram._packed_pairs(docs, state, block_of, 3, 2, "tokens")).collect():
        w, c = np.repeat(np.frombuffer(r.words, "<u4"), np.frombuffer(r.sizes, "<u4")), np.frombuffer(r.contexts, "<u2")
        for a, b, n in zip(ids[r.task][w], ids[(r.task + r["shift"]) % 3][c], np.frombuffer(r.n, "<f4"), strict=True):
            assert (a, b) not in got
            got[a, b] = float(n)
    known = {i for block in ids.values() for i in block}
    want = {(r.word, r.context): r.n for r in skipgram.pair_counts(docs, 2).collect() if {r.word, r.context} <= known}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_training_leaves_no_tables_of_its_passes(spark, tmp_path, monkeypatch):
    """Pairs and the vectors of earlier passes are deleted: the words and the last vectors stay."""
    monkeypatch.setattr("sigloom.scale.shared_dir", lambda spark: str(tmp_path))
    docs = spark.createDataFrame([(["a", "b", "c", "d"],)], "tokens array<string>")
    assert skipgram.train_vectors(docs, 4, epochs=1).count() == 4
    assert sorted(p.name.split("-")[0] for p in tmp_path.glob("sigloom/*/*")) == ["vectors", "words"]


def test_pairs_are_counted_some_at_a_time(spark, monkeypatch):
    """One long text and many short ones of a batch are paired piece by piece; the counts are the same."""
    monkeypatch.setattr(skipgram, "_COUNTED", 1000)
    docs = spark.createDataFrame([(["a", "b"] * 3000,), *[(["a", "c"],)] * 2000], "tokens array<string>").coalesce(1)
    rows = skipgram._one_way(docs, 5, "tokens").collect()
    assert len(rows) > 50
    by_pair = {}
    for r in rows:
        by_pair[r.word, r.context] = by_pair.get((r.word, r.context), 0) + r.n
    a, b, c = (spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in "abc")
    alike = sum(6 - far for far in (2, 4)) * 3000 - 4 - 2 * 2
    apart = sum((6 - far) * (6000 - far) for far in (1, 3, 5))
    assert by_pair == {(a, a): alike, (b, b): alike, tuple(sorted((a, b))): apart, tuple(sorted((a, c))): 2000 * 5}


def test_blocks_travel_in_short_rows(spark):
    words = spark.range(1000).select(F.col("id").alias("n"), F.xxhash64("id").alias("id"), F.lit(0).alias("block"))
    parts = skipgram._starting(words, 8, 1).orderBy("kind", "part").collect()
    assert max(len(r.ids) // 8 for r in parts) <= skipgram._PART_WORDS
    own = skipgram._Block(*[r.asDict() for r in parts if r.kind == 0])
    assert own.ids.tolist() == sorted(r.id for r in words.collect()) and own.vectors.shape == (1000, 8)
    draw = np.random.default_rng([1, 0])
    assert np.array_equal(own.vectors, ((draw.random((1000, 8)) - 0.5) / 8).astype("<f4"))
    again = skipgram._Block(*own.packed())
    assert np.array_equal(again.vectors, own.vectors) and np.array_equal(again.squares, own.squares)
