"""Registered queries that must stay small in what they read and hold."""

import numpy as np
from pyspark.sql import functions as F

from registry import terms, text
from sigloom.operators import classify, embed, topics
from sigloom.operators.terms import term_freq, topic_documents
from sigloom.scale import partition_keys


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _folder(spark, tmp_path, rows) -> str:
    spark.createDataFrame(rows, "doc_id bigint, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_hashed_counts_stay_sparse(spark, tmp_path):
    sf = _folder(spark, tmp_path, [(1, "en", "Red apple, red car"), (2, "en", ""), (3, "de", "zug zug")])
    found = terms.QUERIES["term_freq_hashed"](spark, sf)
    assert "vector_to_array" not in _plan(found)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 100_000, 4), (2, 100_000, 0), (3, 100_000, 2)]


def test_rule_lemmas_read_the_texts_once(spark, tmp_path):
    words = "walk walked talk talked bake baked jump jumped mooned"
    found = text.QUERIES["rule_lemmas"](spark, _folder(spark, tmp_path, [(1, "en", words), (2, "en", "walked")]))
    assert "regexp_extract_all" not in _plan(found)
    got = {r.term: r.lemma for r in found.collect()}
    assert got["walked"] == "walk" and got["mooned"] == "moon" and got["jump"] == "jump"


def test_every_task_has_a_partition_of_its_own(spark):
    for n in (1, 5, 12, 78):
        rows = spark.range(n).select(F.get(partition_keys(spark, n), F.col("id").cast("int")).alias("at")).repartition(n, "at")
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == n


def test_large_term_tables_are_not_joined_to_postings(spark, monkeypatch):
    """Scores of sentences come from a product of packed blocks once the term table is too large for a broadcast."""
    docs = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", ["y", "z", "z"])], "doc_id long, topic string, tokens array<string>")
    model = classify.fit_term_bayes(term_freq(docs), topic_documents(docs))
    new = spark.createDataFrame([(1, ["x"]), (2, ["z", "q"]), (3, []), (None, ["y", "z"])], "doc_id long, tokens array<string>")
    rows = term_freq(new, keep_empty=True)
    want = {r.doc_id: r.log_scores for r in classify.predict_term_bayes(rows, model, ["doc_id"]).collect()}
    monkeypatch.setattr("sigloom.scale.BROADCAST_ROWS", 0)
    found = classify.predict_term_bayes(rows, model, ["doc_id"])
    assert "Join" not in _plan(found)
    got = {r.doc_id: r.log_scores for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(a - b) < 1e-9 for k in want for a, b in zip(want[k], got[k], strict=True))


def test_blocks_of_vectors_follow_their_numbers(spark, monkeypatch):
    """A small block size gives many blocks and the same means; short vectors share a block."""
    vectors = spark.createDataFrame([(f"w{i}", [float(i), 1.0]) for i in range(50)], "word string, vector array<double>")
    rows = spark.createDataFrame([(d, f"w{(7 * d + i) % 60}", i + 1) for d in range(5) for i in range(9)], "doc_id int, term string, tf int")
    want = {r.doc_id: r.vector for r in embed.embed(rows, vectors, ["doc_id"]).collect()}
    monkeypatch.setattr(embed, "BLOCK_NUMBERS", 10)
    got = {r.doc_id: r.vector for r in embed.embed(rows, vectors, ["doc_id"]).collect()}
    assert got.keys() == want.keys() and all(abs(a - b) < 1e-9 for k in want for a, b in zip(want[k], got[k], strict=True))


def test_online_rounds_send_a_vector_once_for_a_term_and_lane(spark):
    weights = spark.createDataFrame([(t, 300, [1.0 + t, 2.0]) for t in range(4)], "term_id long, df long, weight array<double>")
    rows = spark.range(300).selectExpr("id as doc_id", "explode(sequence(0L, 4L)) as term_id").selectExpr("doc_id", "term_id", "double(1 + doc_id % 3) as n")
    sent = topics._by_document(rows, weights, np.array([10.0, 8.0]))
    assert sent.filter("_w is not null").count() <= 4 * topics._LANES
    sums = {r.term_id: sum(r.s) for r in topics.online_sums(rows, weights, np.array([10.0, 8.0]), 0.5).collect()}
    # Every count is dealt over the topics; the term that the weights do not have gives nothing.
    assert sums.keys() == {0, 1, 2, 3} and all(abs(v - 600) < 1e-6 for v in sums.values())


def test_bigrams_are_counted_in_as_many_tasks_as_the_text_asks_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "COUNTED_BYTES", 10)
    sf = _folder(spark, tmp_path, [(1, "en", "red apple red apple " * 20), (2, "en", None), (3, "de", "zug")])
    found = text.QUERIES["bigrams"](spark, sf)
    # 400 + 3 bytes.
    assert found.rdd.getNumPartitions() == 41
    assert sorted(tuple(r) for r in found.collect()) == [("apple red", 39), ("red apple", 40)]


def test_tfidf_cuts_the_texts_once(spark, tmp_path):
    """The scores are read from written postings: the plan holds no texts."""
    found = terms.QUERIES["tfidf"](spark, _folder(spark, tmp_path, [(1, "en", "red red car"), (2, "en", "car"), (2, "en", "car"), (3, "de", None)]))
    assert "regexp_extract_all" not in _plan(found)
    got = sorted((r.doc_id, r.term, r.tf, r.tfidf) for r in found.collect())
    assert got == [(1, "car", 1, 0.223144), (1, "red", 2, 1.832581), (2, "car", 1, 0.223144), (2, "car", 1, 0.223144)]
