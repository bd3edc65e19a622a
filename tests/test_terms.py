import math

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from sigloom import scale
from sigloom.operators import terms
from sigloom.functions.text import content_words


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "a", ["x", "y", "x"]), (2, "a", ["x"]), (3, "b", ["y", "z", "z", "z"]), (4, "b", [])]
    return spark.createDataFrame(rows, "doc_id bigint, topic string, tokens array<string>")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_term_freq(docs):
    got = {(r.doc_id, r.term, r.tf) for r in terms.term_freq(docs).collect()}
    assert got == {(1, "x", 2), (1, "y", 1), (2, "x", 1), (3, "y", 1), (3, "z", 3)}
    kept = terms.term_freq(docs, keep_empty=True).filter("doc_id = 4").collect()
    assert [(r.term, r.tf) for r in kept] == [(None, None)]


def test_idf_constants(spark):
    # 124 documents; a term in 1, 13 and all of them.
    rows = [(i, t, 1) for t, n in (("one", 1), ("some", 13), ("all", 124)) for i in range(n)]
    postings = spark.createDataFrame(rows, "doc_id bigint, term string, tf bigint")
    got = as_dict(terms.idf(postings, F.lit(124)), "term", "idf")
    assert got["one"] == pytest.approx(4.135166556742356, abs=1e-15)
    assert got["some"] == pytest.approx(2.1892564076870427, abs=1e-15)
    assert got["all"] == 0.0


def test_tfidf_matches_spark_ml(spark, docs):
    postings = terms.term_freq(docs)
    got = {(r.doc_id, r.term): r.tfidf for r in terms.tfidf(postings, terms.idf(postings, F.lit(4))).collect()}
    counter = CountVectorizer(inputCol="tokens", outputCol="c").fit(docs)
    counted = counter.transform(docs)
    for row in IDF(inputCol="c", outputCol="w").fit(counted).transform(counted).collect():
        for i, weight in zip(row.w.indices, row.w.values):
            assert got.pop((row.doc_id, counter.vocabulary[i])) == pytest.approx(weight)
    assert not got


def test_summary_and_vocabulary(docs):
    row = terms.corpus_summary(docs).first()
    assert (row.documents, row.vocabulary, row.doc_terms, row.tokens) == (4, 3, 5, 8)
    got = [(r.term, r.n, r.df) for r in terms.vocabulary(terms.term_freq(docs), 2).collect()]
    assert got == [("x", 3, 2), ("z", 3, 1)]
    assert terms.vocabulary(terms.term_freq(docs), 10, 2).count() == 2


def test_scores(docs):
    postings = terms.term_freq(docs)
    n = docs.agg(F.count(F.lit(1)))
    best = as_dict(terms.top_tfidf_words(postings, n, 10), "term", "score")
    last = as_dict(terms.top_tfidf_words(postings, n, 10, "last"), "term", "score")
    assert best["x"] == round(2 * math.log(5 / 3), 6) and last["x"] == round(math.log(5 / 3), 6)
    with pytest.raises(ValueError):
        terms.top_tfidf_words(postings, n, 10, "other")
    by_topic = terms.top_tfidf_words_by_topic(postings, terms.topic_documents(docs), 1).collect()
    assert {(r.topic, r.term) for r in by_topic} == {("a", "y"), ("b", "z")}


def test_spread_join_equals_plain_join(spark):
    big = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key")
    )
    small = big.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 20")
    for how in ("inner", "left", "left_semi"):
        want = sorted(map(str, big.join(small, "key", how).collect()))
        for weight in ("n", None):
            got = scale.spread_join(big, small, ["key"], ["id"], how, weight)
            assert sorted(map(str, got.select(big.join(small, "key", how).columns).collect())) == want
    lanes = scale.spread_join(big, small, ["key"], ["id"], "inner", "n")
    assert lanes.filter("key = 'hot'").count() == 6667


def test_top_cut_is_exact(spark):
    df = spark.range(5_000).select("id", (F.col("id") % 2).alias("g"), (F.col("id") * 37 % 5_000).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    want = [r.id for r in df.orderBy(*order).limit(1_500).collect()]
    assert [r.id for r in scale.top_n(df, order, 1_500, ["id"]).collect()] == want
    grouped = scale.top_per_group(df, ["g"], order, 1_200, ["id"])
    assert grouped.count() == 2_400
    assert grouped.groupBy("g").agg(F.min("v").alias("m")).filter("m < 2590").count() == 0


def test_settled_tables_lie_in_the_shared_folder(spark):
    table = scale.settle(spark.range(3), "t")
    assert table.count() == 3
    assert all(scale.shared_dir(spark) in path for path in table.inputFiles())
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or scale.shared_dir(spark) == configured
    with pytest.raises(ValueError):
        scale.bounded_rows(spark.range(5), 4, "rows")


def test_partition_independence(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("topic"), content_words("text").alias("tokens"))

    def run(rows):
        best = terms.top_tfidf_words_by_topic(terms.term_freq(rows), terms.topic_documents(rows), 20)
        return sorted(map(tuple, best.collect()))

    want = run(df)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert run(df.repartition(int(parts) + 2)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_lemmas_and_labels(spark, docs):
    lexicon = spark.createDataFrame([("z", "zed")], "form string, lemma string")
    got = as_dict(terms.lemmatize(terms.doc_terms(docs), lexicon), "term", "lemma")
    assert got == {"x": "x", "y": "y", "z": "zed"}
    assert as_dict(terms.encode_labels(docs), "doc_id", "label") == {1: 0.0, 2: 0.0, 3: 1.0, 4: 1.0}
    both = terms.union_all([docs.select("doc_id"), docs.select("doc_id")])
    assert both.count() == 8
    assert terms.hashed_term_freq(docs, 50).first().features.size == 50
