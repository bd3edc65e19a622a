import math
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, MinMaxScaler, StringIndexer
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import models
from sigloom.functions.text import content_words
from sigloom.operators import classify, cluster, embed, evaluate, extract, kernel, pages, som, terms, topics, wordstage
from sigloom.plans import signatures, summarize
from sigloom.sources import corpus, tables


@pytest.fixture(scope="module")
def vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    return df.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))


@pytest.fixture(scope="module")
def docs(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df.select("doc_id", F.col("lang").alias("topic"), "text", content_words("text").alias("tokens"))


def test_kernel_against_brute_force():
    rng = np.random.default_rng(1)
    points, book = rng.normal(size=(500, 6)), rng.normal(size=(37, 6))
    book[20] = book[3]
    for norm in ("l1", "l2"):
        diff = points[:, None, :] - book[None, :, :]
        d = np.round(np.abs(diff).sum(2) if norm == "l1" else (diff**2).sum(2), 9)
        unit, dist = kernel.nearest(points, book, norm)
        assert (unit == d.argmin(1)).all() and np.allclose(dist, d.min(1), atol=1e-8)
    with pytest.raises(ValueError):
        kernel.nearest(points, book, "l3")


def test_nearest_holds_few_distances_at_once():
    """A big map is searched in blocks that fit the cache, in place; equal distances still go to the first unit."""
    rng = np.random.default_rng(2)
    points, book = rng.normal(size=(1000, 8)), rng.normal(size=(10_000, 8))
    book[9_000:] = book[:1000]
    points[:300] = book[9_000:9_300] + 1e-3
    tracemalloc.start()
    unit, dist = kernel.nearest(points, book, "l2")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    d = np.round(np.maximum((points**2).sum(1)[:, None] + (book**2).sum(1)[None, :] - 2 * points @ book.T, 0), 9)
    assert (unit == d.argmin(1)).all() and np.allclose(dist, d.min(1), atol=2e-9) and (unit[:300] < 1000).any()
    assert peak < 24 << 20


def test_kmeans_against_spark(spark, vectors):
    model = cluster.fit_kmeans(vectors, 5, 20)
    centers = cluster.center_matrix(model)
    ours = cluster.kmeans_assign(vectors, centers, ["vec_id"])
    theirs = cluster.model_assign(vectors, model, ["vec_id"], cluster="c")
    assert ours.join(theirs, "vec_id").filter("cluster != c").count() == 0
    assert cluster.wssse(ours).first()[0] == pytest.approx(model.summary.trainingCost, rel=1e-3)
    before = cluster.wssse(ours).first()[0]
    after = cluster.kmeans_assign(vectors, cluster.kmeans_step(vectors, centers), ["vec_id"])
    assert cluster.wssse(after).first()[0] <= before + 1e-9


def test_map_error_falls_and_units_are_in_range(vectors):
    book = som.fit_som(vectors, "vec_id", 6, 5, epochs=6, radius=(1.0, 1.0))
    errors = [h[3] for h in book.history]
    assert all(b <= a + 1e-9 for a, b in zip(errors, errors[1:]))
    placed = som.som_assign(vectors, book, ["vec_id"])
    assert placed.count() == vectors.count()
    assert placed.filter("unit != x * 5 + y or x < 0 or x > 5 or y < 0 or y > 4").count() == 0


def test_smoothing_against_the_full_sum():
    rng = np.random.default_rng(2)
    book = som.Codebook(3, 4, rng.normal(size=(12, 2)))
    counts, sums = rng.integers(0, 5, 12), rng.normal(size=(12, 2))
    x, y = np.divmod(np.arange(12), 4)
    h = np.exp(-((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2) / (2 * 1.3**2))
    want = (h @ sums) / (h @ counts)[:, None]
    assert np.allclose(som.smooth(book, counts, sums, 1.3), want)
    half = som.smooth(book, counts, sums, 1.3, 0.5)
    assert np.allclose(half, (book.weights + want) / 2)


def test_decay():
    assert som.decay(0, 10, 0.8, 0.003) == 0.8 and som.decay(9, 10, 0.8, 0.003) == 0.003
    assert som.decay(99, 10, 30, 5) == 5 and som.decay(0, 1, 30, 5) == 30


def test_similar_words_of_every_top_word(spark, monkeypatch):
    rows = [(f"w{i}", [float(i), float(i * i % 7), 1.0]) for i in range(30)]
    vectors = spark.createDataFrame(rows, "word string, vector array<double>")
    words = vectors.filter("word <> 'w3'").selectExpr("word", "length(word) as signature")
    model = SimpleNamespace(vectors=vectors, words=words.union(words))
    monkeypatch.setattr(models, "topic_model", lambda *_: model)
    got = [r["query"] for r in models.QUERIES["similar_words"](spark, "").collect()]
    assert sorted(got) == sorted([w for w, _ in rows if w != "w3"] * 10)


def test_synonyms_merge_what_they_find_seldom(spark, monkeypatch):
    """Many blocks of words: all neighbours, ties by name, though found rows are merged a few times only."""
    rng = np.random.default_rng(3)
    names = [f"w{i:04d}" for i in rng.permutation(600)]
    matrix = np.round(rng.normal(size=(600, 4)), 1)
    matrix[300:360] = matrix[:60]
    rows = [(n, [float(x) for x in v]) for n, v in zip(names, matrix, strict=True)]
    kind = "word string, vector array<double>"
    merges = []
    monkeypatch.setattr(embed, "_PRODUCT", 1)
    monkeypatch.setattr(embed, "_MERGED", 3000)
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: (merges.append(1), lexsort(keys))[1])
    asked = sorted(rows)[:40]
    run = embed._neighbours(spark, [Row(*r) for r in asked], 5, "word", T.StringType())
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=["word", "_v"])
    got = {}
    for out in run(iter([batch])):
        for r in out.to_pylist():
            got.setdefault(r["query"], []).append((r["word"], r["similarity"]))
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    for name, v in asked:
        cosine = np.round(unit @ (np.array(v) / np.linalg.norm(v)), 6)
        want = sorted(((n, float(c)) for n, c in zip(names, cosine, strict=True) if n != name), key=lambda x: (-x[1], x[0]))[:5]
        assert [x[0] for x in got[name]] == [x[0] for x in want]
        assert all(abs(a[1] - b[1]) < 2e-6 for a, b in zip(got[name], want, strict=True))
    assert len(merges) <= 3


def test_synonyms_against_brute_force(spark, vectors):
    rows = sorted((r.vec_id, np.array(r.vector)) for r in vectors.collect())
    queries = vectors.filter("vec_id in (3, 77, 140)")
    got = {(r["query"], r["rank"]): r.vec_id for r in embed.synonyms(queries, vectors.repartition(7), 5, "vec_id").collect()}
    for q in (3, 77, 140):
        base = dict(rows)[q]
        ranked = sorted((-round(float(base @ v / np.linalg.norm(base) / np.linalg.norm(v)), 6), i) for i, v in rows if i != q)
        assert [got[q, r + 1] for r in range(5)] == [i for _, i in ranked[:5]]


def test_min_max_against_spark(vectors):
    small = cluster.with_features(vectors)
    scaler = MinMaxScaler(inputCol="features", outputCol="s").fit(small)
    ours = embed.min_max_scale(vectors, *embed.fit_min_max(vectors)).orderBy("vec_id").collect()
    theirs = scaler.transform(small).orderBy("vec_id").collect()
    assert all(np.allclose(a.vector, b.s.toArray()) for a, b in zip(ours, theirs))


def test_mean_vector_against_word2vec(spark):
    rows = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, [])]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    model = embed.fit_word2vec(df, 8)
    asked = spark.createDataFrame([(1, ["a", "unknown"]), (2, ["c", "b", "b"]), (3, [])], df.schema)
    got = embed.embed(terms.term_freq(asked, keep_empty=True), embed.word_vectors(model), ["doc_id"], 8)
    want = {r.doc_id: r.vector.toArray() for r in model.transform(asked).collect()}
    for r in got.collect():
        assert np.allclose(r.vector, want[r.doc_id], atol=1e-6)


def test_term_bayes_against_spark(spark, docs):
    counter = CountVectorizer(inputCol="tokens", outputCol="features").fit(docs)
    indexed = StringIndexer(inputCol="topic", outputCol="label", stringOrderType="alphabetAsc").fit(docs).transform(docs)
    model = NaiveBayes(smoothing=1.0).fit(counter.transform(indexed))
    ours = classify.fit_term_bayes(terms.term_freq(docs), terms.topic_documents(docs))
    assert np.allclose(ours.priors, model.pi.toArray())
    theta, place = model.theta.toArray(), {t: i for i, t in enumerate(counter.vocabulary)}
    for r in ours.table.limit(500).collect():
        assert np.allclose(r.theta, theta[:, place[r.term]])
    rows = terms.term_freq(docs.select("doc_id", "tokens"), keep_empty=True)
    got = {r.doc_id: (r.topic, r.probability) for r in classify.predict_term_bayes(rows, ours, ["doc_id"]).collect()}
    for r in model.transform(counter.transform(indexed)).collect():
        assert got[r.doc_id][0] == ours.topics[int(r.prediction)]
        assert got[r.doc_id][1] == pytest.approx(max(r.probability), abs=1e-6)


def test_spread_scores_equal_broadcast_scores(docs, monkeypatch):
    rows = terms.term_freq(docs.select("doc_id", "tokens"), keep_empty=True)
    model = classify.fit_term_bayes(terms.term_freq(docs), terms.topic_documents(docs))

    def run():
        scored = classify.predict_term_bayes(rows, model, ["doc_id"])
        return sorted((r.doc_id, r.topic, round(r.probability, 9)) for r in scored.collect())

    want = run()
    monkeypatch.setattr("sigloom.scale.BROADCAST_ROWS", 0)
    assert run() == want


def test_metrics_against_spark(spark):
    rows = [(float(i % 4), float((i * i) % 5 % 4)) for i in range(200)] + [(7.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = evaluate.weighted_prf(df).first()
    for name, value in zip(("weightedPrecision", "weightedRecall", "f1"), got):
        assert value == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df))
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert evaluate.accuracy(df).first()[0] == pytest.approx(accuracy)


def test_lda_tables(spark, docs):
    fitted = topics.fit_lda(docs.select("doc_id", "tokens"), 3, "online", vocab_size=200, max_iter=2)
    weights = topics.topic_matrix(fitted).groupBy("topic").agg(F.sum("weight").alias("w")).collect()
    assert len(weights) == 3 and all(r.w == pytest.approx(1) for r in weights)
    assert topics.topic_lines(topics.describe_topics(fitted, 2)).first().value.startswith("TOPIC_")
    assert np.isfinite(topics.avg_log_likelihood(fitted))
    with pytest.raises(ValueError):
        topics.fit_lda(docs, 3, "other")


@pytest.mark.parametrize("choice", [("som", "kmeans", "nb", "signature"), ("scale", "kmeans", "forest", "signature"), ("som", "som", "tree", "topic")])
def test_train_and_score(spark, docs, choice):
    trained = signatures.train_topic_model(
        docs, *choice, top_words=100, size=12, grid=(6, 6), epochs=3, radius=(2.0, 1.0), signatures=5, max_iter=5
    )
    row = signatures.train_metrics(trained).first()
    assert all(0 <= v <= 1 for v in row)
    lines = corpus.split_sentences(docs.select("doc_id", "text"))
    scored = signatures.score_sentences(lines, trained)
    assert scored.count() == lines.count()
    assert scored.filter("abs(aggregate(probabilities, 0D, (a, p) -> a + p) - 1) > 1e-6").count() == 0


def test_unknown_variant(docs):
    with pytest.raises(ValueError):
        signatures.train_topic_model(docs, "other")


def test_summaries(spark, docs):
    lines = corpus.split_sentences(docs.select("doc_id", "text"))
    scored = summarize.score_by_terms(lines, summarize.fit_topics(docs))
    assert scored.count() == lines.count()
    every = summarize.summarize(scored, lines, 0.5)
    top = summarize.summarize(scored, lines, 0.5, 2)
    assert top.count() < every.count() and every.filter("probability < 0.5").count() == 0
    assert summarize.summary_texts(top).agg(F.max("sentences")).first()[0] == 2
    with pytest.raises(ValueError):
        summarize.summary_texts(every)


def test_extraction(spark):
    words = spark.createDataFrame(
        [(1, 0, "2016-07-24"), (1, 1, "12:30"), (1, 2, "5%"), (1, 3, "$3.50"), (1, 4, "1st"), (1, 5, "1,000"), (1, 6, "Rome"), (1, 7, "x1")],
        "doc_id bigint, pos int, word string",
    )
    places = spark.createDataFrame([("Rome", "LOCATION")], "word string, tag string")
    tagged = extract.tag_entities(words, places)
    got = [r.tag for r in tagged.orderBy("pos").collect()]
    assert got == ["DATE", "TIME", "PERCENT", "MONEY", "ORDINAL", "NUMBER", "LOCATION", "O"]

    def plug_in(batches):
        for batch in batches:
            yield batch.assign(_guess=batch["word"].str.len().astype(str))

    assert extract.tag_entities(words, places, tagger=plug_in).filter("tag = '10'").count() == 1
    domain = spark.createDataFrame([("x1",)], "word string")
    assert extract.domain_override(tagged, domain, "Sports").filter("tag = 'Sports'").count() == 1
    sentence = spark.createDataFrame([(1, "rain is wet and snow was cold")], "id bigint, sentence string")
    found = [(r.subject, r.relation, r.object) for r in extract.extract_triples(sentence, ["is", "was"]).collect()]
    assert found == [("rain", "is", "wet"), ("snow", "was", "cold")]


def test_redirects(spark):
    rows = [("A", "text a"), ("B", "#REDIRECT [[a]]"), ("C", "#redirect [[missing]]"), ("D", "#REDIRECT [[B]]")]
    got = {r.title: r.text for r in pages.resolve_redirects(spark.createDataFrame(rows, "title string, text string")).collect()}
    assert got == {"A": "text a", "B": "text a", "C": "", "D": "#REDIRECT [[a]]"}


def test_files(spark, tmp_path):
    for topic, name, body in (("golf", "1.txt", "one\ntwo"), ("golf", "2.txt", "x"), ("chess", "1.txt", "y")):
        (tmp_path / "in" / topic).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / topic / name).write_text(body)
    read = corpus.with_topic(corpus.read_corpus(spark, str(tmp_path / "in")))
    assert {(r.topic, r.doc_key, r.text) for r in read.collect()} == {
        ("golf", "golf/1.txt", "one\ntwo"), ("golf", "golf/2.txt", "x"), ("chess", "chess/1.txt", "y")}
    assert {r.topic for r in corpus.topics(read).collect()} == {"golf", "chess"}
    both = corpus.read_corpus(spark, f"{tmp_path}/in/golf,{tmp_path}/in/chess")
    assert both.count() == 3
    assert corpus.read_lines(spark, f"{tmp_path}/in/golf/1.txt").count() == 2

    df = spark.createDataFrame([("w", 1, None), ("v", 2, 0.5)], "a string, b int, c double")
    tables.write_delimited(df, str(tmp_path / "tsv"))
    back = tables.read_delimited(spark, str(tmp_path / "tsv"), "a string, b int")
    assert {tuple(r) for r in back.collect()} == {("w", 1), ("v", 2)}


def test_saved_pipeline(spark, docs, tmp_path):
    lines = corpus.split_sentences(docs.select("doc_id", "text")).filter("sent_no < 3")
    pipeline, kmeans = signatures.fit_sentence_clusters(lines, 3, 8, 3)
    tables.save_model(pipeline, str(tmp_path / "p"))
    tables.save_model(kmeans, str(tmp_path / "k"))
    first = signatures.cluster_sentences(lines, pipeline, kmeans)
    again = signatures.cluster_sentences(lines, tables.load_model(spark, str(tmp_path / "p")), tables.load_model(spark, str(tmp_path / "k")))
    key = ["doc_id", "sent_no"]
    assert first.join(again.withColumnRenamed("cluster", "c"), key).filter("cluster != c").count() == 0
    tables.export_pmml(kmeans, str(tmp_path / "m"))


def test_word_vectors_of_a_pipeline_are_a_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wordstage, "_ADDED", 3)
    rows = [(1, "a b b", ["a", "b", "b"]), (1, "a b b", ["a", "b", "b"]), (None, None, None), (2, "", []), (3, "z", ["z", "a"])]
    df = spark.createDataFrame(rows, "id long, sentence string, tokens array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 8.0])], "word string, vector array<double>")
    model = wordstage.WordVectorsModel(vectors)._set(inputCol="tokens", outputCol="f", vectorSize=2)
    tables.save_model(PipelineModel([model]), str(tmp_path / "w"))
    for fitted in (model, tables.load_model(spark, str(tmp_path / "w"))):
        got = fitted.transform(df)
        assert got.columns == ["id", "sentence", "tokens", "f"]
        found = sorted((r.id or 0, r.sentence, list(r.f)) for r in got.collect())
        assert found == [(0, None, [0, 0]), (1, "a b b", [3, 6]), (1, "a b b", [3, 6]), (2, "", [0, 0]), (3, "z", [0.5, 1])]
    lines = spark.createDataFrame([(i, f"x{i % 7} y{i % 5} x{i % 3}") for i in range(60)], "id long, sentence string")
    pipeline, _ = signatures.fit_sentence_clusters(lines, 2, 4, 3)
    # The words are rows, not a model of Spark ML that holds them on the driver.
    assert {r.word for r in pipeline.stages[-1].vectors.collect()} == {*(f"x{i}" for i in range(7)), *(f"y{i}" for i in range(5))}


def test_key_split_is_stable(docs):
    train, test = classify.key_split(docs, "doc_id", 60)
    again, _ = classify.key_split(docs.repartition(5), "doc_id", 60)
    assert {r.doc_id for r in train.collect()} == {r.doc_id for r in again.collect()}
    assert train.count() + test.count() == docs.count()


def test_wiki_dump(spark, tmp_path):
    dump = (
        '<mediawiki xml:lang="en"><siteinfo><sitename>W</sitename></siteinfo>\n'
        "<page>\n <title>A &amp; B</title><id>1</id>\n <revision><text xml:space=\"preserve\">one\n&lt;ref&gt;two &amp;amp; it&apos;s</text></revision>\n</page>\n"
        "<page><title>Empty</title><revision><text bytes=\"0\" /></revision></page>\n</mediawiki>\n"
    )
    (tmp_path / "d.xml").write_text(dump)
    got = {(r.title, r.text) for r in tables.read_wiki_dump(spark, str(tmp_path / "d.xml")).collect()}
    assert got == {("A & B", "one\n<ref>two &amp; it's"), ("Empty", "")}
    rows = spark.createDataFrame([(f"t{i}", f"x < {i} & \"y\" 'z'\nline {'w ' * 300}") for i in range(200)], "title string, text string")
    tables.write_wiki_dump(rows.coalesce(1), str(tmp_path / "out"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        back = tables.read_wiki_dump(spark, str(tmp_path / "out"))
        assert back.rdd.getNumPartitions() > 5
        assert {(r.title, r.text.strip()) for r in back.collect()} == {(r.title, r.text.strip()) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_initial_codebook_is_the_smallest_hashes(spark, vectors):
    import hashlib

    ids = sorted((r.vec_id for r in vectors.collect()), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    by_id = {r.vec_id: r.vector for r in vectors.collect()}
    book = som.initial_codebook(vectors.repartition(3), 2, 3, "vec_id")
    assert np.allclose(book.weights, [by_id[i] for i in ids[:6]])
    few = vectors.filter("vec_id < 4")
    assert som.initial_codebook(few, 2, 3, "vec_id").weights.shape == (6, 64)


def test_packed_codebook(spark, tmp_path):
    book = som.Codebook(2, 3, np.arange(24.0).reshape(6, 4) / 7)
    som.write_packed_codebook(book, spark, str(tmp_path / "w"))
    back = som.read_packed_codebook(spark, str(tmp_path / "w"), 2, 3)
    assert (back.weights == book.weights).all()


def test_document_classifiers(docs):
    from sigloom.plans import documents

    for kind in ("nb", "tree", "forest"):
        found = documents.train_document_classifier(docs, kind, 60, 500)
        assert evaluate.accuracy(found.predictions).first()[0] > 0.5
    with pytest.raises(ValueError):
        documents.train_document_classifier(docs, "other")


def test_vectors_of_another_length_are_refused(spark):
    book = np.zeros((2, 2))
    for vectors in ([[1.0, 1.0, 1.0], [0.0]], [[1.0, 1.0], None], [[], [0.0, 0.0]]):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
        with pytest.raises(Exception, match="none may be null"):
            kernel.assign(rows, ["id"], "vector", book).collect()


def test_initial_codebook_with_null_keys(spark):
    rows = spark.createDataFrame([(None, [1.0]), ("a", [2.0]), ("b", None)], "key string, vector array<double>")
    book = som.initial_codebook(rows, 2, 1, "key")
    assert book.weights.tolist() == [[2.0], [2.0]]


def test_delimited_files_keep_any_text(spark, tmp_path):
    words = ["plain", "tab\there", "line\nbreak", 'quote "x"', "", None, "\\", " a ", "é,;", "\\N x"]
    rows = [(w, i, None if i % 3 else i / 2) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "word string, n int, x double")
    for sep in ("\t", ";"):
        path = str(tmp_path / f"sep{ord(sep)}")
        tables.write_delimited(df, path, sep)
        back = tables.read_delimited(spark, path, "word string, n int, x decimal(10,2)", sep).collect()
        assert sorted((r.n, r.word) for r in back) == [(i, w) for i, w in enumerate(words)]


def test_new_text_with_a_saved_idf(spark, tmp_path):
    known = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (2, "b", 1)], "doc_id bigint, term string, tf bigint")
    count = F.lit(2)
    terms.write_idf(terms.idf(known, count), count, str(tmp_path / "idf"))
    new = spark.createDataFrame([(9, "b", 2), (9, "c", 1)], "doc_id bigint, term string, tf bigint")
    got = {r.term: r.tfidf for r in terms.tfidf_of_new(new, str(tmp_path / "idf")).collect()}
    assert got == pytest.approx({"b": 2 * math.log(3 / 2), "c": math.log(3)})


def test_codebook_files(spark, tmp_path):
    book = som.Codebook(2, 3, np.arange(-12.0, 12.0).reshape(6, 4) / 7)
    tables.write_codebook(book.to_table(spark), str(tmp_path / "c"))
    back = som.codebook_from_table(tables.read_codebook(spark, str(tmp_path / "c")))
    assert (back.width, back.height) == (2, 3) and (back.weights == book.weights).all()
    lines = [r.value for r in spark.read.text(str(tmp_path / "c")).collect()]
    assert all('"' not in line and len(line.split(" ")) == 7 for line in lines)


def test_null_marks_as_text(spark, tmp_path):
    words = ["\\N", "\\\\N", "\\\\\\N", None, "\\", "N", "\\n", "x\\N", "\\N\n", ""]
    df = spark.createDataFrame(list(enumerate(words)), "n int, word string")
    tables.write_delimited(df, str(tmp_path / "t"))
    back = tables.read_delimited(spark, str(tmp_path / "t"), "n int, word string")
    assert [r.word for r in sorted(back.collect())] == words


def test_pmml_holds_the_centres(spark, vectors, tmp_path):
    import xml.etree.ElementTree as tree

    model = cluster.fit_kmeans(vectors, 3, 5)
    tables.export_pmml(model, str(tmp_path / "m"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "m")).collect())
    arrays = [x.text.split() for x in tree.fromstring(text).iter() if x.tag.endswith("}Array")]
    assert np.allclose(np.array(arrays, dtype=float), cluster.center_matrix(model))
