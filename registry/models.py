"""Queries that train models.  Their results depend on random starts, so most have no SQL."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from registry.common import POSTINGS, WORDS, corpus, embeddings, table, tokens
from registry.classify import ORACLE as CLASSIFY
from registry.terms import topic_words
from registry.vectors import _MAP, _MEANS, placed
from sigloom.functions.paths import key_percent
from sigloom.functions.text import let
from sigloom.operators import classify, cluster, embed, evaluate, mixture, skipgram, som, topics
from sigloom.operators.terms import term_freq
from sigloom.plans import documents
from sigloom.plans import signatures as plan
from sigloom.scale import fresh_path, settle
from sigloom.sources import tables
from sigloom.sources.corpus import split_sentences

SIZE = 100
TOP_WORDS = 10_000
GRID = (100, 100)
EPOCHS = 20
RADIUS = (30.0, 5.0)
SIGNATURES = 40
COMPONENTS = 100
TOPICS = 20
# One round of expectation maximization from a fixed start.
STEP_TOPICS, STEP_ALPHA, STEP_ETA = 5, 2.0, 1.1
ROUNDS = 1000


def word_vectors(spark, sf):
    return settle(skipgram.train_vectors(tokens(spark, sf), SIZE), "vectors")


def mean_vectors(spark, sf):
    """(doc_id, vector): the mean word vector of every document."""
    rows = term_freq(tokens(spark, sf).select("doc_id", "tokens"), keep_empty=True)
    return embed.embed(rows, word_vectors(spark, sf), ["doc_id"], SIZE)


def topic_model(spark, sf, reducer, signature, classifier, target="signature"):
    """Every query trains its own model, from the word vectors on."""
    rows = tokens(spark, sf)
    return plan.train_topic_model(
        rows, reducer, signature, classifier, target, TOP_WORDS, SIZE, GRID, EPOCHS, RADIUS,
        SIGNATURES, ROUNDS,
        vectors=word_vectors(spark, sf), words=plan.top_words_table(rows, TOP_WORDS),
    )


def _variant(*choice):
    def run(spark, sf):
        return plan.train_metrics(topic_model(spark, sf, *choice))

    return run


def _word2vec(spark, sf):
    """Documents with the length of their mean vector; the numbers follow from the training."""
    return mean_vectors(spark, sf).select("doc_id", F.size("vector").cast("bigint").alias("size"))


def _similar_words(spark, sf):
    """The ten nearest words of every top word."""
    model = topic_model(spark, sf, "som", "kmeans", "nb")
    return embed.synonyms(plan.embed_selected(model.vectors, model.words.select("word").distinct()), model.vectors, 10)


def _kmeans(spark, sf):
    vectors = embeddings(spark, sf)
    model = cluster.fit_kmeans(vectors, 10, ROUNDS)
    return cluster.model_assign(vectors, model, ["vec_id"])


def _kmeans_centers(spark, sf):
    model = cluster.fit_kmeans(embeddings(spark, sf), 10, ROUNDS)
    return cluster.centers_table(spark, cluster.center_matrix(model))


def _gmm(spark, sf):
    """The component of every vector in a mixture of a hundred, with what must hold: a component in range, a probability."""
    vectors = embeddings(spark, sf)
    placed = mixture.mixture_assign(vectors, mixture.fit_gmm(vectors, COMPONENTS), ["vec_id"])
    return placed.select("vec_id", F.col("cluster").between(0, COMPONENTS - 1).alias("known"), F.col("probability").between(0, 1).alias("share"))


def _gmm_components(spark, sf):
    """The components themselves: weight and size."""
    model = mixture.fit_gmm(embeddings(spark, sf), COMPONENTS)
    rows = [(i, float(w), [float(x) for x in m]) for i, (w, m) in enumerate(zip(model.weights, model.means, strict=True))]
    return spark.createDataFrame(rows, "component int, weight double, mean array<double>")


def gmm_start(spark, sf) -> mixture.Mixture:
    """A component for each label: its share and mean, and the overall variances."""
    vectors = embeddings(spark, sf)
    rows = embed.mean_vectors(vectors, "label").orderBy("label").collect()
    counts = np.array([r["n"] for r in rows], dtype=float)
    means = np.array([r["vector"] for r in rows])
    size = means.shape[1]
    whole, _ = mixture.mixture_step(vectors, mixture.Mixture(np.ones(1), means[:1] * 0, np.ones((1, size))), np.zeros(size))
    return mixture.Mixture(counts / counts.sum(), means, np.tile(whole.spread[0], (len(rows), 1)))


def _gmm_step(spark, sf):
    """Weights, means and variances after one round from the labels' means."""
    start = gmm_start(spark, sf)
    fresh, _ = mixture.mixture_step(embeddings(spark, sf), start, np.zeros(start.means.shape[1]))
    rows = [
        (i, d, float(fresh.weights[i]), float(fresh.means[i, d]), float(fresh.spread[i, d]))
        for i in range(len(fresh.weights)) for d in range(fresh.means.shape[1])
    ]
    table = spark.createDataFrame(rows, "component int, dim int, weight double, mean double, variance double")
    return table.select("component", "dim", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("weight", "mean", "variance")])


def _saved(spark, sf):
    """k-means saved, exported as PMML, loaded, and applied: the rows on which both models agree."""
    vectors = embeddings(spark, sf)
    model = cluster.fit_kmeans(vectors, 10, ROUNDS)
    path = fresh_path(spark, "kmeans")
    tables.save_model(model, path)
    tables.export_pmml(model, path + "-pmml")
    again = tables.load_model(spark, path)
    first = cluster.model_assign(vectors, model, ["vec_id"])
    second = cluster.model_assign(vectors, again, ["vec_id"], cluster="loaded")
    same = F.sum((F.col("cluster") == F.col("loaded")).cast("int"))
    return first.join(second, "vec_id").agg(F.count(F.lit(1)).alias("n"), same.alias("same"))


def _lda(spark, sf, optimizer, features="counts"):
    return topics.fit_lda(tokens(spark, sf).select("doc_id", "tokens"), TOPICS, optimizer, features)


def _topics(optimizer, features="counts"):
    return lambda spark, sf: topics.describe_topics(_lda(spark, sf, optimizer, features), 10)


def _topic_weights(*choice):
    def run(spark, sf):
        """Terms and total weight of each topic; the weights of a topic add up to 1."""
        matrix = topics.topic_matrix(_lda(spark, sf, *choice))
        return matrix.groupBy("topic").agg(F.count(F.lit(1)).alias("terms"), F.round(F.sum("weight"), 6).alias("weight"))

    return run


def _topic_places(*choice):
    def run(spark, sf):
        """What must hold for every line of a description: a place, a known term, weights that do not rise."""
        fitted = _lda(spark, sf, *choice)
        described = topics.describe_topics(fitted, 10)
        after = F.lead("weight").over(Window.partitionBy("topic").orderBy("rank"))
        falls = F.coalesce(F.col("weight") >= after, F.lit(True)).alias("falls")
        known = described.join(fitted.terms.select("term", "df"), "term", "left")
        return known.select("topic", "rank", F.col("df").isNotNull().alias("known"), F.col("weight").between(0, 1).alias("share"), falls)

    return run


def _em_step(spark, sf):
    """Topic weights of all terms after one round from a start that md5 draws."""
    postings, terms, documents = topics.numbered(tokens(spark, sf).select("doc_id", "tokens"), kept="term")
    seed = F.concat_ws(":", "term", "doc_id")
    raw = F.array(
        *[(F.conv(F.substring(F.md5(F.concat(seed, F.lit(f":{t}"))), 1, 4), 16, 10).cast("double") + 1) / 65536 for t in range(STEP_TOPICS)]
    )

    def shares(r):
        return F.transform(r, lambda x: x / F.aggregate(r, F.lit(0.0), lambda a, y: a + y))

    words, docs = topics.em_start(postings, STEP_TOPICS, let(raw, shares))
    weights = terms.select("term_id", "df").join(words.withColumnRenamed("s", "weight"), "term_id")
    sums = topics.vector_total(words, "s", STEP_TOPICS)
    fresh, _ = topics.em_step(postings, weights, docs, sums, STEP_ALPHA, STEP_ETA, terms.count())
    rows = fresh.join(terms.select("term_id", "term"), "term_id").select("term", F.posexplode("s").alias("topic", "weight"))
    return rows.select("term", "topic", F.round("weight", 6).alias("weight"))


def _likelihood(spark, sf):
    value = topics.avg_log_likelihood(_lda(spark, sf, "em"))
    docs = corpus(spark, sf).agg(F.count(F.lit(1)).alias("documents"))
    return docs.withColumn("avg_log_likelihood", F.lit(float(value)))


def _som_history(spark, sf):
    vectors = word_vectors(spark, sf)
    book = som.fit_som(vectors, "word", *GRID, epochs=EPOCHS, radius=RADIUS)
    return book.history_table(spark)


def _som_words(spark, sf):
    model = topic_model(spark, sf, "som", "kmeans", "nb")
    return model.words.select("word", F.col("vector")[0].alias("x"), F.col("vector")[1].alias("y"), "signature")


def _som_parts(spark, sf):
    """The words that got a signature, and whether they train or test the classifier."""
    words = topic_model(spark, sf, "som", "kmeans", "nb").words
    part = F.when(key_percent("word") < 80, "train").otherwise("test")
    inside = F.col("vector")[0].between(0, GRID[0] - 1) & F.col("vector")[1].between(0, GRID[1] - 1)
    return words.select("word", part.alias("part"), inside.alias("on_grid"))


def _tree(fit):
    def run(spark, sf):
        """Label of an embedding from its place on a small map."""
        rows = classify.labelled_points(placed(spark, sf).withColumnRenamed("label", "topic"), "topic", ["x", "y"])
        train, test = classify.key_split(rows, "vec_id", 80)
        model = fit(train.select("label", "vector"))
        return evaluate.confusion(classify.predict(test.select("vec_id", "label", "vector"), model))

    return run


def _sentences(spark, sf):
    return split_sentences(corpus(spark, sf).select("doc_id", "text"))


def _score_ranges(spark, sf):
    """Scored sentences with what must hold for each: a probability, a signature in range."""
    scored = plan.score_sentences(_sentences(spark, sf), topic_model(spark, sf, "som", "kmeans", "forest"))
    total = F.round(F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p), 6)
    return scored.select(
        "doc_id", "sent_no", "sentence", total.alias("total"), F.col("signature").between(0, SIGNATURES - 1).alias("known")
    )


def _score(*choice):
    def run(spark, sf):
        scored = plan.score_sentences(_sentences(spark, sf), topic_model(spark, sf, *choice))
        return scored.select("doc_id", "sent_no", "sentence", "signature", "prediction", "probability")

    return run


def _documents(classifier):
    def run(spark, sf):
        trained = documents.train_document_classifier(tokens(spark, sf), classifier)
        return evaluate.confusion(trained.predictions)

    return run


def _cluster_documents(spark, sf):
    """Documents clustered on their mean vectors, written as ``doc;cluster`` lines, and counted from the file."""
    rows = mean_vectors(spark, sf).select("doc_id", array_to_vector("vector").alias("features"))
    _, placed = documents.cluster_documents(rows, 5)
    path = fresh_path(spark, "document-clusters")
    tables.write_delimited(placed, path, ";")
    return cluster.cluster_sizes(tables.read_delimited(spark, path, "doc_id bigint, cluster int", ";"))


def _cluster_sentences(spark, sf):
    rows = _sentences(spark, sf)
    pipeline, kmeans = plan.fit_sentence_clusters(rows, 10, SIZE)
    path = fresh_path(spark, "pipeline")
    tables.save_model(pipeline, path)
    again = tables.load_model(spark, path)
    return plan.cluster_sentences(rows, again, kmeans).select("doc_id", "sent_no", "sentence", "cluster")


def _sizes(spark, sf):
    """Bytes of the texts, of the trained word vectors and of the signatures, with what was published beside them."""
    model = topic_model(spark, sf, "som", "kmeans", "nb")
    report = plan.signature_size_report(table(spark, sf, "documents"), model.vectors, model.words)
    published = [F.lit(x).alias(c) for c, x in (("published_of_vectors", 0.0089), ("published_of_text", 0.01))]
    return report.select(*[F.round(c, 6).alias(c) if c.startswith("of_") else c for c in report.columns], *published)


QUERIES = {
    "word2vec": _word2vec,
    "word_vectors": lambda spark, sf: word_vectors(spark, sf).select(
        "word", F.size("vector").cast("bigint").alias("size"), F.exists("vector", F.isnan).alias("broken")
    ),
    "similar_words": _similar_words,
    "kmeans_fit": _kmeans,
    "kmeans_centers": _kmeans_centers,
    "gmm": _gmm,
    "gmm_components": _gmm_components,
    "gmm_step": _gmm_step,
    "saved_model": _saved,
    "lda_em": _topics("em"),
    "lda_online": _topics("online"),
    "lda_tfidf": _topics("online", "tfidf"),
    "lda_topic_lines": lambda spark, sf: topics.topic_lines(topics.describe_topics(_lda(spark, sf, "em"))),
    "topic_matrix": lambda spark, sf: topics.topic_matrix(_lda(spark, sf, "em")),
    "topic_weights": _topic_weights("online"),
    "topic_weights_em": _topic_weights("em"),
    "topic_places_tfidf": _topic_places("online", "tfidf"),
    "topic_places_em": _topic_places("em"),
    "lda_em_step": _em_step,
    "lda_log_likelihood": _likelihood,
    "som_fit": _som_history,
    "som_words": _som_words,
    "som_word_parts": _som_parts,
    "tree": _tree(classify.fit_tree),
    "forest": _tree(classify.fit_forest),
    "bayes": _tree(classify.fit_bayes),
    "train_som_kmeans_nb": _variant("som", "kmeans", "nb"),
    "train_som_kmeans_tree": _variant("som", "kmeans", "tree"),
    "train_som_kmeans_forest": _variant("som", "kmeans", "forest"),
    "train_som_som_nb": _variant("som", "som", "nb"),
    "train_kmeans_nb": _variant("scale", "kmeans", "nb"),
    "train_gmm_nb": _variant("scale", "gmm", "nb"),
    "train_topic_target": _variant("som", "kmeans", "tree", "topic"),
    "score_sentences": _score("som", "kmeans", "nb"),
    "score_sentences_topic": _score("som", "kmeans", "tree", "topic"),
    "score_sentences_ranges": _score_ranges,
    "cluster_sentences": _cluster_sentences,
    "cluster_documents": _cluster_documents,
    "documents_nb": _documents("nb"),
    "documents_tree": _documents("tree"),
    "documents_forest": _documents("forest"),
    "signature_sizes": _sizes,
}

# Places of the embeddings on a 4 x 4 map, split by key, and naive Bayes in closed form over the two grid numbers.
_BAYES = """,
points AS (SELECT label AS c, x, y, CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS part FROM placed),
sums AS (SELECT c, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM points WHERE part < 80 GROUP BY c),
model AS (SELECT c, ln((n + 1.0) / (sum(n) OVER () + count(*) OVER ())) AS prior,
  ln((sx + 1.0) / (sx + sy + 2.0)) AS tx, ln((sy + 1.0) / (sx + sy + 2.0)) AS ty FROM sums),
guessed AS (SELECT label, prediction FROM (
  SELECT p.id, p.c AS label, m.c AS prediction,
    row_number() OVER (PARTITION BY p.id ORDER BY m.prior + p.x * m.tx + p.y * m.ty DESC, m.c) AS place
  FROM (SELECT *, row_number() OVER () AS id FROM points WHERE part >= 80) p CROSS JOIN model m) WHERE place = 1)"""

CONFUSION = CLASSIFY["confusion"]

_TOPIC_WEIGHTS = "WITH " + WORDS + f"""SELECT CAST(t AS INTEGER) AS topic,
        (SELECT count(DISTINCT term) FROM words) AS terms, 1.0::DOUBLE AS weight FROM range({TOPICS}) r(t)"""
_PLACES = f"""SELECT CAST(t AS INTEGER) AS topic, CAST(n + 1 AS INTEGER) AS rank, true AS known, true AS share, true AS falls
        FROM range({TOPICS}) r(t) CROSS JOIN range(10) s(n)"""

_LOG_DENSITY = """ln(share) - 0.5 * list_sum(list_transform(range(1, len(v.vector) + 1),
      lambda i: ln(2 * pi() * variances[i]) + (v.vector[i] - s.vector[i]) * (v.vector[i] - s.vector[i]) / variances[i]))"""

ORACLE = {
    "gmm": "SELECT vec_id, true AS known, true AS share FROM embeddings",
    "gmm_step": "WITH " + _MEANS + f""",
        spread AS (SELECT list(v ORDER BY dim) AS variances FROM (SELECT dim, var_pop(value) AS v FROM dims GROUP BY dim)),
        shares AS (SELECT label, count(*) / sum(count(*)) OVER () AS share FROM vectors GROUP BY label),
        scores AS (SELECT v.vec_id, s.label, {_LOG_DENSITY} AS score
          FROM vectors v CROSS JOIN signatures s JOIN shares ON shares.label = s.label CROSS JOIN spread),
        topped AS (SELECT vec_id, label, exp(score - max(score) OVER (PARTITION BY vec_id)) AS p FROM scores),
        held AS (SELECT vec_id, label, p / sum(p) OVER (PARTITION BY vec_id) AS r FROM topped),
        sums AS (SELECT h.label, dim, sum(r) AS n, sum(r * value) AS s, sum(r * value * value) AS q
          FROM held h JOIN dims d USING (vec_id) GROUP BY h.label, dim)
        SELECT CAST(label AS INTEGER) AS component, CAST(dim AS INTEGER) AS dim,
          round(n / (SELECT count(*) FROM vectors), 6) + 0.0 AS weight, round(s / n, 6) + 0.0 AS mean,
          round(q / n - (s / n) * (s / n), 6) + 0.0 AS variance FROM sums""",
    "word2vec": "SELECT doc_id, 100 AS size FROM documents",
    "word_vectors": "WITH " + WORDS + "SELECT DISTINCT term AS word, 100 AS size, false AS broken FROM words",
    "topic_places_tfidf": _PLACES,
    "topic_places_em": _PLACES,
    "topic_weights_em": _TOPIC_WEIGHTS,
    "lda_em_step": "WITH " + POSTINGS + f""",
        drawn AS (SELECT doc_id, term, tf, t, (CAST('0x' || substr(md5(term || ':' || doc_id || ':' || t), 1, 4) AS BIGINT) + 1) / 65536.0 AS r
          FROM postings CROSS JOIN range({STEP_TOPICS}) x(t)),
        dealt AS (SELECT doc_id, term, tf, t, tf * r / sum(r) OVER (PARTITION BY doc_id, term) AS v FROM drawn),
        by_term AS (SELECT term, t, sum(v) AS v FROM dealt GROUP BY term, t),
        by_doc AS (SELECT doc_id, t, sum(v) AS v FROM dealt GROUP BY doc_id, t),
        totals AS (SELECT t, sum(v) AS v FROM by_term GROUP BY t),
        size AS (SELECT count(DISTINCT term) AS terms FROM postings),
        shares AS (SELECT p.doc_id, p.term, p.tf, t,
            (w.v + {STEP_ETA - 1}) * (d.v + {STEP_ALPHA - 1}) / (totals.v + {STEP_ETA} * terms - terms) AS v
          FROM postings p JOIN by_term w USING (term) JOIN by_doc d USING (doc_id, t) JOIN totals USING (t) CROSS JOIN size),
        held AS (SELECT term, t, tf * v / sum(v) OVER (PARTITION BY doc_id, term) AS v FROM shares)
        SELECT term, CAST(t AS INTEGER) AS topic, round(sum(v), 6) AS weight FROM held GROUP BY term, t""",
    "topic_weights": _TOPIC_WEIGHTS,
    "som_word_parts": "WITH " + POSTINGS + f"""SELECT DISTINCT term AS word,
        CASE WHEN CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS part,
        true AS on_grid FROM ({topic_words(10000)})""",
    "score_sentences_ranges": """SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS sent_no, unnest(s) AS sentence,
        1.0::DOUBLE AS total, true AS known FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)""",
    "bayes": "WITH " + _MAP + _BAYES + """SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction,
        count(*) AS n FROM guessed GROUP BY ALL""",
    "saved_model": "SELECT count(*) AS n, count(*) AS same FROM embeddings",
    # Trained on term counts by Spark ML, it must decide as the tables of ``nb_predict`` do.
    "documents_nb": CONFUSION,
    "signature_sizes": "WITH " + POSTINGS + f""",
        sizes AS (SELECT
          (SELECT CAST(sum(octet_length(encode(text))) AS BIGINT) FROM documents) AS text_bytes,
          (SELECT CAST(sum(octet_length(encode(term)) + 8 * {SIZE}) AS BIGINT) FROM (SELECT DISTINCT term FROM words)) AS vector_bytes,
          (SELECT CAST(sum(octet_length(encode(term)) + 24) AS BIGINT) FROM (SELECT DISTINCT term FROM ({topic_words(TOP_WORDS)}))) AS signature_bytes)
        SELECT *, round(signature_bytes / vector_bytes, 6) AS of_vectors, round(signature_bytes / text_bytes, 6) AS of_text,
          0.0089::DOUBLE AS published_of_vectors, 0.01::DOUBLE AS published_of_text FROM sizes""",
}
