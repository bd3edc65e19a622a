"""Train topic signatures and a classifier, and score sentences with them."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions.text import content_words
from sigloom.operators.lemmas import lemma_tokens
from sigloom.operators import classify, cluster, embed, evaluate, mixture, skipgram, som, terms
from sigloom.operators.wordstage import WordVectors
from sigloom.scale import bounded_rows, settle, top_per_group
from sigloom.sources import tables


@dataclass
class TopicSignatures:
    """Everything needed to score new sentences."""

    vectors: DataFrame
    size: int
    reducer: str
    signature: str
    target: str
    codebook: som.Codebook | None
    bounds: tuple[list[float], list[float]] | None
    signer: Any
    classifier: Any
    labels: list = field(default_factory=list)
    words: DataFrame | None = None
    predictions: DataFrame | None = None


def _reduce(df: DataFrame, model: TopicSignatures, keys: list[str]) -> DataFrame:
    """(keys…, vector): grid place of each vector, or the scaled vector itself."""
    if model.reducer == "som":
        placed = som.som_assign(df, model.codebook, keys)
        return placed.select(*keys, F.array(F.col("x").cast("double"), F.col("y").cast("double")).alias("vector"))
    return embed.min_max_scale(df.select(*keys, "vector"), *model.bounds)


def _sign(df: DataFrame, model: TopicSignatures, keys: list[str]) -> DataFrame:
    """(keys…, vector, signature) without a join: the reduced vector travels along as a key."""
    carried = [*keys, "vector"]
    if model.signature == "gmm":
        return mixture.mixture_assign(df.withColumn("_v", F.col("vector")), model.signer, carried, "_v", "signature").drop("probability")
    wide = df.withColumn("_v", F.col("vector"))
    weights = model.signer.weights if model.signature == "som" else cluster.center_matrix(model.signer)
    return cluster.kmeans_assign(wide, weights, carried, "_v", "signature").drop("dist")


def train_topic_model(
    docs: DataFrame,
    reducer: str = "som",
    signature: str = "kmeans",
    classifier: str = "nb",
    target: str = "signature",
    top_words: int = 10_000,
    size: int = 100,
    grid: tuple[int, int] = (100, 100),
    epochs: int = 20,
    radius: tuple[float, float] = (30.0, 5.0),
    signatures: int = 40,
    max_iter: int = 1000,
    train_percent: int = 80,
    seed: int = 11,
    min_count: int = 0,
    vectors: DataFrame | None = None,
    words: DataFrame | None = None,
    lemmas: DataFrame | None = None,
) -> TopicSignatures:
    """One job for all variants, from (doc_id, topic, tokens) rows.

    reducer     som: grid places of a self-organizing map; scale: min-max scaled word vectors
    signature   kmeans, som (a 1 x n map) or gmm over the reduced vectors
    classifier  nb, tree or forest, from the reduced vector to the target
    target      signature: the signature id; topic: the topic in which the word scores best
    vectors     (word, vector) table to use instead of training Word2Vec
    words       settled (topic, word, score) table to use instead of the best TF-IDF words of each topic
    lemmas      (term, lemma) rows that take the place of the tokens first
    """
    for value, known in ((reducer, ("som", "scale")), (signature, ("kmeans", "som", "gmm")),
                         (classifier, ("nb", "tree", "forest")), (target, ("signature", "topic"))):
        if value not in known:
            raise ValueError(f"{value} is not one of {', '.join(known)}")
    if lemmas is not None:
        docs = settle(lemma_tokens(docs.select("doc_id", "topic", "tokens"), lemmas, ["doc_id", "topic"]), "lemma-tokens")
    best = top_words_table(docs, top_words) if words is None else words
    if vectors is None:
        vectors = settle(skipgram.train_vectors(docs, size, min_count, seed), "vectors")
    size = embed.vector_size(vectors)
    selected = settle(embed_selected(vectors, best), "selected")

    model = TopicSignatures(vectors, size, reducer, signature, target, None, None, None, None)
    if reducer == "som":
        model.codebook = som.fit_som(selected, "word", *grid, epochs=epochs, radius=radius)
    else:
        model.bounds = embed.fit_min_max(selected)
    reduced = settle(_reduce(selected, model, ["word"]), "reduced")
    if signature == "kmeans":
        model.signer = cluster.fit_kmeans(reduced, signatures, max_iter, seed)
    elif signature == "gmm":
        model.signer = mixture.fit_gmm(reduced, signatures, min(max_iter, 100), seed)
    else:
        model.signer = som.fit_som(reduced, "word", 1, signatures, epochs=epochs, radius=(signatures / 4, 1.0))
    signed = _sign(reduced, model, ["word"])
    if target == "topic":
        owner = top_per_group(best, ["word"], [F.desc("score"), F.asc("topic")], 1, ["topic"]).select("word", "topic")
        signed = terms.encode_labels(signed.join(owner, "word"), "topic", "label")
        model.labels = terms.distinct_labels(best, "topic")
    else:
        signed = signed.withColumn("label", F.col("signature").cast("double"))
    model.words = settle(signed, "signatures")
    train, test = classify.key_split(model.words, "word", train_percent)
    fit = {"nb": classify.fit_bayes, "tree": classify.fit_tree, "forest": classify.fit_forest}[classifier]
    model.classifier = fit(train)
    model.predictions = classify.predict(test, model.classifier)
    return model


def top_words_table(docs: DataFrame, n: int = 10_000) -> DataFrame:
    """Settled table (topic, rank, word, score, df) of the best TF-IDF words of each topic."""
    postings = terms.term_freq(docs.select("doc_id", "topic", "tokens"))
    best = terms.top_tfidf_words_by_topic(postings, terms.topic_documents(docs), n)
    return settle(best.withColumnRenamed("term", "word"), "top-words")


def embed_selected(vectors: DataFrame, words: DataFrame) -> DataFrame:
    """Vectors of the chosen words."""
    return terms.select_vectors(vectors, words)


def train_metrics(model: TopicSignatures) -> DataFrame:
    """Accuracy and weighted precision, recall and F-measure on the test words, in one row."""
    rows = model.predictions.select("label", "prediction")
    share = evaluate.accuracy(rows)
    prf = evaluate.weighted_prf(rows)
    return prf.select(share.scalar().alias("accuracy"), "*")


def score_sentences(
    sentences: DataFrame, model: TopicSignatures, keys: tuple[str, ...] = ("doc_id", "sent_no"), lemmas: DataFrame | None = None
) -> DataFrame:
    """(keys…, sentence, vector, signature, prediction, probability, probabilities) for (keys…, sentence) rows.

    ``lemmas``: (term, lemma) rows, as the model was trained with; without them words stay as they are.
    """
    keys = list(keys)
    tokens = sentences.select(*keys, content_words("sentence").alias("tokens"))
    if lemmas is not None:
        tokens = lemma_tokens(tokens, lemmas, keys)
    postings = terms.term_freq(tokens, keep_empty=True)
    means = embed.embed(postings, model.vectors, keys, model.size)
    signed = _sign(_reduce(means, model, keys), model, keys)
    scored = classify.predict(signed, model.classifier)
    scored = scored.withColumn("probability", F.array_max("probabilities"))
    return terms.attach(scored, sentences.select(*keys, "sentence"), keys)


def score_by_signatures(sentences: DataFrame, model: TopicSignatures) -> DataFrame:
    """(doc_id, sent_no, topic, probability): the topic that the signature path gives each sentence, for ``summarize``."""
    if model.target != "topic":
        raise ValueError("topics need a model with the target 'topic'")
    scored = score_sentences(sentences, model)
    names = F.array(*[F.lit(t) for t in model.labels])
    return scored.select("doc_id", "sent_no", F.get(names, F.col("prediction").cast("int")).alias("topic"), "probability")


def save_topic_model(model: TopicSignatures, path: str) -> None:
    """Vectors, words, map, signatures and classifier as one folder."""
    spark = model.vectors.sparkSession
    model.vectors.write.parquet(f"{path}/vectors")
    model.words.write.parquet(f"{path}/words")
    settings = {
        "size": model.size, "reducer": model.reducer, "signature": model.signature, "target": model.target,
        "labels": model.labels, "bounds": model.bounds,
        "grid": [model.codebook.width, model.codebook.height] if model.codebook else None,
        "signer_grid": [model.signer.width, model.signer.height] if model.signature == "som" else None,
    }
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.text(f"{path}/settings")
    for name, book in (("codebook", model.codebook), ("signer", model.signer)):
        if isinstance(book, som.Codebook):
            book.to_table(spark).write.parquet(f"{path}/{name}")
    if model.signature == "gmm":
        mixture.save_mixture(model.signer, spark, f"{path}/signer")
    elif model.signature != "som":
        tables.save_model(model.signer, f"{path}/signer")
    tables.save_model(model.classifier, f"{path}/classifier")


def load_topic_model(spark: SparkSession, path: str) -> TopicSignatures:
    """What ``save_topic_model`` wrote, ready to score sentences; test predictions are not kept."""
    settings = json.loads(spark.read.text(f"{path}/settings").first()[0])

    def book(name: str, grid: list[int]) -> som.Codebook:
        rows = bounded_rows(spark.read.parquet(f"{path}/{name}").select("unit", "weight"), grid[0] * grid[1], name)
        return som.Codebook(*grid, np.array([r["weight"] for r in sorted(rows)]))

    if settings["signature"] == "som":
        signer = book("signer", settings["signer_grid"])
    else:
        signer = (mixture.load_mixture if settings["signature"] == "gmm" else tables.load_model)(spark, f"{path}/signer")
    return TopicSignatures(
        spark.read.parquet(f"{path}/vectors"),
        settings["size"],
        settings["reducer"],
        settings["signature"],
        settings["target"],
        book("codebook", settings["grid"]) if settings["grid"] else None,
        tuple(settings["bounds"]) if settings["bounds"] else None,
        signer,
        tables.load_model(spark, f"{path}/classifier"),
        settings["labels"],
        spark.read.parquet(f"{path}/words"),
    )


def fit_sentence_clusters(
    sentences: DataFrame, k: int = 10, size: int = 100, max_iter: int = 20, seed: int = 11
) -> tuple[PipelineModel, KMeansModel]:
    """Tokenizer, stop words and word vectors, which stay a table, as one pipeline, and k-means over its vectors."""
    pipeline = Pipeline(stages=[
        RegexTokenizer(inputCol="sentence", outputCol="raw", pattern=r"\s+", minTokenLength=1),
        StopWordsRemover(inputCol="raw", outputCol="tokens"),
        WordVectors(inputCol="tokens", outputCol="features", vectorSize=size, seed=seed),
    ])
    fitted = pipeline.fit(sentences)
    vectors = fitted.transform(sentences).select("features")
    return fitted, KMeans(k=k, maxIter=max_iter, seed=seed).fit(vectors)


def cluster_sentences(sentences: DataFrame, pipeline: PipelineModel, kmeans: KMeansModel) -> DataFrame:
    """Add the ``cluster`` of each sentence by a saved pipeline and k-means model."""
    placed = kmeans.transform(pipeline.transform(sentences))
    return placed.select(*sentences.columns, F.col("prediction").alias("cluster"))


def signature_size_report(docs: DataFrame, vectors: DataFrame, words: DataFrame) -> DataFrame:
    """Bytes of raw text, of word vectors and of signature rows, and the two reduction ratios.

    A number counts 8 bytes, a word its UTF-8 bytes; a signature row is a word,
    two grid coordinates and a signature id.
    """
    text = docs.agg(F.sum(F.octet_length("text"))).scalar()
    vector = vectors.agg(F.sum(F.octet_length("word") + F.size("vector") * 8)).scalar()
    signature = words.agg(F.sum(F.octet_length("word") + F.lit(3 * 8)).alias("signature_bytes"))
    sized = signature.select(text.alias("text_bytes"), vector.alias("vector_bytes"), "signature_bytes")
    return sized.select(
        "*",
        (F.col("signature_bytes") / F.col("vector_bytes")).alias("of_vectors"),
        (F.col("signature_bytes") / F.col("text_bytes")).alias("of_text"),
    )
