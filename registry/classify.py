"""Term naive Bayes, evaluation and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import POSTINGS, STOP, corpus, tokens
from sigloom.functions.paths import key_percent
from sigloom.operators import classify, evaluate, terms
from sigloom.plans import summarize as plan
from sigloom.sources.corpus import split_sentences

THRESHOLD = 0.9
PER_TOPIC = 3


def _split(spark, sf):
    part = F.when(key_percent("doc_id") < 60, "train").otherwise("test")
    return corpus(spark, sf).select("doc_id", part.alias("part"))


def _trained(spark, sf):
    """Naive Bayes trained on 60 % of the documents, and the other 40 %."""
    train, test = classify.key_split(tokens(spark, sf), "doc_id", 60)
    model = classify.fit_term_bayes(terms.term_freq(train), terms.topic_documents(train))
    return model, test


def _theta(spark, sf):
    model, _ = _trained(spark, sf)
    return classify.theta_table(model).select("topic", "term", F.round("theta", 6).alias("theta"))


def _predictions(spark, sf):
    model, test = _trained(spark, sf)
    rows = terms.term_freq(test.select("doc_id", F.col("topic").alias("label"), "tokens"), keep_empty=True)
    return classify.predict_term_bayes(rows, model, ["doc_id", "label"])


def _predict(spark, sf):
    best = F.round(F.array_max("log_scores"), 4)
    return _predictions(spark, sf).select(
        "doc_id", "label", F.col("topic").alias("prediction"), F.round("probability", 6).alias("probability"),
        best.alias("log_score"),
    )


def _labelled(spark, sf):
    return _predictions(spark, sf).select("label", F.col("topic").alias("prediction"))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


def _scored(spark, sf):
    docs = corpus(spark, sf)
    sentences = split_sentences(docs.select("doc_id", "text"))
    return plan.score_by_terms(sentences, plan.fit_topics(docs)), sentences


def _sentence_scores(spark, sf):
    scored, _ = _scored(spark, sf)
    return scored.select("doc_id", "sent_no", "topic", F.round("probability", 6).alias("probability"))


def _summary(spark, sf):
    scored, sentences = _scored(spark, sf)
    rows = plan.summarize(scored, sentences, THRESHOLD, PER_TOPIC)
    return rows.select("doc_id", "topic", "rank", "sent_no", "probability", "sentence")


def _summary_text(spark, sf):
    scored, sentences = _scored(spark, sf)
    texts = plan.summary_texts(plan.summarize(scored, sentences, THRESHOLD, PER_TOPIC))
    return texts.select("doc_id", "topic", F.col("sentences").cast("bigint").alias("sentences"), "summary")


QUERIES = {
    "key_split": _split,
    "nb_theta": _theta,
    "nb_predict": _predict,
    "accuracy": lambda spark, sf: _rounded(evaluate.accuracy(_labelled(spark, sf))),
    "confusion": lambda spark, sf: evaluate.confusion(_labelled(spark, sf)),
    "weighted_prf": lambda spark, sf: _rounded(evaluate.weighted_prf(_labelled(spark, sf))),
    "sentence_scores": _sentence_scores,
    "summarize": _summary,
    "summary_text": _summary_text,
}

_PERCENT = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100"

# Log probabilities of every term in every topic, from the training rows of ``postings``.
_MODEL = """,
docs AS (SELECT doc_id, lang AS topic, text FROM documents WHERE {train}),
train AS (SELECT p.* FROM postings p JOIN docs USING (doc_id)),
priors AS (SELECT topic, ln((count(*) + 1.0) / ((SELECT count(*) FROM docs) + (SELECT count(DISTINCT topic) FROM docs))) AS prior
  FROM docs GROUP BY topic),
vocab AS (SELECT DISTINCT term FROM train),
counts AS (SELECT topic, term, sum(tf) AS n FROM train GROUP BY topic, term),
totals AS (SELECT p.topic, coalesce(sum(c.n), 0) AS n FROM priors p LEFT JOIN counts c USING (topic) GROUP BY p.topic),
theta AS (SELECT t.topic, v.term,
    ln((coalesce(c.n, 0) + 1.0) / (t.n + (SELECT count(*) FROM vocab))) AS theta
  FROM vocab v CROSS JOIN totals t LEFT JOIN counts c ON c.topic = t.topic AND c.term = v.term)"""

_PREDICT = _MODEL.format(train=_PERCENT + " < 60") + f""",
test AS (SELECT doc_id, lang AS label FROM documents WHERE {_PERCENT} >= 60),
scores AS (SELECT d.doc_id, d.label, r.topic, any_value(r.prior) + coalesce(sum(t.theta * p.tf), 0.0) AS score
  FROM test d CROSS JOIN priors r
  LEFT JOIN postings p ON p.doc_id = d.doc_id
  LEFT JOIN theta t ON t.term = p.term AND t.topic = r.topic
  GROUP BY d.doc_id, d.label, r.topic),
best AS (SELECT doc_id, label, topic AS prediction, exp(score - top) / mass AS probability, top FROM (
  SELECT s.*, m.top, m.mass, row_number() OVER (PARTITION BY s.doc_id ORDER BY round(score, 6) DESC, topic) AS place
  FROM scores s JOIN (
    SELECT a.doc_id, any_value(b.top) AS top, sum(exp(a.score - b.top)) AS mass
    FROM scores a JOIN (SELECT doc_id, max(score) AS top FROM scores GROUP BY doc_id) b USING (doc_id) GROUP BY a.doc_id) m
  USING (doc_id)) WHERE place = 1)"""

_SCORED = _MODEL.format(train="true") + rf""",
sents AS (SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS sent_no, unnest(s) AS sentence
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
sent_terms AS (SELECT doc_id, sent_no, term, count(*) AS tf FROM (
    SELECT doc_id, sent_no, unnest(string_split_regex(lower(regexp_replace(sentence, '[^a-zA-Z\s:]', ' ', 'g')), '\s+')) AS term
    FROM sents) WHERE term <> '' AND term NOT IN ({STOP}) GROUP BY ALL),
known AS (SELECT s.doc_id, s.sent_no, t.topic, sum(t.theta * s.tf) AS score
  FROM sent_terms s JOIN theta t USING (term) GROUP BY ALL),
scores AS (SELECT s.doc_id, s.sent_no, r.topic, r.prior + coalesce(k.score, 0.0) AS score
  FROM sents s CROSS JOIN priors r
  LEFT JOIN known k ON k.doc_id = s.doc_id AND k.sent_no = s.sent_no AND k.topic = r.topic),
scored AS (SELECT doc_id, sent_no, topic, round(exp(score - top) / mass, 6) AS probability FROM (
  SELECT s.*, m.top, m.mass,
    row_number() OVER (PARTITION BY s.doc_id, s.sent_no ORDER BY round(score, 6) DESC, topic) AS place
  FROM scores s JOIN (
    SELECT a.doc_id, a.sent_no, any_value(b.top) AS top, sum(exp(a.score - b.top)) AS mass
    FROM scores a JOIN (SELECT doc_id, sent_no, max(score) AS top FROM scores GROUP BY ALL) b USING (doc_id, sent_no)
    GROUP BY a.doc_id, a.sent_no) m USING (doc_id, sent_no)) WHERE place = 1)"""

_SUMMARY = _SCORED + f""",
summary AS (SELECT doc_id, topic, CAST(place AS INTEGER) AS rank, sent_no, probability, sentence FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, topic ORDER BY probability DESC, sent_no) AS place
  FROM scored WHERE probability >= {THRESHOLD}) JOIN sents USING (doc_id, sent_no) WHERE place <= {PER_TOPIC})"""

ORACLE = {
    "key_split": f"SELECT doc_id, CASE WHEN {_PERCENT} < 60 THEN 'train' ELSE 'test' END AS part FROM documents",
    "nb_theta": "WITH " + POSTINGS + _MODEL.format(train=_PERCENT + " < 60")
    + "SELECT topic, term, round(theta, 6) AS theta FROM theta",
    "nb_predict": "WITH " + POSTINGS + _PREDICT + """
        SELECT doc_id, label, prediction, round(probability, 6) AS probability, round(top, 4) AS log_score FROM best""",
    "accuracy": "WITH " + POSTINGS + _PREDICT + """
        SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM best""",
    "confusion": "WITH " + POSTINGS + _PREDICT + "SELECT label, prediction, count(*) AS n FROM best GROUP BY ALL",
    "weighted_prf": "WITH " + POSTINGS + _PREDICT + """,
        per AS (SELECT l.label, l.support, l.hits / l.support AS r, coalesce(l.hits / nullif(p.predicted, 0), 0.0) AS p
          FROM (SELECT label, count(*) AS support, sum(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0 END) AS hits FROM best GROUP BY label) l
          LEFT JOIN (SELECT prediction, count(*) AS predicted FROM best GROUP BY prediction) p ON p.prediction = l.label)
        SELECT round(sum(p * support) / sum(support), 6) AS weighted_precision,
          round(sum(r * support) / sum(support), 6) AS weighted_recall,
          round(sum(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END * support) / sum(support), 6) AS weighted_f
        FROM per""",
    "sentence_scores": "WITH " + POSTINGS + _SCORED + "SELECT doc_id, sent_no, topic, probability FROM scored",
    "summarize": "WITH " + POSTINGS + _SUMMARY + "SELECT doc_id, topic, rank, sent_no, probability, sentence FROM summary",
    "summary_text": "WITH " + POSTINGS + _SUMMARY + """
        SELECT doc_id, topic, count(*) AS sentences, string_agg(sentence, chr(10) ORDER BY sent_no) AS summary
        FROM summary GROUP BY doc_id, topic""",
}
