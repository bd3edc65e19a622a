"""Counts, vocabulary, TF-IDF and top-word queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import POSTINGS, TOKENS, WORD_VECTORS, WORDS, corpus, hashed_word_vectors, postings, table, tokens
from sigloom.operators import terms
from sigloom.scale import settle


def _n_docs(spark, sf):
    return corpus(spark, sf).agg(F.count(F.lit(1)).alias("n"))


def _idf_table(spark, sf):
    return terms.idf(postings(spark, sf), _n_docs(spark, sf).scalar())


def _idf(spark, sf):
    return _idf_table(spark, sf).select("term", "df", F.round("idf", 6).alias("idf"))


def _tfidf(spark, sf):
    # Texts are cut and counted once; the postings are read for the idf table and for the scores.
    rows = settle(postings(spark, sf).select("doc_id", "term", "tf"), "postings")
    scored = terms.tfidf(rows, settle(terms.idf(rows, _n_docs(spark, sf).scalar()), "idf"))
    return scored.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


def _by_topic(n, column="lang"):
    def run(spark, sf):
        docs = table(spark, sf, "documents").select("doc_id", F.col(column).alias("topic"))
        rows = postings(spark, sf)
        if column != "lang":
            rows = terms.attach(rows.drop("topic"), docs, ["doc_id"])
        best = terms.top_tfidf_words_by_topic(rows, terms.topic_documents(docs), n)
        return best.select("topic", "term", "score", "df")

    return run


def _union(spark, sf):
    frames = [_by_topic(200, c)(spark, sf).select("topic", "term", "score") for c in ("lang", "source")]
    return terms.union_all(frames).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("score"))


def _vocabulary(spark, sf):
    return terms.vocabulary(postings(spark, sf)).select("term", "n", "df")


def _selected(spark, sf):
    best = settle(_by_topic(200)(spark, sf).select(F.col("term").alias("word")).distinct(), "top-words")
    vectors = hashed_word_vectors(spark, sf, postings(spark, sf))
    chosen = terms.select_vectors(vectors, best)
    total = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v)
    return chosen.select("word", "vec_id", (F.round(total, 6) + 0.0).alias("total"))


def _distinct_top(spark, sf):
    order = [F.desc("tf"), F.asc("term")]
    return terms.distinct_top(postings(spark, sf), ["term", "tf"], order, 1000)


def _encoded(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("topic"))
    return terms.encode_labels(docs).select("doc_id", "topic", "label")


def _attached(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return terms.attach(docs, table(spark, sf, "labels"), ["doc_id"])


def _hashed(spark, sf):
    """Hashed counts: their total per document must be its number of tokens, whatever words share a bucket."""
    rows = terms.hashed_term_freq(tokens(spark, sf).select("doc_id", "tokens"), 100_000)
    # The vectors stay sparse: as an array each would have all its zeros.
    counted = F.udf(lambda v: None if v is None else (v.size, int(v.values.sum())), "buckets bigint, tokens bigint")
    return rows.select("doc_id", counted("features").alias("c")).select("doc_id", "c.buckets", "c.tokens")


QUERIES = {
    "corpus_summary": lambda spark, sf: terms.corpus_summary(tokens(spark, sf)),
    "vocabulary": _vocabulary,
    "term_freq": lambda spark, sf: postings(spark, sf),
    "term_freq_hashed": _hashed,
    "idf": _idf,
    "tfidf": _tfidf,
    "top_words": lambda spark, sf: terms.top_tfidf_words(postings(spark, sf), _n_docs(spark, sf), 1000),
    "top_words_last": lambda spark, sf: terms.top_tfidf_words(postings(spark, sf), _n_docs(spark, sf), 1000, "last"),
    "top_words_by_class": _by_topic(20),
    "top_words_by_class_10000": _by_topic(10_000),
    "union_classes": _union,
    "select_vectors": _selected,
    "distinct_top": _distinct_top,
    "encode_labels": _encoded,
    "attach_labels": _attached,
}

_N = "(SELECT count(*) FROM documents)"


def topic_words(n, column="lang"):
    return f"""
      SELECT topic, term, score, df FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS place FROM (
          SELECT d.topic, p.term, round(max(p.tf) * ln((d.n + 1) / (count(*) + 1)), 6) AS score, count(*) AS df
          FROM (SELECT s.{column} AS topic, w.term, w.tf FROM postings w JOIN documents s USING (doc_id)) p
          JOIN (SELECT {column} AS topic, count(*) AS n FROM documents GROUP BY 1) d ON d.topic = p.topic
          GROUP BY d.topic, d.n, p.term))
      WHERE place <= {n}"""


def _top_sql(tf):
    return f"""SELECT term, round({tf} * ln(({_N} + 1) / (count(*) + 1)), 6) AS score
        FROM postings GROUP BY term ORDER BY score DESC, term LIMIT 1000"""


ORACLE = {
    "corpus_summary": "WITH " + WORDS + """SELECT
        (SELECT count(*) FROM documents) AS documents, (SELECT count(DISTINCT term) FROM words) AS vocabulary,
        (SELECT count(*) FROM (SELECT DISTINCT doc_id, term FROM words)) AS doc_terms,
        (SELECT count(*) FROM words) AS tokens""",
    "vocabulary": "WITH " + POSTINGS + """SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df
        FROM postings GROUP BY term""",
    "term_freq": "WITH " + POSTINGS + "SELECT doc_id, topic, term, tf FROM postings",
    "term_freq_hashed": "WITH " + TOKENS + "SELECT doc_id, 100000 AS buckets, len(tokens) AS tokens FROM tokens",
    "idf": "WITH " + POSTINGS + f"""SELECT term, count(*) AS df, round(ln(({_N} + 1) / (count(*) + 1)), 6) AS idf
        FROM postings GROUP BY term""",
    "tfidf": "WITH " + POSTINGS + f""",
        idf AS (SELECT term, ln(({_N} + 1) / (count(*) + 1)) AS idf FROM postings GROUP BY term)
        SELECT doc_id, term, tf, round(tf * idf, 6) AS tfidf FROM postings JOIN idf USING (term)""",
    "top_words": "WITH " + POSTINGS + _top_sql("max(tf)"),
    "top_words_last": "WITH " + POSTINGS + _top_sql("arg_max(tf, doc_id)"),
    "top_words_by_class": "WITH " + POSTINGS + topic_words(20),
    "top_words_by_class_10000": "WITH " + POSTINGS + topic_words(10_000),
    "union_classes": "WITH " + POSTINGS + f"""SELECT term, count(*) AS n, max(score) AS score
        FROM ({topic_words(200)} UNION ALL {topic_words(200, 'source')}) GROUP BY term""",
    "select_vectors": "WITH " + POSTINGS + "," + WORD_VECTORS + f"""
        SELECT word, vec_id, round(list_sum(vector), 6) + 0.0 AS total FROM word_vectors
        WHERE word IN (SELECT term FROM ({topic_words(200)}))""",
    "distinct_top": "WITH " + POSTINGS + "SELECT DISTINCT term, tf FROM postings ORDER BY tf DESC, term LIMIT 1000",
    "encode_labels": """WITH ids AS (SELECT topic, CAST(row_number() OVER (ORDER BY topic) - 1 AS DOUBLE) AS label
          FROM (SELECT DISTINCT source AS topic FROM documents))
        SELECT d.doc_id, d.source AS topic, ids.label FROM documents d JOIN ids ON ids.topic = d.source""",
    "attach_labels": """SELECT doc_id, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)""",
}
