"""Terms: counts, vocabulary, IDF, TF-IDF and top words.

Documents come as (doc_id, topic, tokens); a document is one row, so its term
counts are made inside the row and the corpus is not shuffled for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions.text import strip_plural
from sigloom.scale import bounded_rows, name_digits, score_digits, sized_join, spread_join, top_n, top_per_group

MAX_TOPICS = 10_000


def doc_terms(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row (…, pos, term) per token."""
    kept = [c for c in df.columns if c != tokens]
    return df.select(*kept, F.posexplode(tokens).alias("pos", "term"))


def distinct_terms(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """The distinct terms of the corpus."""
    return df.select(F.explode(tokens).alias("term")).distinct()


def term_freq(df: DataFrame, tokens: str = "tokens", keep_empty: bool = False) -> DataFrame:
    """One row (…, term, tf) per document and term, counted inside the row.

    The sorted tokens are cut where the value changes; the distance between two
    cuts is the count.  With ``keep_empty`` a document without tokens keeps one
    row with null term and tf.
    """
    kept = [c for c in df.columns if c != tokens]
    ordered = df.select(*kept, F.sort_array(tokens).alias("_s"))
    cuts = F.filter(
        F.transform("_s", lambda t, i: i), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1))
    )
    counts = F.transform(
        "_cuts",
        lambda at, i: F.struct(
            F.get("_s", at).alias("term"), (F.coalesce(F.get("_cuts", i + 1), F.size("_s")) - at).cast("bigint").alias("tf")
        ),
    )
    explode = F.explode_outer if keep_empty else F.explode
    rows = ordered.withColumn("_cuts", cuts).select(*kept, explode(counts).alias("_p"))
    return rows.select(*kept, "_p.term", "_p.tf")


def hashed_term_freq(df: DataFrame, buckets: int = 1 << 18, tokens: str = "tokens") -> DataFrame:
    """Add a sparse vector ``features`` of hashed term counts."""
    return HashingTF(numFeatures=buckets, inputCol=tokens, outputCol="features").transform(df)


def lemmatize(terms: DataFrame, lexicon: DataFrame, spread_by: Sequence[str] = ("doc_id", "pos")) -> DataFrame:
    """Add ``lemma`` to (…, term) rows: the lexicon (form, lemma) first, then the plural rule."""
    named = lexicon.select(F.col("form").alias("term"), F.col("lemma").alias("_lemma"))
    joined = sized_join(terms, named, ["term"], spread_by, "left")
    return joined.withColumn("lemma", F.coalesce("_lemma", strip_plural(F.col("term")))).drop("_lemma")


def corpus_summary(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Documents, vocabulary, distinct terms summed over documents, and running tokens.

    One pass: the counts per term add up to all three token figures, so no
    task holds the vocabulary.
    """
    counted = term_freq(df.select(tokens), tokens).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n")
    )
    documents = df.agg(F.count(F.lit(1))).scalar()
    return counted.agg(
        F.count(F.lit(1)).alias("vocabulary"),
        F.coalesce(F.sum("df"), F.lit(0)).alias("doc_terms"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
    ).select(documents.alias("documents"), "*")


def vocabulary(postings: DataFrame, size: int | None = None, min_df: int = 1) -> DataFrame:
    """All terms (term, n, df) of (doc_id, term, tf) rows, or the ``size`` most frequent."""
    counted = postings.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
    kept = counted.filter(F.col("df") >= min_df)
    return kept if size is None else top_n(kept, [F.desc("n"), F.asc("term")], size, ["term"], [*score_digits("n"), *name_digits("term")])


def _idf(n: Column, df: Column) -> Column:
    return F.log((n + 1) / (df + 1))


def idf(postings: DataFrame, n_docs: Column) -> DataFrame:
    """Document frequency and idf = ln((N + 1) / (df + 1)) of each term."""
    counted = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counted.withColumn("idf", _idf(n_docs, F.col("df")))


def write_idf(idf_table: DataFrame, n_docs: Column, path: str) -> None:
    """The idf table and the number of documents it was counted on."""
    idf_table.select("term", "df", "idf", n_docs.alias("n")).write.parquet(path)


def tfidf_of_new(postings: DataFrame, path: str) -> DataFrame:
    """TF-IDF of (doc_id, term, tf) rows by a table of ``write_idf``; a term it does not hold has df 0."""
    saved = postings.sparkSession.read.parquet(path)
    unknown = _idf(saved.agg(F.max("n")).scalar(), F.lit(0))
    joined = sized_join(postings, saved.select("term", "df", "idf"), ["term"], ["doc_id"], "left")
    return joined.withColumn("tfidf", F.col("tf") * F.coalesce("idf", unknown)).drop("df", "idf")


def lemma_freq(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(doc_id, topic, term, tf) of the lemmas of (doc_id, topic, tokens) rows."""
    found = lemmatize(term_freq(tokens), lexicon, ("doc_id",))
    return found.groupBy("doc_id", "topic", F.col("lemma").alias("term")).agg(F.sum("tf").alias("tf"))


def tfidf(postings: DataFrame, idf_table: DataFrame) -> DataFrame:
    """TF-IDF of each (doc_id, term, tf) row; the heaviest terms are spread over many tasks."""
    joined = sized_join(postings, idf_table, ["term"], ["doc_id"], weight="df")
    return joined.withColumn("tfidf", F.col("tf") * F.col("idf"))


def term_scores(
    postings: DataFrame, n_docs: DataFrame, by_topic: bool = False, score: str = "max"
) -> DataFrame:
    """Score of each term: its largest TF-IDF, or with ``score="last"`` that of the last document.

    The idf of a term is the same in all its documents, so its largest TF-IDF
    is max(tf) * idf: one aggregation, no join of postings with the idf table.
    ``n_docs`` is a table (n) or, by topic, (topic, n).
    """
    if score == "max":
        tf = F.max("tf")
    elif score == "last":
        tf = F.max_by("tf", "doc_id")
    else:
        raise ValueError(f"unknown score: {score}")
    keys = ["topic", "term"] if by_topic else ["term"]
    counted = postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("df"), tf.alias("tf"))
    if by_topic:
        sizes = n_docs.select("topic", "n")
        listed = sizes.limit(MAX_TOPICS + 1).collect()
        if len(listed) <= MAX_TOPICS:
            local = postings.sparkSession.createDataFrame(listed, sizes.schema)
            counted = counted.join(F.broadcast(local), "topic")
        else:
            counted = spread_join(counted, sizes, ["topic"], ["term"])
        n = F.col("n")
    else:
        n = n_docs.scalar()
    value = F.round(F.col("tf") * _idf(n, F.col("df")), 6)
    return counted.select(*keys, value.alias("score"), "df")


def _best_first() -> list[Column]:
    """Digits of the order by falling score, then by term; scores of terms in all documents are 0, none is below."""
    return [*score_digits("score"), *name_digits("term")]


def top_tfidf_words(postings: DataFrame, n_docs: DataFrame, n: int = 1000, score: str = "max") -> DataFrame:
    """The ``n`` best words (term, score) of the corpus."""
    scored = term_scores(postings, n_docs, score=score).select("term", "score")
    return top_n(scored, [F.desc("score"), F.asc("term")], n, ["term"], _best_first())


def top_tfidf_words_by_topic(postings: DataFrame, topic_docs: DataFrame, n: int = 10_000, score: str = "max") -> DataFrame:
    """The ``n`` best words (topic, rank, term, score) of each topic; N and df are counted within the topic."""
    scored = term_scores(postings, topic_docs, by_topic=True, score=score)
    ranked = top_per_group(scored, ["topic"], [F.desc("score"), F.asc("term")], n, ["term"], digits=_best_first())
    return ranked.select("topic", "rank", "term", "score", "df")


def topic_documents(df: DataFrame) -> DataFrame:
    """Documents per topic (topic, n)."""
    return df.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def distinct_top(df: DataFrame, columns: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Distinct rows, globally ordered, first ``n``."""
    return top_n(df.select(*columns).distinct(), order, n, columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def attach(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Bring two results of the same rows together by key."""
    return df.join(other, list(key), "inner")


def distinct_labels(df: DataFrame, column: str) -> list:
    """The class names in order; a class list is model-sized and refused beyond MAX_TOPICS."""
    return sorted(r[0] for r in bounded_rows(df.select(column).distinct(), MAX_TOPICS, f"classes of {column}"))


def encode_labels(df: DataFrame, column: str = "topic", label: str = "label") -> DataFrame:
    """Add numeric ids to a class column, numbered in the order of the names."""
    names = distinct_labels(df.filter(F.col(column).isNotNull()), column)
    kind = df.schema[column].dataType.simpleString()
    ids = df.sparkSession.createDataFrame(
        [(name, float(i)) for i, name in enumerate(names)], f"`{column}` {kind}, `{label}` double"
    )
    return df.join(F.broadcast(ids), column, "left")


def select_vectors(vectors: DataFrame, selected: DataFrame, on: str = "word") -> DataFrame:
    """Vectors of the selected words."""
    return sized_join(vectors, selected.select(on).distinct(), [on], [on], "left_semi")
