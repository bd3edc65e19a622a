"""Tables, derived inputs and SQL pieces shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions.lexicon import ENGLISH_STOP_WORDS
from sigloom.functions.text import content_words
from sigloom.operators.terms import term_freq
from sigloom.scale import dealt, rows_within, sized_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are heavy to work on: a small one is a single split, so its rows are dealt over the cores first."""
    return dealt(table(spark, sf_dir, name), key)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, topic, text): the documents with their language as topic."""
    return spread(spark, sf_dir, "documents", "doc_id").select("doc_id", F.col("lang").alias("topic"), "text")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, topic, tokens): content words of the documents."""
    return corpus(spark, sf_dir).select("doc_id", "topic", content_words("text").alias("tokens"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, topic, term, tf)."""
    return term_freq(tokens(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, vector array<double>)."""
    df = table(spark, sf_dir, "embeddings")
    return df.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))


def hashed_word_vectors(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """(word, df, vec_id, vector) of all words in ``rows``: each word gets the embedding its md5 points at."""
    counted = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    vectors = embeddings(spark, sf_dir)
    size = vectors.agg(F.count(F.lit(1))).scalar()
    place = F.pmod(F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("bigint"), size)
    words = counted.select(F.col("term").alias("word"), "df", place.alias("vec_id"))
    return sized_join(words, vectors.select("vec_id", "vector"), ["vec_id"], ["word"], max_rows=rows_within(64))


def long_vectors(df: DataFrame, keys: list[str], vector: str = "vector", digits: int = 6) -> DataFrame:
    """(keys…, dim, value): one row per number of a vector, rounded."""
    rows = df.select(*keys, F.posexplode(vector).alias("dim", "value"))
    return rows.select(*keys, "dim", (F.round("value", digits) + F.lit(0.0)).alias("value"))


def quoted(words) -> str:
    """A SQL list of string literals."""
    return ", ".join("'" + str(w).replace("'", "''") + "'" for w in words)


def values(rows) -> str:
    """A SQL VALUES list of string rows."""
    return "(VALUES " + ", ".join(f"({quoted(r)})" for r in rows) + ")"


STOP = quoted(ENGLISH_STOP_WORDS)

# Content words as rows, with all their repeats.
WORDS = rf"""
words AS (
  SELECT doc_id, topic, term FROM (
    SELECT doc_id, lang AS topic,
           unnest(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z\s:]', ' ', 'g')), '\s+')) AS term
    FROM documents)
  WHERE term <> '' AND term NOT IN ({STOP}))"""

POSTINGS = WORDS + """,
postings AS (SELECT doc_id, topic, term, count(*) AS tf FROM words GROUP BY doc_id, topic, term)"""

# Content words as lists.
TOKENS = rf"""
tokens AS (
  SELECT doc_id, lang AS topic,
         list_filter(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z\s:]', ' ', 'g')), '\s+'),
                     lambda t: t <> '' AND t NOT IN ({STOP})) AS tokens
  FROM documents)"""

# One row per number of each embedding.
DIMS = """
vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings),
dims AS (SELECT vec_id, label, unnest(range(len(vector))) AS dim, unnest(vector) AS value FROM vectors)"""

# Hashed word vectors of the vocabulary.
WORD_VECTORS = """
vocab AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
word_vectors AS (
  SELECT v.term AS word, v.df, e.vec_id, CAST(e.embedding AS DOUBLE[]) AS vector
  FROM vocab v JOIN embeddings e
    ON e.vec_id = CAST('0x' || substr(md5(v.term), 1, 8) AS BIGINT) % (SELECT count(*) FROM embeddings))"""
