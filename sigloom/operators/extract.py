"""Information extraction: entity tags, domain words, open triples, thesaurus and concept edges."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.scale import sized_join, top_n, top_per_group

# Tags given by the shape of a word, tried in this order.
SHAPE_TAGS = [
    ("DATE", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("TIME", r"^[0-9]{1,2}:[0-9]{2}$"),
    ("PERCENT", r"^[0-9]+([.,][0-9]+)*%$"),
    ("MONEY", r"^[$][0-9]+([.,][0-9]+)*$"),
    ("ORDINAL", r"^[0-9]+(st|nd|rd|th)$"),
    ("NUMBER", r"^[0-9]+([.,][0-9]+)*$"),
]


def shape_tag(word: Column) -> Column:
    """Tag of a word by its shape alone; 'O' when none fits."""
    digits = F.lit("O")
    for tag, pattern in reversed(SHAPE_TAGS):
        digits = F.when(word.rlike(pattern), F.lit(tag)).otherwise(digits)
    # Words without any digit need no pattern.
    return F.when(word.rlike("[0-9]"), digits).otherwise(F.lit("O"))


def tag_entities(
    tokens: DataFrame,
    gazetteer: DataFrame,
    spread_by: Sequence[str] = ("doc_id", "pos"),
    tagger: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
) -> DataFrame:
    """Add ``tag`` to (…, word) rows: the gazetteer (word, tag) first, then the shape of the word.

    ``tagger`` replaces the shape rules: it maps batches of the rows to the
    same rows with a string column ``_guess``.
    """
    if tagger is None:
        guessed = tokens.withColumn("_guess", shape_tag(F.col("word")))
    else:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
        guessed = tokens.mapInPandas(tagger, f"{fields}, _guess string")
    listed = gazetteer.select("word", F.col("tag").alias("_listed"))
    joined = sized_join(guessed, listed, ["word"], spread_by, "left")
    return joined.withColumn("tag", F.coalesce("_listed", "_guess")).drop("_listed", "_guess")


def domain_override(
    tags: DataFrame, words: DataFrame, label: str, on: str = "word", spread_by: Sequence[str] = ("doc_id", "pos")
) -> DataFrame:
    """Give the listed words (column ``on`` of ``words``) the tag ``label``; all others keep theirs."""
    listed = words.select(F.col(on)).distinct().withColumn("_domain", F.lit(label))
    joined = sized_join(tags, listed, [on], spread_by, "left")
    return joined.withColumn("tag", F.coalesce("_domain", "tag")).drop("_domain")


def triples(sentence: Column | str, verbs: Sequence[str]) -> Column:
    """Open triples of a sentence: word, listed verb, word; found left to right without overlap.

    The confidence is the share of the sentence that the triple covers.
    """
    sentence = F.col(sentence) if isinstance(sentence, str) else sentence
    # A triple begins at the first letter of a word, which keeps the search linear in very long words.
    pattern = rf"(?<!\p{{L}})(\p{{L}}+) ({'|'.join(verbs)}) (\p{{L}}+)"
    found = F.regexp_extract_all(sentence, F.lit(pattern), F.lit(0))
    return F.transform(
        found,
        lambda m: F.struct(
            F.substring_index(m, " ", 1).alias("subject"),
            F.get(F.split(m, " "), F.lit(1)).alias("relation"),
            F.substring_index(m, " ", -1).alias("object"),
            (F.length(m) / F.length(sentence)).alias("confidence"),
        ),
    )


def extract_triples(df: DataFrame, verbs: Sequence[str], sentence: str = "sentence") -> DataFrame:
    """One row (…, subject, relation, object, confidence) per triple."""
    kept = [c for c in df.columns if c != sentence]
    return df.select(*kept, F.posexplode(triples(sentence, verbs)).alias("triple_no", "t")).select(
        *kept, "triple_no", "t.subject", "t.relation", "t.object", "t.confidence"
    )


def thesaurus_lookup(words: DataFrame, synsets: DataFrame, k: int = 10) -> DataFrame:
    """Up to ``k`` synonyms per word and part of speech of distinct words, from a (word, pos, synonym) table."""
    named = synsets.select("word", "pos", "synonym").distinct()
    kept = top_per_group(named, ["word", "pos"], [F.asc("synonym")], k, ["synonym"])
    return sized_join(words, kept, ["word"], ["word"])


EDGE_SCHEMA = "struct<edges: array<struct<start: string, rel: string, end: string, surfaceText: string>>>"


def parse_edges(df: DataFrame, value: str = "value") -> DataFrame:
    """Edge rows (…, start, rel, end, surface_text) from JSON objects with an ``edges`` list."""
    kept = [c for c in df.columns if c != value]
    edges = F.from_json(value, EDGE_SCHEMA)["edges"]
    return df.select(*kept, F.explode(edges).alias("e")).select(
        *kept, "e.start", "e.rel", "e.end", F.col("e.surfaceText").alias("surface_text")
    )


def concept_edges(edges: DataFrame, rel: str, end: str, k: int = 10) -> DataFrame:
    """The first ``k`` edges (by start and text) with a relation and end node."""
    found = edges.filter((F.col("rel") == rel) & (F.col("end") == end))
    return top_n(found, [F.asc("start"), F.asc("surface_text")], k, ["start"])
