"""Entity, triple, thesaurus and concept-edge queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import corpus, quoted, table, values
from sigloom.functions.lexicon import DOMAIN_WORDS, GAZETTEER, RELATION_VERBS, SYNSETS
from sigloom.functions.markup import html_links
from sigloom.functions.text import tokenize
from sigloom.operators import extract, names
from sigloom.operators.terms import distinct_terms
from sigloom.scale import fresh_path
from sigloom.sources.corpus import split_sentences
from sigloom.sources.tables import read_delimited, write_delimited

EDGE_REL = "/r/LinksTo"


def _words(spark, sf):
    """(doc_id, pos, word): white-space words without punctuation at the end."""
    parts = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    rows = corpus(spark, sf).select("doc_id", F.posexplode(parts).alias("pos", "word"))
    return rows.withColumn("word", F.rtrim("word", F.lit(".,;:!?")))


def _tagged(spark, sf):
    gazetteer = spark.createDataFrame(GAZETTEER, "word string, tag string")
    return extract.tag_entities(_words(spark, sf), gazetteer)


def _overridden(spark, sf):
    words = spark.createDataFrame([(w,) for w in DOMAIN_WORDS], "lemma string")
    rows = _tagged(spark, sf).withColumn("lemma", F.lower("word"))
    return extract.domain_override(rows, words, "Domain", "lemma")


def _count(df, *columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def _tagged_file(spark, sf):
    path = fresh_path(spark, "tagged")
    write_delimited(_overridden(spark, sf).select("word", "tag"), path)
    return _count(read_delimited(spark, path, "word string, tag string"), "word", "tag")


def _phrases(spark, sf):
    """Two and three words of every benchmark text and of every line of a conversation's first turn."""
    texts = table(spark, sf, "benchmark").select("text").unionByName(table(spark, sf, "conversations").filter("turn = 0").select("text"))
    words = texts.select(F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w"))
    two = words.filter("size(w) >= 2").select(F.array_join(F.slice("w", 1, 2), " ").alias("phrase"), F.lit("TWO").alias("tag"))
    three = words.filter("size(w) >= 4").select(F.array_join(F.slice("w", 2, 3), " ").alias("phrase"), F.lit("THREE").alias("tag"))
    return two.unionByName(three).distinct()


def _entity_phrases(spark, sf):
    """The longest phrase from every word of the documents where one begins."""
    tokens = corpus(spark, sf).select("doc_id", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("tokens"))
    return names.find_names(tokens, _phrases(spark, sf), overlapping=True)


def _triples(spark, sf):
    sentences = split_sentences(corpus(spark, sf).select("doc_id", "text"))
    found = extract.extract_triples(sentences, RELATION_VERBS)
    return found.withColumn("confidence", F.round("confidence", 6))


def _thesaurus(spark, sf):
    synsets = spark.createDataFrame(SYNSETS, "word string, pos string, synonym string")
    words = distinct_terms(corpus(spark, sf).select(tokenize("text", "regex").alias("tokens")))
    return extract.thesaurus_lookup(words.withColumnRenamed("term", "word"), synsets, 10)


def _edges(spark, sf):
    """Edges of the page links, written as one JSON object per page and parsed back."""
    edge = F.transform(
        html_links("html"),
        lambda link: F.struct(
            F.col("url").alias("start"), F.lit(EDGE_REL).alias("rel"), F.concat(F.lit("/c"), link["target"]).alias("end"),
            link["anchor"].alias("surfaceText"),
        ),
    )
    objects = table(spark, sf, "pages").select("page_id", F.to_json(F.struct(edge.alias("edges"))).alias("value"))
    return extract.parse_edges(objects)


def _concepts(spark, sf):
    return extract.concept_edges(_edges(spark, sf), EDGE_REL, "/c/The", 10)


QUERIES = {
    "entity_tags": lambda spark, sf: _count(_tagged(spark, sf), "word", "tag"),
    "entity_phrases": _entity_phrases,
    "domain_override": lambda spark, sf: _count(_overridden(spark, sf), "word", "tag"),
    "tagged_file": _tagged_file,
    "triples": _triples,
    "thesaurus": _thesaurus,
    "edge_table": _edges,
    "concept_edges": _concepts,
}

_SHAPE = "CASE " + " ".join(f"WHEN regexp_matches(word, '{p}') THEN '{t}'" for t, p in extract.SHAPE_TAGS) + " ELSE 'O' END"

_TAGGED = rf"""
split AS (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents),
stripped AS (SELECT regexp_replace(word, '[.,;:!?]+$', '') AS word FROM split WHERE word <> ''),
gazetteer(word, tag) AS {values(GAZETTEER)},
tagged AS (SELECT s.word, coalesce(g.tag, {_SHAPE.replace('word', 's.word')}) AS tag
  FROM stripped s LEFT JOIN gazetteer g ON g.word = s.word)"""

_OVERRIDE = "SELECT word, CASE WHEN lower(word) IN ({}) THEN 'Domain' ELSE tag END AS tag, count(*) AS n FROM tagged GROUP BY ALL".format(
    quoted(DOMAIN_WORDS)
)

_TRIPLE = rf"(\p{{L}}+) ({'|'.join(RELATION_VERBS)}) (\p{{L}}+)"

_EDGES = r"""
links AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="[^"]*"[^>]*>[^<]*</a>')) AS a FROM pages),
edges AS (SELECT page_id, url AS start, '/r/LinksTo' AS rel, '/c' || regexp_extract(a, 'href="([^"]*)"', 1) AS "end",
  regexp_extract(a, '>([^<]*)<', 1) AS surface_text FROM links)"""

_PHRASES = r"""
phrase_words AS (SELECT list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS w
  FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM conversations WHERE turn = 0)),
phrases AS (SELECT DISTINCT array_to_string(w[1:2], ' ') AS phrase, 'TWO' AS tag, 2 AS words FROM phrase_words WHERE len(w) >= 2
  UNION SELECT DISTINCT array_to_string(w[2:4], ' '), 'THREE', 3 FROM phrase_words WHERE len(w) >= 4),
doc_words AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS w FROM documents),
grams AS (SELECT doc_id, n AS words, unnest(range(len(w) - n + 1)) AS start, unnest(list_transform(range(len(w) - n + 1),
    lambda i: array_to_string(w[i + 1:i + n], ' '))) AS phrase FROM doc_words CROSS JOIN (VALUES (2), (3)) s(n) WHERE len(w) >= n)"""

ORACLE = {
    "entity_phrases": "WITH " + _PHRASES + """
        SELECT doc_id, CAST(start AS INTEGER) AS start, CAST(words AS INTEGER) AS words, phrase, tag FROM (
          SELECT g.doc_id, g.start, g.words, g.phrase, p.tag, row_number() OVER (PARTITION BY g.doc_id, g.start ORDER BY g.words DESC) AS r
          FROM grams g JOIN phrases p ON p.phrase = g.phrase AND p.words = g.words) WHERE r = 1""",
    "entity_tags": "WITH " + _TAGGED + "SELECT word, tag, count(*) AS n FROM tagged GROUP BY ALL",
    "domain_override": "WITH " + _TAGGED + _OVERRIDE,
    "tagged_file": "WITH " + _TAGGED + _OVERRIDE,
    "triples": rf"""WITH sents AS (SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS sent_no, unnest(s) AS sentence
          FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
        found AS (SELECT doc_id, sent_no, sentence, regexp_extract_all(sentence, '{_TRIPLE}') AS m FROM sents),
        rows AS (SELECT doc_id, sent_no, sentence, CAST(unnest(range(len(m))) AS INTEGER) AS triple_no, unnest(m) AS m FROM found)
        SELECT doc_id, sent_no, triple_no, string_split(m, ' ')[1] AS subject, string_split(m, ' ')[2] AS relation,
          string_split(m, ' ')[3] AS object, round(length(m) / length(sentence), 6) AS confidence FROM rows""",
    "thesaurus": rf"""WITH synsets(word, pos, synonym) AS {values(SYNSETS)},
        known AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents)
        SELECT word, pos, synonym, CAST(rank AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY word, pos ORDER BY synonym) AS rank FROM synsets)
        WHERE rank <= 10 AND word IN (SELECT word FROM known)""",
    "edge_table": "WITH " + _EDGES + 'SELECT page_id, start, rel, "end", surface_text FROM edges',
    "concept_edges": "WITH " + _EDGES + """SELECT page_id, start, rel, "end", surface_text FROM edges
        WHERE "end" = '/c/The' ORDER BY start, surface_text LIMIT 10""",
}
