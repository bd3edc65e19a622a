"""Text preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import STOP, TOKENS, WORDS, corpus, quoted, table, tokens, values
from sigloom.functions.lexicon import IRREGULAR_LEMMAS, PUNCTUATION_STOP_WORDS
from sigloom.functions.paths import doc_key, topic_of_path
from sigloom.functions.text import clean, content_words, ngrams, remove_stop_words, tokenize, words
from sigloom.operators import lemmas as rules
from sigloom.operators import sentences as boundaries
from sigloom.operators.terms import distinct_terms, doc_terms, lemmatize
from sigloom.scale import settle
from sigloom.sources.corpus import split_sentences

# Bytes of text whose bigrams are counted in one task.
COUNTED_BYTES = 8 << 20
WORD_ENDINGS = ("s", "es", "n", "en", "e", "er", "ing", "ed")


def _cleaned(mode):
    return lambda spark, sf: corpus(spark, sf).select("doc_id", clean("text", mode).alias("cleaned"))


def _clean_brackets(spark, sf):
    marked = F.concat_ws(" ", F.lit("["), "text", F.lit("%]%"))
    return corpus(spark, sf).select("doc_id", clean(marked, "brackets").alias("cleaned"))


def _tokens(mode, before=None):
    def run(spark, sf):
        text = clean("text", before) if before else F.col("text")
        df = corpus(spark, sf).select("doc_id", tokenize(text, mode).alias("t"))
        return df.select("doc_id", F.size("t").cast("bigint").alias("n"), F.array_join("t", "|").alias("tokens"))

    return run


def _stopwords(spark, sf):
    df = corpus(spark, sf).select("doc_id", remove_stop_words(words("text")).alias("t"))
    return df.select("doc_id", F.size("t").cast("bigint").alias("n"), F.array_join("t", "|").alias("tokens"))


def _stopwords_extended(spark, sf):
    spaced = F.regexp_replace("text", r"([.,:;?'\"])", " $1 ")
    kept = remove_stop_words(tokenize(spaced, "regex"), PUNCTUATION_STOP_WORDS)
    df = corpus(spark, sf).select("doc_id", kept.alias("t"))
    return df.select("doc_id", F.size("t").cast("bigint").alias("n"), F.array_join("t", "|").alias("tokens"))


def _lemmas(spark, sf):
    lexicon = spark.createDataFrame(list(IRREGULAR_LEMMAS.items()), "form string, lemma string")
    rows = corpus(spark, sf).select("doc_id", words("text").alias("tokens"))
    found = lemmatize(doc_terms(rows), lexicon)
    return found.groupBy("term", "lemma").agg(F.count(F.lit(1)).alias("n"))


def _bigrams(spark, sf):
    """Texts, then their bigrams, are dealt before they are counted: as many tasks as keep what one of them holds small."""
    docs = corpus(spark, sf).select("doc_id", "text")
    size = table(spark, sf, "documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // COUNTED_BYTES))
    if parts > docs.rdd.getNumPartitions():
        docs = docs.repartition(parts, "doc_id", "text")
    rows = docs.select(F.explode(ngrams(content_words("text"), 2)).alias("bigram"))
    return rows.repartition(parts, "bigram").groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


def _paths(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", topic_of_path("url").alias("topic"), doc_key("url").alias("doc_key"))


def _path_topics(spark, sf):
    return _paths(spark, sf).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def _vocabulary(spark, sf):
    """The distinct words, written once: they are read several times, the documents are not."""
    return settle(distinct_terms(tokens(spark, sf)).select("term"), "vocabulary")


def _word_pairs(terms):
    """(form, lemma): words of which one is the other with an ending."""
    ends = F.array(*[F.lit(e) for e in WORD_ENDINGS])
    forms = terms.select(F.col("term").alias("lemma"), F.explode(F.transform(ends, lambda e: F.concat("term", e))).alias("term"))
    return forms.filter("length(lemma) > 2").join(terms, "term").select(F.col("term").alias("form"), "lemma")


def _lemma_rules(spark, sf):
    return rules.suffix_rules(_word_pairs(_vocabulary(spark, sf)))


def _rule_lemmas(spark, sf):
    """Lemmas of all words of the documents."""
    terms = _vocabulary(spark, sf)
    lexicon = settle(_word_pairs(terms), "lexicon")
    return rules.rule_lemmas(terms, lexicon, settle(rules.suffix_rules(lexicon), "rules"))


def _noted(spark, sf):
    """Words of the documents with an abbreviation in place of every comma."""
    return boundaries.word_rows(corpus(spark, sf).select("doc_id", F.replace("text", F.lit(", "), F.lit(" cf. ")).alias("text")))


def _boundaries(spark, sf):
    words = _noted(spark, sf)
    return boundaries.sentences(words, boundaries.abbreviations(words))


QUERIES = {
    "clean_letters": _cleaned("letters"),
    "clean_letters_nocolon": _cleaned("letters_nocolon"),
    "clean_strict": _cleaned("strict"),
    "clean_ner": _cleaned("ner"),
    "clean_brackets": _clean_brackets,
    "tokens_simple": _tokens("simple", "letters"),
    "tokens_regex": _tokens("regex"),
    "tokens_space": _tokens("space"),
    "stopwords": _stopwords,
    "stopwords_extended": _stopwords_extended,
    "lemmas": _lemmas,
    "bigrams": _bigrams,
    "sentences": lambda spark, sf: split_sentences(corpus(spark, sf).select("doc_id", "text")),
    "conversation_sentences": lambda spark, sf: split_sentences(
        table(spark, sf, "conversations").select("conv_id", "turn", "text")
    ),
    "lemma_rules": _lemma_rules,
    "rule_lemmas": _rule_lemmas,
    "abbreviations": lambda spark, sf: boundaries.abbreviations(_noted(spark, sf)),
    "sentence_boundaries": _boundaries,
    "doc_terms": lambda spark, sf: doc_terms(tokens(spark, sf).select("doc_id", "tokens")),
    "distinct_terms": lambda spark, sf: distinct_terms(tokens(spark, sf)),
    "path_keys": _paths,
    "path_topics": _path_topics,
}

# Words of one or two letters become a mark, found by cutting the text into runs of word characters.
_MARKED = r"""
runs AS (SELECT doc_id, regexp_extract_all({text}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+') AS r FROM documents),
marked AS (SELECT doc_id, array_to_string(list_transform(r, lambda x:
  CASE WHEN regexp_full_match(x, '\p{{L}}{{1,2}}') THEN chr(1) ELSE x END), '') AS t FROM runs),
kept AS (SELECT doc_id, regexp_replace(t, '([!-#%-\-/:-@\[-`{{-~0-9]|\x01)\s*', ' ', 'g') AS t FROM marked)"""

LEMMA = r"""CASE
  WHEN regexp_matches(term, 'ies$') AND NOT regexp_matches(term, '[ea]ies$') THEN regexp_replace(term, 'ies$', 'y')
  WHEN regexp_matches(term, 'es$') AND NOT regexp_matches(term, '[aeo]es$') THEN regexp_replace(term, 's$', '')
  WHEN regexp_matches(term, 's$') AND NOT regexp_matches(term, '(us|ss)$') THEN regexp_replace(term, 's$', '')
  ELSE term END"""

_PARTS = "list_slice(string_split(url, '/'), -2, -1)"

_NOTED = rf"""
note_lines AS (SELECT doc_id, unnest(range(len(l))) AS line, unnest(l) AS t
  FROM (SELECT doc_id, string_split(replace(text, ', ', ' cf. '), chr(10)) AS l FROM documents)),
note_tokens AS (SELECT doc_id, line, list_filter(string_split_regex(t, '\s+'), lambda x: x <> '') AS t FROM note_lines),
note_rows AS (SELECT doc_id, line, unnest(range(len(t))) AS pos, unnest(t) AS token, unnest(list_append(t[2:], '')) AS next
  FROM note_tokens WHERE len(t) > 0),
noted AS (SELECT doc_id, line, pos, token, lower(regexp_extract(token, '{boundaries.CORE}', 1)) AS core,
  regexp_matches(token, '{boundaries.WITH_PERIOD}') AS period, regexp_matches(next, '{boundaries.SMALL}') AS small FROM note_rows),
short AS (SELECT * FROM (
    SELECT core, count(*) FILTER (period) AS n_period, count(*) FILTER (NOT period) AS n_plain, count(*) FILTER (period AND small) AS n_small
    FROM noted WHERE core <> '' AND length(core) <= {boundaries.LONGEST} GROUP BY core)
  WHERE n_period >= {boundaries.LEAST} AND n_period >= {boundaries.SHARE} * (n_period + n_plain) AND n_small >= {boundaries.BEFORE_SMALL} * n_period)"""
_ENDING = boundaries.ENDING.replace("'", "''")

_RULES = WORDS + f""",
vocab AS (SELECT DISTINCT term FROM words),
pairs AS (SELECT DISTINCT f.term AS form, l.term AS lemma FROM vocab l CROSS JOIN (VALUES {", ".join(f"('{e}')" for e in WORD_ENDINGS)}) e(e)
  JOIN vocab f ON f.term = l.term || e WHERE length(l.term) > 2),
rules AS (SELECT suffix, replacement, n FROM (
  SELECT suffix, replacement, n, sum(n) OVER (PARTITION BY suffix) AS total,
    row_number() OVER (PARTITION BY suffix ORDER BY n DESC, replacement) AS r
  FROM (SELECT substr(form, c - k + 1) AS suffix, substr(lemma, c - k + 1) AS replacement, count(*) AS n
        FROM (SELECT form, lemma, length(lemma) AS c FROM pairs) CROSS JOIN range({rules.CONTEXT + 1}) x(k) WHERE k <= c GROUP BY ALL)
  WHERE length(suffix) BETWEEN 1 AND {rules.LONGEST})
  WHERE r = 1 AND n >= {rules.LEAST} AND n >= {rules.SHARE} * total)"""

ORACLE = {
    "lemma_rules": "WITH " + _RULES + "SELECT suffix, replacement, n FROM rules",
    "rule_lemmas": "WITH " + _RULES + f""",
        ended AS (SELECT term, k, right(term, k) AS suffix FROM vocab CROSS JOIN range(1, {rules.LONGEST + 1}) x(k) WHERE k < length(term)),
        ruled AS (SELECT term, left(term, length(term) - k) || replacement AS lemma,
          row_number() OVER (PARTITION BY term ORDER BY k DESC) AS r FROM ended JOIN rules USING (suffix)),
        listed AS (SELECT form AS term, min(lemma) AS lemma FROM pairs GROUP BY form)
        SELECT v.term, coalesce(l.lemma, r.lemma, v.term) AS lemma FROM vocab v
        LEFT JOIN listed l ON l.term = v.term LEFT JOIN ruled r ON r.term = v.term AND r.r = 1""",
    "abbreviations": "WITH " + _NOTED + "SELECT core, n_period, n_plain, n_small FROM short",
    "sentence_boundaries": "WITH " + _NOTED + f""",
        ended AS (SELECT doc_id, line, pos, token, regexp_matches(token, '{_ENDING}')
            AND NOT (period AND (core IN (SELECT core FROM short) OR length(core) = 1)) AS ends FROM noted),
        begun AS (SELECT *, CASE WHEN pos = 0 OR lag(ends) OVER w THEN 1 ELSE 0 END AS b FROM ended
          WINDOW w AS (PARTITION BY doc_id ORDER BY line, pos)),
        placed AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY line, pos) - 1 AS sent_no FROM begun)
        SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, string_agg(token, ' ' ORDER BY line, pos) AS sentence
        FROM placed GROUP BY doc_id, sent_no""",
    "clean_letters": r"SELECT doc_id, regexp_replace(text, '[^a-zA-Z\s:]', ' ', 'g') AS cleaned FROM documents",
    "clean_letters_nocolon": r"""SELECT doc_id,
        replace(regexp_replace(text, '[^a-zA-Z\s:]', ' ', 'g'), ':', '') AS cleaned FROM documents""",
    "clean_strict": "WITH " + _MARKED.format(text="text") + r"""
        SELECT doc_id, regexp_replace(t, '[!-/:-@\[-`{-~]', ' ', 'g') AS cleaned FROM kept""",
    "clean_ner": "WITH " + _MARKED.format(text="replace(text, chr(9), ' ')") + r"""
        SELECT doc_id, regexp_replace(translate(t, ',.' || chr(9) || ';', '   '), '\s\s', ' ', 'g') AS cleaned
        FROM kept""",
    "clean_brackets": """SELECT doc_id, replace(replace('[ ' || text || ' %]%', '[', ' '), '%]%', ' ') AS cleaned
        FROM documents""",
    "tokens_simple": r"""WITH t AS (SELECT doc_id, string_split_regex(lower(rtrim(
          regexp_replace(text, '[^a-zA-Z\s:]', ' ', 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '\s') AS t
          FROM documents)
        SELECT doc_id, CASE WHEN t = [''] THEN 0 ELSE len(t) END AS n, array_to_string(t, '|') AS tokens FROM t""",
    "tokens_regex": r"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS t
          FROM documents)
        SELECT doc_id, len(t) AS n, array_to_string(t, '|') AS tokens FROM t""",
    "tokens_space": """SELECT doc_id, len(string_split(text, ' ')) AS n, array_to_string(string_split(text, ' '), '|') AS tokens
        FROM documents""",
    "stopwords": "WITH " + TOKENS + "SELECT doc_id, len(tokens) AS n, array_to_string(tokens, '|') AS tokens FROM tokens",
    "stopwords_extended": rf"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(
          regexp_replace(text, '([.,:;?''"])', ' \1 ', 'g')), '\s+'),
          lambda x: x <> '' AND x NOT IN ({STOP}, {quoted(PUNCTUATION_STOP_WORDS)})) AS t FROM documents)
        SELECT doc_id, len(t) AS n, array_to_string(t, '|') AS tokens FROM t""",
    "lemmas": rf"""WITH w AS (SELECT term FROM (SELECT unnest(string_split_regex(lower(
          regexp_replace(text, '[^a-zA-Z\s:]', ' ', 'g')), '\s+')) AS term FROM documents) WHERE term <> ''),
        lexicon(form, lemma) AS {values(IRREGULAR_LEMMAS.items())}
        SELECT term, coalesce(l.lemma, {LEMMA}) AS lemma, count(*) AS n
        FROM w LEFT JOIN lexicon l ON l.form = w.term GROUP BY ALL""",
    "bigrams": "WITH " + TOKENS + """SELECT bigram, count(*) AS n FROM (
          SELECT unnest(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) AS bigram
          FROM tokens) GROUP BY bigram""",
    "sentences": """SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS sent_no, unnest(s) AS sentence
        FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)""",
    "conversation_sentences": """SELECT conv_id, turn, CAST(unnest(range(len(s))) AS INTEGER) AS sent_no, unnest(s) AS sentence
        FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS s FROM conversations)""",
    "doc_terms": "WITH " + TOKENS + """SELECT doc_id, CAST(unnest(range(len(tokens))) AS INTEGER) AS pos,
        unnest(tokens) AS term FROM tokens""",
    "distinct_terms": "WITH " + WORDS + "SELECT DISTINCT term FROM words",
    "path_keys": f"SELECT page_id, {_PARTS}[1] AS topic, array_to_string({_PARTS}, '/') AS doc_key FROM pages",
    "path_topics": f"SELECT {_PARTS}[1] AS topic, count(*) AS n FROM pages GROUP BY 1",
}
