"""Wiki and HTML page queries, and files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import corpus, embeddings, spread, table
from registry.vectors import _MAP, small_map
from sigloom.functions.markup import decode_entities, html_to_text, page_namespace, title_slug, wiki_to_text
from sigloom.operators import pages as ops
from sigloom.operators.som import codebook_from_table
from sigloom.scale import fresh_path
from sigloom.sources import tables
from sigloom.sources.corpus import read_lines


def wiki_pages(spark, sf):
    """(doc_id, title, text): the documents with wiki markup put into them."""
    df = spread(spark, sf, "documents", "doc_id")
    prefix = (
        F.when(F.col("source") == "src0", "Vorlage:")
        .when(F.col("source") == "src1", "Simple:")
        .when(F.col("lang") == "de", "de:")
        .when(F.col("lang") == "fr", "category:")
        .when(F.col("lang") == "es", "Image:")
        .otherwise("")
    )
    title = F.concat(prefix, "source", F.lit(" "), F.col("doc_id").cast("string"))
    text = F.regexp_replace("text", r"(?m)^(\p{L}+) (\p{L}+)", "[[$1|$2]]s {{cite|{{nested|$1}}}}<ref name=x>$2</ref>")
    text = F.regexp_replace(text, r", (\p{L}+)", ", [[$1]]")
    text = F.regexp_replace(text, r"\. (\p{L}+)", ". '''$1''' [[Image:$1.png|thumb]] ''&amp;''")
    return df.select("doc_id", title.alias("title"), text.alias("text"))


def titled_pages(spark, sf):
    """(page_id, title, text): the HTML pages with the text of their title element."""
    title = decode_entities(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    return spread(spark, sf, "pages", "page_id").select("page_id", title.alias("title"), F.col("html").alias("text"))


def _entities(spark, sf):
    mixed = F.replace("html", F.lit("&copy;"), F.lit("&#xA9;&#169&nosuch;&amp;lt;"))
    return spread(spark, sf, "pages", "page_id").select("page_id", decode_entities(mixed).alias("decoded"))


def _redirects(spark, sf):
    """Customer pages, and one redirect to its customer per order."""
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("title"), F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("text")
    )
    target = F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("#redirect [["), target, F.lit("]]\nmoved")).alias("text"),
    )
    return ops.resolve_redirects(customers.unionByName(orders))


def _top_titles(spark, sf):
    """Ranking lines made of the list items of the pages."""
    lines = F.replace("html", F.lit('<li><a href="/'), F.lit('\n<td><a href="http://x.example.org/wiki/A+b_'))
    lines = F.replace(lines, F.lit("th"), F.lit("%74%68"))
    return ops.top_titles(spread(spark, sf, "pages", "page_id").select("page_id", lines.alias("list")), "list", ["page_id"])


def _buckets(spark, sf):
    found = tables.bucket_pages(titled_pages(spark, sf))
    return found.select("page_id", "l1", "l2")


def _bucketed(spark, sf):
    path = fresh_path(spark, "pages")
    tables.write_bucketed_pages(titled_pages(spark, sf).select("title", "text"), path)
    return tables.read_bucketed_pages(spark, path).groupBy("l1").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
    )


def _dump(spark, sf):
    path = fresh_path(spark, "dump")
    tables.write_wiki_dump(wiki_pages(spark, sf).select("title", "text"), path)
    return tables.read_wiki_dump(spark, path).select("title", F.md5(F.trim("text")).alias("digest"))


def _lines(spark, sf):
    path = fresh_path(spark, "lines")
    corpus(spark, sf).select("text").write.text(path)
    return read_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def _vector_file(spark, sf):
    path = fresh_path(spark, "vectors")
    rows = embeddings(spark, sf).select(F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), "vector")
    tables.write_word_vectors(rows, path)
    total = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v)
    return tables.read_word_vectors(spark, path).select(
        "word", F.size("vector").cast("bigint").alias("size"), (F.round(total, 6) + 0.0).alias("total")
    )


def _codebook_file(spark, sf):
    path = fresh_path(spark, "codebook")
    tables.write_codebook(small_map(spark, sf).to_table(spark), path)
    book = codebook_from_table(tables.read_codebook(spark, path))
    total = F.aggregate("weight", F.lit(0.0), lambda a, v: a + v)
    return book.to_table(spark).select("unit", "x", "y", (F.round(total, 6) + 0.0).alias("total"))


QUERIES = {
    "namespaces": lambda spark, sf: wiki_pages(spark, sf).select("doc_id", "title", page_namespace("title").alias("ns")),
    "redirects": _redirects,
    "page_links": lambda spark, sf: ops.page_links(spread(spark, sf, "pages", "page_id"), "html", ["page_id"], "html"),
    "wiki_links": lambda spark, sf: ops.page_links(wiki_pages(spark, sf), "text", ["doc_id"], "wiki"),
    "html_to_text": lambda spark, sf: spread(spark, sf, "pages", "page_id").select("page_id", html_to_text("html").alias("plain")),
    "wiki_to_text": lambda spark, sf: wiki_pages(spark, sf).select("doc_id", wiki_to_text("text").alias("plain")),
    "wiki_to_text_markup": lambda spark, sf: wiki_pages(spark, sf).select(
        "doc_id", wiki_to_text("text", markup=True).alias("plain")
    ),
    "decode_entities": _entities,
    "top_titles": _top_titles,
    "title_slug": lambda spark, sf: titled_pages(spark, sf).select("page_id", title_slug("title").alias("slug")),
    "page_bucket": _buckets,
    "bucketed_pages_file": _bucketed,
    "wiki_dump_file": _dump,
    "lines_file": _lines,
    "word_vectors_file": _vector_file,
    "codebook_file": _codebook_file,
}

_WIKI = r"""
wiki AS (SELECT doc_id,
  CASE WHEN source = 'src0' THEN 'Vorlage:' WHEN source = 'src1' THEN 'Simple:' WHEN lang = 'de' THEN 'de:'
       WHEN lang = 'fr' THEN 'category:' WHEN lang = 'es' THEN 'Image:' ELSE '' END || source || ' ' || doc_id AS title,
  regexp_replace(regexp_replace(regexp_replace(text,
    '(?m)^(\p{L}+) (\p{L}+)', '[[\1|\2]]s {{cite|{{nested|\1}}}}<ref name=x>\2</ref>', 'g'),
    ', (\p{L}+)', ', [[\1]]', 'g'),
    '\. (\p{L}+)', '. ''''''\1'''''' [[Image:\1.png|thumb]] ''''&amp;''''', 'g') AS text
  FROM documents)"""


def _decoded(value: str, keys: str, source: str) -> str:
    """SQL that decodes the entities which occur in the test pages, part by part behind each '&'."""
    return rf"""(SELECT {keys}, array_to_string(list_transform(p, lambda x, i:
      CASE WHEN i = 1 THEN x
           WHEN regexp_matches(x, '^amp\b') THEN '&' || regexp_replace(x, '^amp;?', '')
           WHEN regexp_matches(x, '^quot\b') THEN '"' || regexp_replace(x, '^quot;?', '')
           WHEN regexp_matches(x, '^copy\b') THEN '©' || regexp_replace(x, '^copy;?', '')
           WHEN regexp_matches(x, '^middot\b') THEN '·' || regexp_replace(x, '^middot;?', '')
           WHEN regexp_matches(x, '^#xA9') THEN chr(169) || regexp_replace(x, '^#xA9;?', '')
           WHEN regexp_matches(x, '^#169') THEN chr(169) || regexp_replace(x, '^#169;?', '')
           ELSE '&' || x END), '') AS decoded
      FROM (SELECT {keys}, string_split({value}, '&') AS p FROM {source}))"""


def _chain(value: str, steps) -> str:
    for pattern, replacement in steps:
        value = "regexp_replace({}, '{}', '{}', 'g')".format(value, pattern.replace("'", "''"), replacement)
    return value


_HTML_STEPS = [(r"(?s)<!--.*?-->", "")]
_HTML_STEPS += [(rf"(?is)<{t}(\s[^>]*)?>.*?</{t}\s*>", "") for t in ("script", "style", "head", "nav", "footer", "table", "ul", "ol")]
_HTML_STEPS += [(r"(?i)<br\s*/?>", "\n"), (r"(?i)</?(p|div|article|h[1-6])(\s[^>]*)?>", "\n\n"), (r"<[^>]*>", "")]
_BLANK_STEPS = [(r"[ \t]*\n[ \t]*", "\n"), (r"\n\n+|^\n+", "\n\n")]
_LINK_STEPS = [
    (r"(?s)<ref[^>]*>.*?</ref>", ""), (r"\{\{[^{}]*\}\}", ""), (r"\{\{[^{}]*\}\}", ""),
    (r"\[\[[^\[\]|]*:[^\[\]]*\]\]", ""), (r"\[\[[^\[\]|]*\|([^\[\]|]*)\]\]", r"\1"), (r"\[\[([^\[\]|]*)\]\]", r"\1"),
]
# The test documents hold no list lines but the ones that begin with '#', '*', ':' or ';'.
_PLAIN_STEPS = [*_LINK_STEPS, (r"(?m)^=+ *([^=\n]*?) *=+ *$", "\n\\1\n"), (r"'''?", ""), (r"(?m)^[*#:;].*$", ""), (r"</?[a-zA-Z][^>]*>", "")]
_MARKUP_STEPS = [
    *_LINK_STEPS, (r"(?m)^=+ *([^=\n]*?) *=+ *$", "\n\\1\n"), (r"(?m)^\*\*\*+ *", "--- "), (r"(?m)^\*\* *", "-- "),
    (r"(?m)^\* *", "- "), (r"'''", "*"), (r"''", "/"), (r"</?[a-zA-Z][^>]*>", ""),
]

ORACLE = {
    "namespaces": "WITH " + _WIKI + """SELECT doc_id, title, CAST(CASE
        WHEN starts_with(title, 'Vorlage:') THEN 11 WHEN starts_with(title, 'Simple:') THEN -9
        WHEN starts_with(title, 'de:') THEN -9 WHEN starts_with(title, 'category:') THEN -8
        WHEN starts_with(title, 'Image:') THEN 6 ELSE 0 END AS INTEGER) AS ns FROM wiki""",
    "redirects": """SELECT c_name AS title, NULL AS target, c_mktsegment || ' ' || c_nationkey AS text FROM customer
        UNION ALL
        SELECT 'Order ' || o_orderkey, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'),
          coalesce(c_mktsegment || ' ' || c_nationkey, '')
        FROM orders LEFT JOIN customer ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""",
    "page_links": """WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*"[^>]*>[^<]*</a>') AS a FROM pages),
        r AS (SELECT page_id, CAST(unnest(range(len(a))) AS INTEGER) AS link_no, unnest(a) AS a FROM a)
        SELECT page_id, link_no, regexp_extract(a, 'href="([^"]*)"', 1) AS target,
          regexp_extract(a, '>([^<]*)<', 1) AS anchor FROM r""",
    "wiki_links": "WITH " + _WIKI + r""",
        a AS (SELECT doc_id, regexp_extract_all(text, '\[\[[^\[\]]+\]\][a-zA-Z]*') AS a FROM wiki),
        r AS (SELECT doc_id, CAST(unnest(range(len(a))) AS INTEGER) AS link_no, unnest(a) AS a FROM a),
        c AS (SELECT doc_id, link_no, string_split(regexp_extract(a, '\[\[(.*)\]\]', 1), '|') AS c,
          regexp_extract(a, '\]\](.*)$', 1) AS trail FROM r)
        SELECT doc_id, link_no, c[1] AS target, coalesce(c[2], c[1]) || trail AS anchor FROM c""",
    "html_to_text": "WITH d AS " + _decoded(_chain("html", _HTML_STEPS), "page_id", "pages")
    + "SELECT page_id, " + _chain("decoded", _BLANK_STEPS) + " AS plain FROM d",
    "wiki_to_text": "WITH " + _WIKI + ", d AS " + _decoded(_chain("text", _PLAIN_STEPS), "doc_id", "wiki")
    + "SELECT doc_id, " + _chain("decoded", _BLANK_STEPS) + " AS plain FROM d",
    "wiki_to_text_markup": "WITH " + _WIKI + ", d AS " + _decoded(_chain("text", _MARKUP_STEPS), "doc_id", "wiki")
    + "SELECT doc_id, " + _chain("decoded", _BLANK_STEPS) + " AS plain FROM d",
    "decode_entities": "SELECT page_id, decoded FROM "
    + _decoded("replace(html, '&copy;', '&#xA9;&#169&nosuch;&amp;lt;')", "page_id", "pages"),
    "top_titles": r"""WITH l AS (SELECT page_id, string_split(replace(replace(html, '<li><a href="/',
          chr(10) || '<td><a href="http://x.example.org/wiki/A+b_'), 'th', '%74%68'), chr(10)) AS l FROM pages),
        r AS (SELECT page_id, CAST(unnest(range(len(l))) AS INTEGER) AS line_no, unnest(l) AS line FROM l),
        m AS (SELECT page_id, line_no, regexp_extract(line, '^<td><a href="[^"]*/wiki/([^"]+)"', 1) AS raw FROM r)
        SELECT page_id, line_no, replace(replace(raw, '%74%68', 'th'), '_', ' ') AS title FROM m WHERE raw <> ''""",
    "title_slug": "WITH d AS " + _decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)", "page_id", "pages")
    + "SELECT page_id, url_encode(replace(decoded, ' ', '_')) AS slug FROM d",
    "page_bucket": "WITH d AS " + _decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)", "page_id", "pages")
    + "SELECT page_id, substr(md5(decoded), 1, 2) AS l1, substr(md5(decoded), 3, 2) AS l2 FROM d",
    "bucketed_pages_file": "WITH d AS " + _decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)", "page_id, html", "pages")
    + "SELECT substr(md5(decoded), 1, 2) AS l1, count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS chars FROM d GROUP BY 1",
    "wiki_dump_file": "WITH " + _WIKI + "SELECT title, md5(trim(text)) AS digest FROM wiki",
    "lines_file": """SELECT text, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents)
        GROUP BY text""",
    "word_vectors_file": """SELECT 'w' || vec_id AS word, len(embedding) AS size,
        round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 AS total FROM embeddings""",
    "codebook_file": "WITH " + _MAP + """SELECT unit, CAST(unit // 4 AS INTEGER) AS x, CAST(unit % 4 AS INTEGER) AS y,
        round(list_sum(vector), 6) + 0.0 AS total FROM units""",
}
