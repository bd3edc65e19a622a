"""Wiki and HTML page tables: links, redirects, ranking lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions.markup import html_links, ranked_title, redirect_target, wiki_links
from sigloom.functions.text import sentence_lines
from sigloom.scale import sized_join, spread_join


def page_links(pages: DataFrame, column: str, keys: Sequence[str], kind: str = "wiki") -> DataFrame:
    """One row (keys…, link_no, target, anchor) per link of a wiki or HTML page."""
    if kind not in ("wiki", "html"):
        raise ValueError(f"unknown page kind: {kind}")
    links = wiki_links(column) if kind == "wiki" else html_links(column)
    return pages.select(*keys, F.posexplode(links).alias("link_no", "l")).select(
        *keys, "link_no", "l.target", "l.anchor"
    )


def resolve_redirects(pages: DataFrame) -> DataFrame:
    """(title, target, text) with redirects replaced by the page they point to, one level deep.

    A redirect to a missing page has empty text.  Plain pages pass without a
    shuffle; many redirects to one page are spread over lanes.
    """
    marked = pages.select("title", "text", redirect_target("text").alias("target"))
    plain = marked.filter(F.col("target").isNull()).select("title", "target", "text")
    redirects = marked.filter(F.col("target").isNotNull()).select("title", "target")
    # Only pages that a redirect asks for go into the join.
    asked = redirects.select("target").distinct()
    named = pages.select(F.col("title").alias("target"), "text")
    aims = sized_join(named, asked, ["target"], ["target"], "left_semi")
    found = spread_join(redirects, aims, ["target"], ["title"], "left").select("title", "target", F.coalesce("text", F.lit("")).alias("text"))
    return plain.unionByName(found)


def top_titles(pages: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """(keys…, line_no, title) of the ranking lines of a page."""
    lines = pages.select(*keys, F.posexplode(sentence_lines(column)).alias("line_no", "line"))
    return lines.select(*keys, "line_no", ranked_title("line").alias("title")).filter(F.col("title").isNotNull())
