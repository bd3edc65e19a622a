"""URL filters: rules first, and gradient-boosted trees on lexical features for what no rule decides.

Everything is DataFrame functions and Spark ML on the JVM.  The trees are fitted on a bounded sample (``sample_rows``) of
distinct labelled URLs, chosen by hash; labels come with the call (the query takes the URLs that rules decide).  Suffix
statistics are counted over all labelled URLs.

A null URL or one without ``://`` has an empty host and path, fits no rule and is judged by its features like any other.
Null ids, repeated rows and very long URLs get one result row each; an empty table gives an empty result.  With labels of
one kind only, what no rule decides gets that kind; without labels it is allowed.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import small
from sigloom.scale import settle

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Host and path prefix as one string, such as ``example.org/es/``."""

    text: str
    verdict: str

    def fits(self, host: str, path: str) -> Column:
        own, slash, rest = self.text.partition("/")
        at_home = (F.col(host) == own) | F.endswith(F.col(host), F.lit("." + own))
        return at_home & F.startswith(F.col(path), F.lit(slash + rest))


# The rules of the contract.
RULES = (
    Rule("org/", ALLOW),
    Rule("example.org/es/", BLOCK),
    Rule("example.org/en/1", BLOCK),
    Rule("com/fr/", ALLOW),
    Rule("com/de/", BLOCK),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules, host: str, path: str) -> Column:
    """The text of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        found = F.when(rule.fits(host, path), F.lit(rule.text)).otherwise(found)
    return found


_ENTROPY = """
    coalesce(aggregate(
      transform(array_distinct(split(_url, '')), c -> (length(_url) - length(replace(_url, c, ''))) / greatest(length(_url), 1)),
      cast(0 as double), (sum, p) -> if(p > 0, sum - p * ln(p), sum)), 0)"""
# What is measured in a URL, beside the statistics of its suffixes.
LEXICAL = {
    "f_length": "length(_url)",
    "f_host_length": "length(_host)",
    "f_path_length": "length(_path)",
    "f_depth": "length(_path) - length(replace(_path, '/', ''))",
    "f_labels": "length(_host) - length(replace(_host, '.', ''))",
    "f_digits": "coalesce((length(_url) - length(translate(_url, '0123456789', ''))) / greatest(length(_url), 1), 0)",
    "f_host_digits": "length(_host) - length(translate(_host, '0123456789', ''))",
    "f_hyphens": "length(_url) - length(replace(_url, '-', ''))",
    "f_params": "if(contains(_url, '?'), 1 + length(_query) - length(replace(_query, '&', '')), 0)",
    "f_fragment": "if(contains(_url, '#'), 1, 0)",
    "f_escapes": "length(_url) - length(replace(_url, '%', ''))",
    "f_entropy": _ENTROPY,
}
# The last label of the host and the ending of the path.
SUFFIXES = {"_tail": "substring_index(_host, '.', -1)", "_ending": "regexp_extract(_path, '[.]([^./]{1,10})$', 1)"}
FEATURES = [*LEXICAL, *(f"f{suffix}_{what}" for suffix in SUFFIXES for what in ("share", "count"))]


def measured(rows: DataFrame) -> DataFrame:
    """Adds the lexical features and suffixes to rows with _url, _host and _path."""
    rows = rows.withColumn("_query", F.expr(r"regexp_extract(_url, '[?]([^#]*)', 1)"))
    return rows.select(
        "*",
        *[F.expr(f"cast(coalesce({sql}, 0) as double)").alias(name) for name, sql in LEXICAL.items()],
        *[F.expr(sql).alias(name) for name, sql in SUFFIXES.items()],
    )


def suffix_statistics(labelled: DataFrame) -> dict[str, DataFrame]:
    """For each kind of suffix: its smoothed share of blocked URLs and the log of its count, over all labelled rows."""
    tables = {}
    for suffix in SUFFIXES:
        counts = labelled.groupBy(suffix).agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("bad"))
        share, count = ((F.col("bad") + 1) / (F.col("n") + 2)).alias(f"f{suffix}_share"), F.log1p("n").alias(f"f{suffix}_count")
        tables[suffix] = settle(counts.select(suffix, share, count), "suffixes")
    return tables


def with_suffixes(rows: DataFrame, statistics: dict[str, DataFrame]) -> DataFrame:
    """Adds the statistics; a suffix without labels has share one half and count 0."""
    for suffix, side in statistics.items():
        rows = rows.join(small(side), suffix, "left")
    filled = {f"f{suffix}_share": 0.5 for suffix in statistics} | {f"f{suffix}_count": 0.0 for suffix in statistics}
    return rows.fillna(filled)


def judge(
    rows: DataFrame, labelled: DataFrame, *, sample_rows: int = 10_000, rounds: int = 12, depth: int = 3, seed: int = 7
) -> DataFrame:
    """``rows`` (_url, _host, _path) with ``_bad``: the probability that a URL is to be blocked.

    ``labelled``: the same columns and _label (1: block, 0: allow).
    """
    known = measured(labelled).filter("_label in (0, 1)")
    statistics = suffix_statistics(known)
    distinct = known.groupBy("_url").agg(F.max("_label").alias("_label"), *[F.first(c).alias(c) for c in ("_host", "_path")])
    counts = {r["_label"]: r["count"] for r in distinct.groupBy("_label").count().collect()}
    if len(counts) < 2:
        return rows.withColumn("_bad", F.lit(float(counts.get(1, 0) > 0)))
    whole = 1 << 30
    share = min(whole, -(-whole * sample_rows // sum(counts.values())))
    drawn = distinct.filter(F.pmod(F.xxhash64("_url"), F.lit(whole)) < share)
    sample = settle(with_suffixes(measured(drawn), statistics).select(*FEATURES, F.col("_label").cast("double")).coalesce(4), "sample")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    trees = GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed)
    model = trees.fit(assembler.transform(sample))
    scored = model.transform(assembler.transform(with_suffixes(measured(rows), statistics)))
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("_bad"))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, bad): the longest rule's verdict, else that of trees trained on ruled URLs."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("_id"), url.alias("_url"))
    rows = rows.select("*", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    ruled = rows.withColumn("_rule", rule_of(rules, "_host", "_path"))
    verdict = F.lit(None).cast("string")
    for rule in rules:
        verdict = F.when(F.col("_rule") == rule.text, F.lit(rule.verdict)).otherwise(verdict)
    ruled = ruled.withColumn("_verdict", verdict)
    labelled = ruled.filter("_rule is not null").select("_url", "_host", "_path", (F.col("_verdict") == BLOCK).cast("int").alias("_label"))
    judged = judge(ruled, labelled)
    own = F.when(F.col("_bad") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", own).alias("verdict"),
        F.col("_bad").alias("bad"),
    )
