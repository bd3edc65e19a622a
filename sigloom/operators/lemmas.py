"""Lemmas of unlisted words by suffix rules that a (form, lemma) table teaches.

Every pair gives rules: the part of the form behind the common beginning turns into that of the lemma, alone and with up to
``CONTEXT`` letters before it.  Rules are counted in one aggregation; a suffix keeps its most frequent rewriting if that is
frequent and common enough.  A word that is not listed is rewritten by the rule of its longest known suffix.  Words meet the
rules by an equality join of their few last parts, so each distinct word is looked at once however often it occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.scale import sized_join, top_per_group

# Letters before the rewritten part that a rule may look at, longest suffix, least count, least share of a suffix's pairs.
CONTEXT = 4
LONGEST = 10
LEAST = 2
SHARE = 0.5


def _common(a: str, b: str) -> Column:
    """Length of the common beginning of two columns."""
    both = f"least(length({a}), length({b}))"
    equal = f"size(filter(sequence(1, {both}), i -> substring({a}, 1, i) = substring({b}, 1, i)))"
    return F.expr(f"if({both} < 1, 0, {equal})")


def suffix_rules(lexicon: DataFrame) -> DataFrame:
    """(suffix, replacement, n): what a (form, lemma) table teaches; repeated pairs count once."""
    pairs = lexicon.filter("form is not null and lemma is not null").select("form", "lemma").distinct().withColumn("_c", _common("form", "lemma"))
    each = pairs.select("form", "lemma", F.explode(F.expr(f"transform(sequence(0, least({CONTEXT}, _c)), k -> _c - k)")).alias("_at"))
    rules = each.select(F.expr("substring(form, _at + 1)").alias("suffix"), F.expr("substring(lemma, _at + 1)").alias("replacement"))
    counts = rules.filter(F.length("suffix").between(1, LONGEST)).groupBy("suffix", "replacement").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("suffix").agg(F.sum("n").alias("_total"))
    best = top_per_group(counts, ["suffix"], [F.desc("n"), F.asc("replacement")], 1, ["replacement"]).drop("rank")
    kept = best.join(totals, "suffix").filter((F.col("n") >= LEAST) & (F.col("n") >= SHARE * F.col("_total")))
    return kept.select("suffix", "replacement", "n")


def rule_lemmas(terms: DataFrame, lexicon: DataFrame, rules: DataFrame) -> DataFrame:
    """(term, lemma) of every distinct term: the listed lemma (the smallest of several), else by the longest suffix, else the term."""
    listed = lexicon.groupBy(F.col("form").alias("term")).agg(F.min("lemma").alias("_listed"))
    words = terms.select("term").filter("term is not null").distinct()
    # A rule must leave at least one letter before it.
    ends = words.filter("length(term) > 1").select("term", F.explode(F.expr(f"sequence(1, least({LONGEST}, length(term) - 1))")).alias("_n"))
    ends = ends.select("term", "_n", F.expr("right(term, _n)").alias("suffix"))
    met = sized_join(ends, rules.select("suffix", "replacement"), ["suffix"], ["term"])
    ruled = F.concat(F.expr("left(term, length(term) - _n)"), F.col("replacement"))
    longest = met.groupBy("term").agg(F.max_by(ruled, "_n").alias("_ruled"))
    known = words.join(listed, "term", "left").join(longest, "term", "left")
    return known.select("term", F.coalesce("_listed", "_ruled", "term").alias("lemma"))


def lemma_tokens(df: DataFrame, lemmas: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """``df`` (keys…, tokens, …) with lemmas in place of the tokens, in their order; ``keys`` tell its rows apart."""
    rows = df.select(*keys, F.posexplode(tokens).alias("_pos", "term"))
    named = sized_join(rows, lemmas.select("term", "lemma"), ["term"], [*keys, "_pos"], "left")
    pairs = F.sort_array(F.collect_list(F.struct("_pos", F.coalesce("lemma", "term").alias("t"))))
    lists = named.groupBy(*keys).agg(F.transform(pairs, lambda p: p["t"]).alias("_lemmas"))
    none = F.array().cast("array<string>")
    return df.drop(tokens).join(lists, keys, "left").withColumn(tokens, F.coalesce("_lemmas", none)).drop("_lemmas")
