"""Secret scans over a trigram index, in DataFrame functions only.

``trigram_query`` turns every rule into a Boolean query.  ``postings`` is the inverted index of the trigrams that the
rules ask for, one row per trigram and text; ``candidates`` intersects the postings of each rule's conjunctions.  Only
candidates are then searched with the rule's expression.  A rule without mandatory trigrams is searched everywhere.

Null and empty texts have no spans; equal texts share their postings; null ids and repeated rows pass through, one
result row each.  Spans are code points, the end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.common import small, text_of
from sigloom.llm.trigrams import EVERY, Query, trigram_query
from sigloom.scale import settle


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost, non-overlapping matches; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def query(self) -> Query:
        return trigram_query(self.pattern)


# The kinds that every scan reports.  A run of hex digits (or of what may follow AKIA) that is too short
# holds no match that is long enough, so there the least length stands in the expression.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Further public key formats.
MORE_RULES = (
    Rule("private", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES
# What masking uses: a private key runs on to its END line; where there is none, over its header lines and base64 runs.  Line
# ends may be escaped.  Everything that repeats is possessive, so long texts need no stack.
_KEY_LINE = r"-----{} [A-Z ]{{0,40}}PRIVATE KEY-----"
_KEY_GAP = r"(?:\s|\\[nr])*+"
_KEY_TO_END = r"[^-]*+(?:-(?!----)[^-]*+)*+" + _KEY_LINE.format("END")
_KEY_CUT_OFF = (
    rf"(?:{_KEY_GAP}(?:Proc-Type|DEK-Info):[^\n\\]*+)*+(?:{_KEY_GAP}[A-Za-z0-9+/=]{{16,}}+)*+(?:{_KEY_GAP}[A-Za-z0-9+/]{{1,15}}={{1,2}})?"
)
KEY_BLOCK = Rule("private", _KEY_LINE.format("BEGIN") + f"(?:{_KEY_TO_END}|{_KEY_CUT_OFF})")
MASK_RULES = tuple(KEY_BLOCK if r.kind == KEY_BLOCK.kind else r for r in RULES)
SPANS = "array<struct<start: int, place: int, end: int, kind: string>>"


def _quoted(word: str) -> str:
    """A word as an SQL literal."""
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def postings(texts: DataFrame, rules=RULES) -> DataFrame:
    """(trigram, key) of ``texts`` (_text, _key): the trigrams that the rules ask for, in either case."""
    wanted = sorted({t for rule in rules for clause in rule.query for t in clause})
    folded = texts.select("_key", F.lower("_text").alias("_folded"))
    held = ", ".join(f"if(contains(_folded, {_quoted(t)}), {_quoted(t)}, null)" for t in wanted)
    return folded.select("_key", F.explode(F.expr(f"array_compact(array({held}))")).alias("trigram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(_key, _rules): for each text the rules whose Boolean query its postings satisfy."""
    held = index.groupBy("_key").agg(F.collect_set("trigram").alias("_held"))

    def fits(rule: Rule) -> str:
        clauses = (", ".join(map(_quoted, sorted(c))) for c in sorted(rule.query, key=sorted))
        met = " or ".join(f"size(array_except(array({c}), _held)) = 0" for c in clauses)
        return f"if({met}, {_quoted(rule.kind)}, null)"

    asked = ", ".join(fits(r) for r in rules if r.query != EVERY)
    return held.select("_key", F.expr(f"array_compact(array({asked}))").alias("_rules")).filter("size(_rules) > 0")


def _with_matches(rows: DataFrame, rule: Rule, place: int) -> DataFrame:
    """Adds _s<place>: the spans of one rule, from the lengths of its matches and of the gaps between them."""
    hits, gaps, parts, found = (f"_{name}{place}" for name in ("hits", "gaps", "parts", "s"))
    empty = F.expr("cast(array() as array<string>)")
    open_to = "true" if rule.query == EVERY else f"array_contains(_rules, {_quoted(rule.kind)})"
    matches = F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(0))
    rows = rows.withColumn(hits, F.when(F.expr(open_to), matches).otherwise(empty))
    matched = F.expr(f"size({hits}) > 0")
    rows = rows.withColumn(gaps, F.when(matched, F.split("_text", rule.pattern, -1)).otherwise(empty))
    if rule.group:
        group = F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(rule.group))
        rows = rows.withColumn(parts, F.when(matched, group).otherwise(empty))
    else:
        parts = hits
    spans = f"""
        aggregate(
          transform(
            arrays_zip({', '.join(dict.fromkeys([hits, gaps, parts]))}),
            x -> struct(length(x.{gaps}) as skip, length(x.{hits}) as size, length(x.{parts}) as part)),
          struct(0 as at, cast(array() as {SPANS}) as kept),
          (done, x) -> struct(
            done.at + x.skip + x.size as at,
            if(x.part >= {rule.least},
               concat(done.kept, array(struct(
                 done.at + x.skip as start, {place} as place, done.at + x.skip + x.size as end,
                 {_quoted(rule.kind)} as kind))),
               done.kept) as kept),
          done -> done.kept)"""
    return rows.withColumn(found, F.expr(spans)).drop(hits, gaps, parts)


def find_secrets(rows: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``_spans`` to rows with ``_text``: array<struct<start, place, end, kind>> by start, then rule."""
    texts = rows.select("_text", F.xxhash64("_text").alias("_key"))
    index = settle(postings(texts, rules), "trigrams")
    found = small(settle(candidates(index, rules), "candidates"))
    rows = rows.withColumn("_key", F.xxhash64("_text")).join(found, "_key", "left")
    for place, rule in enumerate(rules):
        rows = _with_matches(rows, rule, place)
    parts = [f"_s{place}" for place in range(len(rules))]
    return rows.withColumn("_spans", F.array_sort(F.concat(*parts))).drop(*parts, "_rules", "_key")


def told(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """(id, spans): every secret of every text."""
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return find_secrets(rows, rules).select(F.col("_id").alias(id_col), F.col("_spans").alias("spans"))


def _redacted(mark: str) -> str:
    """SQL of the text between the spans, with marks; a span that begins inside the last one only moves its end."""
    return f"""
        aggregate(
          _spans,
          struct(0 as at, cast(array() as array<string>) as parts),
          (done, s) -> struct(
            greatest(done.at, s.end) as at,
            if(s.start > done.at or size(done.parts) = 0,
               concat(done.parts, array(substring(_text, done.at + 1, s.start - done.at), {_quoted(mark)})),
               done.parts) as parts),
          done -> concat(array_join(done.parts, ''), substring(_text, done.at + 1, length(_text))))"""


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", rules=MASK_RULES) -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by ``mark``; touching or overlapping spans become one mark.

    A private key is replaced as a whole, from its BEGIN to its END line.  All columns stay, whatever their names; null texts stay null.
    """
    rows = docs.select(F.struct("*").alias("_row"), text_of(text_col).alias("_text"))
    found = find_secrets(rows, rules)
    clean = F.when(F.size("_spans") > 0, F.expr(_redacted(mark))).otherwise(F.col("_row")[text_col])
    fields = [clean.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    return found.select(*fields)
