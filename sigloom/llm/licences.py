"""License scans by ordered signature rules, in DataFrame functions only.

Texts are reduced to words (``word_string``), and every rule is a regular expression over words.  A rule is tried on a text
only if the text holds all of the rule's keywords.  Rules come in order: those of a lower rank say more (an SPDX tag more
than a notice, a notice more than a bare name).  Of overlapping detections one is suppressed when its interval of words lies
inside that of another one of a lower rank, or of the same rank and longer (of equal intervals the first rule stays).  Base
rules only count places; they suppress nothing and are not suppressed.

The rules are made from ``FAMILIES``, one row per license, and the forms in which a license is named (``signatures``).

Null and empty texts have no words and no detections; texts are read whole; repeated rows and null ids give one result row
each; an empty table gives an empty result; only the two named columns are read, so others may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.llm.common import text_of
from sigloom.scale import settle

# What separates words: ASCII other than digits and small letters (capitals are small by then).
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TAG, NOTICE, ADDRESS, NAME, MENTION, BASE = range(6)
# How sure a detection of each rank is; base rules have their own.
_SURE = (1.0, 0.95, 0.9, 0.8, 0.5, 0.4)


@dataclass(frozen=True)
class Signature:
    """A rule: ``pattern`` is written over words with one space between two of them."""

    label: str
    rank: int
    pattern: str
    keywords: tuple[str, ...]

    @property
    def expression(self) -> str:
        """The pattern over a word string, where each word has a space of its own on both sides."""
        return " " + self.pattern.replace(" ?", "(?: )?").replace(" ", "  ") + " "


# The phrases that every scan reports.
BASE_RULES = (
    Signature("cc-by", BASE, "cc by", ("cc",)),
    Signature("gpl", BASE, "general public license", ("general", "public")),
    Signature("reserved", BASE, "all rights reserved", ("rights", "reserved")),
)

# label | words of the SPDX tag | the full name | words of an address | keywords of the full name
FAMILIES = """
0bsd | 0bsd | (?:bsd zero clause|zero clause bsd) license | opensource org licenses? 0bsd | bsd
afl-3.0 | afl 3 0 | academic free license (?:version )?v?3(?: 0)? | opensource org licenses? afl 3 0 | academic
agpl-3.0 | agpl 3 0(?: only| or later)? | (?:gnu )?affero general public licen[cs]e (?:version )?v?3(?: 0)? | gnu org licenses agpl(?: 3 0)? | affero
apache-1.1 | apache 1 1 | apache(?: software)? licen[cs]e (?:version )?v?1 1 | apache org licenses license 1 1 | apache
apache-2.0 | apache 2 0 | apache(?: software)? licen[cs]e (?:version )?v?2(?: 0)? | apache org licenses license 2 0 | apache
artistic-2.0 | artistic 2 0 | artistic licen[cs]e (?:version )?v?2(?: 0)? | opensource org licenses? artistic license 2 0 | artistic
blueoak-1.0 | blueoak 1 0 0 | blue oak model license(?: 1 0 0)? | blueoakcouncil org license 1 0 0 | oak
bsd-2-clause | bsd 2 clause | (?:bsd (?:2|two) clause|simplified bsd) licen[cs]e | opensource org licenses? bsd 2 clause | bsd
bsd-3-clause | bsd 3 clause | (?:bsd (?:3|three) clause|(?:new|modified|revised) bsd) licen[cs]e | opensource org licenses? bsd 3 clause | bsd
bsd-4-clause | bsd 4 clause | (?:bsd (?:4|four) clause|original bsd) licen[cs]e | spdx org licenses bsd 4 clause | bsd
bsl-1.0 | bsl 1 0 | boost software licen[cs]e(?: (?:version )?v?1 0)? | boost org license 1 0 txt | boost
busl-1.1 | busl 1 1 | business source licen[cs]e (?:version )?v?1 1 | mariadb com bsl11 | business
cc0-1.0 | cc0 1 0 | creative commons zero(?: v?1 0)?(?: universal)?(?: public domain dedication)? | creativecommons org publicdomain zero 1 0 | commons zero
cc-by-2.0 | cc by 2 0 | creative commons attribution 2 0(?: generic)?(?: licen[cs]e)? | creativecommons org licenses by 2 0 | commons attribution
cc-by-3.0 | cc by 3 0 | creative commons attribution 3 0(?: unported)?(?: licen[cs]e)? | creativecommons org licenses by 3 0 | commons attribution
cc-by-4.0 | cc by 4 0 | creative commons attribution 4 0(?: international)?(?: licen[cs]e)? | creativecommons org licenses by 4 0 | commons attribution
cc-by-nc-3.0 | cc by nc 3 0 | creative commons attribution non ?commercial 3 0(?: unported)?(?: licen[cs]e)? | creativecommons org licenses by nc 3 0 | commons attribution
cc-by-nc-4.0 | cc by nc 4 0 | creative commons attribution non ?commercial 4 0(?: international)?(?: licen[cs]e)? | creativecommons org licenses by nc 4 0 | commons attribution
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | creative commons attribution non ?commercial no ?derivatives 4 0(?: international)?(?: licen[cs]e)? | creativecommons org licenses by nc nd 4 0 | commons attribution
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[cs]e)? | creativecommons org licenses by nc sa 4 0 | commons attribution
cc-by-nd-4.0 | cc by nd 4 0 | creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[cs]e)? | creativecommons org licenses by nd 4 0 | commons attribution
cc-by-sa-3.0 | cc by sa 3 0 | creative commons attribution share ?alike 3 0(?: unported)?(?: licen[cs]e)? | creativecommons org licenses by sa 3 0 | commons attribution
cc-by-sa-4.0 | cc by sa 4 0 | creative commons attribution share ?alike 4 0(?: international)?(?: licen[cs]e)? | creativecommons org licenses by sa 4 0 | commons attribution
cddl-1.0 | cddl 1 0 | common development and distribution licen[cs]e(?: (?:version )?v?1 0)? | opensource org licenses? cddl 1 0 | development distribution
cecill-2.1 | cecill 2 1 | cecill(?: free software)? licen[cs]e(?: agreement)?(?: (?:version )?v?2 1)? | cecill info licences licence cecill v2 1 | cecill
cpal-1.0 | cpal 1 0 | common public attribution licen[cs]e(?: (?:version )?v?1 0)? | opensource org licenses? cpal 1 0 | attribution
cpl-1.0 | cpl 1 0 | common public licen[cs]e (?:version )?v?1 0 | opensource org licenses? cpl1 0 | common public
ecl-2.0 | ecl 2 0 | educational community licen[cs]e (?:version )?v?2 0 | opensource org licenses? ecl 2 0 | educational
elastic-2.0 | elastic 2 0 | elastic licen[cs]e (?:version )?v?2(?: 0)? | elastic co licensing elastic license | elastic
epl-1.0 | epl 1 0 | eclipse public licen[cs]e (?:version )?v?1 0 | eclipse org legal epl v10 | eclipse
epl-2.0 | epl 2 0 | eclipse public licen[cs]e (?:version )?v?2(?: 0)? | eclipse org legal epl 2 0 | eclipse
eupl-1.2 | eupl 1 2 | european union public licen[cs]e(?: (?:version )?v?1 2)? | joinup ec europa eu collection eupl | european
fdl-1.3 | gfdl 1 3(?: only| or later)? | gnu free documentation licen[cs]e(?: (?:version )?v?1 3)? | gnu org licenses fdl(?: 1 3)? | documentation
gpl-1.0 | gpl 1 0(?: only| or later)? | gnu general public licen[cs]e (?:version )?v?1(?: 0)? | gnu org licenses old licenses gpl 1 0 | gnu general
gpl-2.0 | gpl 2 0(?: only| or later)? | gnu general public licen[cs]e (?:version )?v?2(?: 0)? | gnu org licenses(?: old licenses)? gpl 2 0 | gnu general
gpl-3.0 | gpl 3 0(?: only| or later)? | gnu general public licen[cs]e (?:version )?v?3(?: 0)? | gnu org licenses gpl 3 0 | gnu general
isc | isc | isc licen[cs]e | opensource org licenses? isc(?: license)? | isc
lgpl-2.0 | lgpl 2 0(?: only| or later)? | gnu library general public licen[cs]e (?:version )?v?2(?: 0)? | gnu org licenses old licenses lgpl 2 0 | library general
lgpl-2.1 | lgpl 2 1(?: only| or later)? | gnu lesser general public licen[cs]e (?:version )?v?2 1 | gnu org licenses(?: old licenses)? lgpl 2 1 | lesser general
lgpl-3.0 | lgpl 3 0(?: only| or later)? | gnu lesser general public licen[cs]e (?:version )?v?3(?: 0)? | gnu org licenses lgpl 3 0 | lesser general
lppl-1.3c | lppl 1 3c | latex project public licen[cs]e(?: (?:version )?v?1 3c?)? | latex project org lppl | latex
mit | mit | mit licen[cs]e | opensource org licenses? mit(?: license)? | mit
mit-0 | mit 0 | mit no attribution(?: licen[cs]e)? | github com aws mit 0 | mit attribution
mpl-1.1 | mpl 1 1 | mozilla public licen[cs]e (?:version )?v?1 1 | mozilla org mpl (?:mpl )?1 1 | mozilla
mpl-2.0 | mpl 2 0 | mozilla public licen[cs]e (?:version )?v?2(?: 0)? | mozilla org mpl 2 0 | mozilla
ms-pl | ms pl | microsoft public licen[cs]e | opensource org licenses? ms pl | microsoft
ms-rl | ms rl | microsoft reciprocal licen[cs]e | opensource org licenses? ms rl | microsoft
mulanpsl-2.0 | mulanpsl 2 0 | mulan permissive software licen[cs]e(?: (?:version )?v?2)? | license coscl org cn mulanpsl2 | mulan
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e | opensource org licenses? ncsa | ncsa
odbl-1.0 | odbl 1 0 | open database licen[cs]e(?: (?:version )?v?1 0)? | opendatacommons org licenses odbl | database
odc-by-1.0 | odc by 1 0 | open data commons attribution licen[cs]e(?: (?:version )?v?1 0)? | opendatacommons org licenses by | commons attribution
ofl-1.1 | ofl 1 1 | (?:sil )?open font licen[cs]e(?: (?:version )?v?1 1)? | scripts sil org ofl | font
osl-3.0 | osl 3 0 | open software licen[cs]e (?:version )?v?3 0 | opensource org licenses? osl 3 0 | software
pddl-1.0 | pddl 1 0 | (?:open data commons )?public domain dedication and licen[cs]e(?: 1 0)? | opendatacommons org licenses pddl | domain dedication
php-3.01 | php 3 01 | php licen[cs]e (?:version )?v?3 01 | php net license 3 01 | php
postgresql | postgresql | postgresql licen[cs]e | opensource org licenses? postgresql | postgresql
python-2.0 | python 2 0 | python software foundation licen[cs]e(?: agreement)?(?: (?:version )?v?2(?: 0)?)? | docs python org license | python
qpl-1.0 | qpl 1 0 | q public licen[cs]e(?: (?:version )?v?1 0)? | opensource org licenses? qtpl | q public
sspl-1.0 | sspl 1 0 | server side public licen[cs]e(?: (?:version )?v?1)? | mongodb com licensing server side public license | server public
unlicense | unlicense | (?:the )?unlicense | unlicense org | unlicense
upl-1.0 | upl 1 0 | universal permissive licen[cs]e(?: (?:version )?v?1 0)? | oss oracle com licenses upl | universal
vim | vim | vim licen[cs]e | vimhelp org uganda txt | vim
wtfpl | wtfpl | do what the f\\w+ you want to public licen[cs]e(?: version 2)? | wtfpl net | want
x11 | x11 | (?:mit )?x11 licen[cs]e | spdx org licenses x11 | x11
zlib | zlib | zlib(?: libpng)? licen[cs]e | zlib net zlib license | zlib
zpl-2.1 | zpl 2 1 | zope public licen[cs]e (?:version )?v?2 1 | opensource org licenses? zpl 2 1 | zope
"""
# Sentences and names that tell a kind of terms without one license of FAMILIES: label | rank | pattern | keywords.
OTHERS = """
agpl | 4 | (?:gnu )?affero general public licen[cs]e | affero
apache | 4 | apache(?: software)? licen[cs]e | apache
bsd | 4 | bsd(?: style)? licen[cs]e | bsd
cc-by | 4 | creative commons attribution(?: licen[cs]e)? | commons attribution
cc | 4 | creative commons(?: licen[cs]e)? | commons
gpl | 4 | (?:gnu general public licen[cs]e|gnu gpl) | gnu
lgpl | 4 | (?:gnu )?(?:lesser|library) general public licen[cs]e | general public
mpl | 4 | mozilla public licen[cs]e | mozilla
cc0-1.0 | 4 | cc0 | cc0
isc | 3 | internet systems consortium licen[cs]e | consortium
python-2.0 | 3 | psf licen[cs]e | psf
public-domain | 4 | (?:in|into|to) the public domain | domain
proprietary | 1 | proprietary and confidential | proprietary confidential
proprietary | 4 | unauthorized (?:copying|use|distribution|reproduction)(?: \\S+){0,6} prohibited | unauthorized prohibited
copyright | 4 | copyright(?: c)? (?:19|20)\\d\\d(?: (?:19|20)\\d\\d)? | copyright
mit | 1 | permission is hereby granted free of charge to any person obtaining a copy | hereby granted
isc | 1 | permission to use copy modify and or distribute this software for any purpose | permission distribute
bsd | 1 | redistribution and use in source and binary forms with or without modification are permitted | redistribution binary
gpl-2.0 | 1 | either version 2 of the license or at your option any later version | option later
gpl-3.0 | 1 | either version 3 of the license or at your option any later version | option later
zlib | 1 | this software is provided as is without any express or implied warranty in no event will the authors | implied warranty
unlicense | 1 | this is free and unencumbered software released into the public domain | unencumbered
apache-2.0 | 1 | you may not use this file except in compliance with the license | compliance
mpl-2.0 | 1 | this source code form is subject to the terms of the mozilla public license v 2 0 | mozilla
non-commercial | 4 | for (?:non ?commercial|personal|research|educational)(?: \\S+){0,3} (?:use|purposes) only | only
no-derivatives | 4 | no derivative works | derivative
attribution | 4 | used with permission | permission
"""
_TERMS = "(?:the )?(?:terms (?:and conditions )?of )?(?:either )?(?:the )?"
_GIVEN = "(?:re)?(?:licensed|released|distributed|available|published|provided|shared|offered|covered)"


def _rows(table: str) -> list[list[str]]:
    return [[field.strip() for field in line.split(" | ")] for line in table.strip().splitlines()]


def _words_of(pattern: str) -> tuple[str, ...]:
    """The words that any match of a pattern of plain words and optional groups begins with."""
    plain = pattern.split("(?:")[0].replace("licenses?", "").split()
    return (max(plain, key=len),) if plain else ()


def signatures() -> tuple[Signature, ...]:
    """All rules in their order: by rank, then as listed."""
    rules = list(BASE_RULES)
    for label, tag, name, address, keywords in _rows(FAMILIES):
        keys = tuple(keywords.split())
        tagged = _words_of(tag)
        rules += [
            Signature(label, TAG, f"spdx license identifier {tag}", ("identifier", "spdx", *tagged)),
            Signature(label, NOTICE, f"{_GIVEN} under {_TERMS}{name}", (*keys, "under")),
            Signature(label, NOTICE, f"{_GIVEN} under {_TERMS}{tag}(?: licen[cs]e)?", (*tagged, "under")),
            Signature(label, ADDRESS, address, _words_of(address)),
            Signature(label, NAME, name, keys),
        ]
        # Tags of one common word say nothing by themselves.
        if " " in tag:
            rules.append(Signature(label, NAME, tag, tagged))
    rules += [Signature(label, int(rank), pattern, tuple(keywords.split())) for label, rank, pattern, keywords in _rows(OTHERS)]
    return tuple(sorted(rules, key=lambda r: r.rank))


RULES = signatures()


def word_string(text: Column) -> Column:
    """The words of a text, each with a space before and after it; no words give an empty string."""
    # lower() is the faster one, but also changes other letters than A-Z.
    plain = F.octet_length(text) == F.length(text)
    folded = F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    spaced = F.regexp_replace(F.concat(F.lit(" "), folded, F.lit(" ")), _GAP, "  ")
    return F.substring(spaced, F.lit(2), F.length(spaced) - 2)


def words_in(words: Column) -> Column:
    """The number of words of a word string or of a part that was cut between words."""
    return ((F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))) / 2).cast("long")


def _rule_rows(spark: SparkSession, rules: tuple[Signature, ...]) -> DataFrame:
    """The rules as a small table: their number is fixed by the caller."""
    rows = [
        (r.keywords[0], i, r.rank, r.label, r.expression, [f" {k} " for k in r.keywords[1:]], _SURE[r.rank])
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(
        rows, "keyword string, rule int, rank int, label string, expression string, others array<string>, sure double"
    )


def detections(marked: DataFrame, rules: tuple[Signature, ...] = RULES) -> DataFrame:
    """(_row, rule, rank, label, sure, start, end) of all rules in the word strings of ``marked`` (_row, _words, _keys).

    ``end`` is exclusive; start and end are word numbers.
    """
    tried = marked.filter("size(_keys) > 0").select("_row", "_words", F.explode("_keys").alias("keyword"))
    tried = tried.join(F.broadcast(_rule_rows(marked.sparkSession, rules)), "keyword")
    tried = tried.filter(F.expr("forall(others, k -> contains(_words, k))"))
    hits = F.expr("regexp_extract_all(_words, expression, 0)")
    tried = tried.filter(F.expr("regexp_like(_words, expression)"))
    pieces = F.arrays_zip(F.split("_words", F.col("expression"), F.lit(-1)).alias("gap"), hits.alias("hit"))
    each = tried.select("_row", "rule", "rank", "label", "sure", F.posexplode(pieces).alias("place", "piece"))
    # What follows the last hit has none.
    each = each.select("*", words_in(F.col("piece.gap")).alias("before"), F.coalesce(words_in(F.col("piece.hit")), F.lit(0)).alias("size"))
    so_far = Window.partitionBy("_row", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    each = each.drop("piece").withColumn("end", F.sum(F.col("before") + F.col("size")).over(so_far)).filter("size > 0")
    return each.select("_row", "rule", "rank", "label", "sure", (F.col("end") - F.col("size")).alias("start"), "end")


def unsuppressed(found: DataFrame) -> DataFrame:
    """Detections of ``found`` that lie in none which goes before them; base rules stay as they are.

    Whatever holds an interval begins before it, or with it and ends later, so one pass by start with the furthest end of
    every rank so far decides all of them.
    """
    order = Window.partitionBy("_row").orderBy("start", F.desc("end"), "rank", "rule")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = [F.max(F.when(F.col("rank") <= rank, F.col("end"))).over(before).alias(f"_end{rank}") for rank in range(BASE)]
    reached = F.coalesce(*[F.when(F.col("rank") == rank, F.col(f"_end{rank}")) for rank in range(BASE)])
    seen = found.select("*", *ends)
    return seen.filter(F.coalesce(reached < F.col("end"), F.lit(True))).select(*found.columns)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Signature, ...] = RULES) -> DataFrame:
    """(id, n_words, detections): array<struct<start, end, label, base, sure>> of every text, by start, end and label."""
    keys = sorted({r.keywords[0] for r in rules})
    held = F.array_intersect(F.split("_words", " "), F.lit(keys))
    rows = docs.select(F.col(id_col).alias("_id"), word_string(text_of(text_col)).alias("_words"))
    rows = rows.select("_id", "_words", held.alias("_keys"))
    marked = rows.select(
        F.monotonically_increasing_id().alias("_row"),
        "_id",
        words_in(F.col("_words")).alias("n_words"),
        F.when(F.size("_keys") > 0, F.col("_words")).alias("_words"),
        "_keys",
    )
    marked = settle(marked, "words")
    found = unsuppressed(detections(marked, rules))
    each = F.struct("start", "end", "label", (F.col("rank") == BASE).alias("base"), "sure")
    grouped = found.groupBy("_row").agg(F.array_sort(F.collect_set(each)).alias("detections"))
    out = marked.select("_row", "_id", "n_words").join(grouped, "_row", "left")
    none = F.array().cast(grouped.schema["detections"].dataType)
    return out.select(F.col("_id").alias(id_col), "n_words", F.coalesce("detections", none).alias("detections"))
