import re

from sigloom.llm import licences
from sigloom.llm.text_queries import op11_license_scans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, rules=licences.RULES):
    """Every rule on every text, without keywords; each detection is held against all others."""
    words = words_of(text)
    line = "".join(f" {w} " for w in words)
    found = []
    for i, rule in enumerate(rules):
        for m in re.finditer(rule.expression, line, re.ASCII):
            found.append((rule.rank, i, rule.label, line[: m.start()].count(" ") // 2, line[: m.end()].count(" ") // 2))

    def inside(d, e):
        if e is d or not (e[3] <= d[3] and e[4] >= d[4]):
            return False
        return e[0] < d[0] or e[0] == d[0] and ((e[3], e[4]) != (d[3], d[4]) or e[1] < d[1])

    kept = [d for d in found if d[0] == licences.BASE or not any(inside(d, e) for e in found)]
    return len(words), sorted((d[3], d[4], d[2], d[0] == licences.BASE) for d in kept)


TEXTS = [
    None,
    "",
    "...",
    "All rights reserved. ALL RIGHTS RESERVED all rights, reserved",
    "Licensed under CC BY-NC 4.0. cc by cc by",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU Lesser General Public License v2.1; the GNU Affero General Public License version 3.0",
    "SPDX-License-Identifier: Apache-2.0\nreleased under the terms of the MIT License, or the MIT licence",
    "https://creativecommons.org/licenses/by-sa/4.0/ and Creative Commons Attribution-ShareAlike 4.0 International License",
    "permission is hereby granted, free of charge, to any person obtaining a copy; committed to permit mitigation",
    "über all rights reserved été cc by cc by",
    "Unauthorized copying of this file, via any medium, is strictly prohibited. Copyright (c) 2019 2021",
    "the noncommercial cc by cc by nc nd 4 0 x " * 300,
]


def sample(pattern):
    """One text that a pattern matches: the first alternatives, all optional parts left out."""
    inner = re.compile(r"\(\?:([^()]*)\)(\?|\{0,\d\})?")
    while inner.search(pattern):
        pattern = inner.sub(lambda m: "" if m[2] else m[1].split("|")[0], pattern)
    pattern = re.sub(r"[^ ]\?| \?", "", pattern)
    return pattern.replace("[cs]", "s").replace(r"\d", "0").replace(r"\w+", "x").replace(r"\S+", "x")


def test_places_and_suppression_equal_brute_force(spark):
    texts = TEXTS + [f"a {sample(r.pattern)} b" for r in licences.RULES]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, TEXTS[3], "y"), (None, TEXTS[3], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = licences.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    missed = 0
    for i, text in enumerate(texts):
        count, want = brute(text)
        assert by_id[i].n_words == count
        assert sorted((d.start, d.end, d.label, d.base) for d in by_id[i].detections) == want
        missed += not want
    # Every rule's own words are found, so no keyword hides a rule.
    assert missed <= 4
    assert {len(r.detections) for r in got if r.doc_id is None} == {3}


def test_keywords_stand_in_every_match():
    for rule in licences.RULES:
        line = sample(rule.pattern)
        assert re.fullmatch(rule.expression, "".join(f" {w} " for w in line.split())), (rule, line)
        assert set(rule.keywords) <= set(line.split()), (rule, line)
    assert len(licences.RULES) > 200


def test_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, _row int, n_words int, label string, rule int")
    assert licences.scan_licenses(docs).collect() == []
    docs = spark.createDataFrame([(1, "mit license", 5, 5, "z", 1)], docs.schema)
    assert [d.label for d in licences.scan_licenses(docs).first().detections] == ["mit"]


def test_query_counts_base_places(spark, tmp_path):
    rows = [(1, "cc by CC-BY all rights reserved"), (2, None), (3, "released under the MIT license")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11_license_scans(spark, str(tmp_path)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (7, 3, 0, 4, "cc-by,reserved")
    assert (got[2].n_words, got[2].n_base, got[2].first_word, got[2].labels, got[2].score) == (0, 0, None, "", 0.0)
    assert (got[3].n_base, got[3].base_labels, got[3].labels, got[3].score) == (0, "", "mit", 0.95)
