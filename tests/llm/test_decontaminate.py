import random
import re

from llm.leak_rule import item_windows, leaked
from pyspark.sql import functions as F
from sigloom.llm import decontaminate, queries
from sigloom.llm.decontaminate import Words

ITEM = "Anna drove 120 km in 2 hours with her old car. What was the mean speed of the car in km per hour then?"


def read(text):
    words = Words([text])
    return [(words.value(i), int(words.kinds[i])) for i in range(len(words.codes))]


def test_template_words():
    assert read("Élan paid 3,141.59 dollars. Bob met «Éva» — AT 5 km") == [
        ("élan", 0), ("paid", 0), ("3,141.59", 1), ("dollars", 3), ("bob", 0), ("met", 0), ("éva", 2), ("at", 0), ("5", 1), ("km", 3),
    ]
    assert read("") == read(" ..\n") == []
    assert [c for c in Words(["ÀB cd"]).codes] == [c for c in Words(["àb CD"]).codes]


def leaks(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string, hash int")
    found = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    return sorted(((r.doc_id, r.item_id, r.exact) for r in found), key=str)


def test_copies_new_parameters_and_loose_slots(spark):
    other = ITEM.replace("Anna", "Maria").replace("120", "95").replace("2 hours", "3 hours")
    mixed = "foo bar " + ITEM.upper().replace(" ", " | ") + " baz"
    rows = [
        (1, "Some words before. " + ITEM + " And after.", "x", 1),
        (2, "before Anna " + other, "x", 2),
        (3, mixed, None, 3),
        (4, "Anna drove a car and asked what the mean speed was in km per hour, for 2 hours", "x", None),
        (5, None, "x", 5),
        (5, "", "x", 5),
        (None, ITEM, "x", 6),
        (7, ITEM, "x", 7),
        (7, ITEM, "x", 7),
        (8, "w " * 60_000 + ITEM, "y", 8),
        (9, "to it", "y", 9),
    ]
    items = [(10, ITEM), (11, "to it"), (12, None), (13, "")]
    got = leaks(spark, rows, items)
    assert got == sorted([(1, 10, True), (2, 10, False), (3, 10, True), (None, 10, True), (7, 10, True), (7, 10, True), (8, 10, True)], key=str)
    assert leaks(spark, rows, items[1:]) == [] and leaks(spark, [], items) == []


def test_values_must_agree_along_an_alignment(spark):
    item = "if 4 birds sit on 4 wires and 4 more come then how many of them sit there now"
    good = item.replace("4", "7")
    bad = item.replace("4", "7", 1)
    assert leaks(spark, [(1, good, "", 1), (2, bad, "", 1)], [(1, item)]) == [(1, 1, False)]


PROSE = "the old miller carried three sacks of grain over the narrow bridge while his dog slept near the warm oven and nobody in that quiet village heard the river rise before dawn came slowly"


def test_planted_passages_of_an_item(spark):
    """A run of 13 words of a longer item is a leak wherever it is cut; 12 words of 32 are not."""
    words = PROSE.split()
    rows = [(i, "some text " + " ".join(words[i : i + 13]) + " more text", "", 1) for i in range(len(words) - 12)]
    rows += [(100 + i, " ".join(words[i : i + 12]), "", 1) for i in range(len(words) - 11)]
    assert leaks(spark, rows, [(1, PROSE)]) == sorted(((i, 1, True) for i in range(len(words) - 12)), key=str)


def test_copies_with_one_changed_word(spark):
    """Any one word of an item of 12 or more words may be changed, left out or doubled."""
    rows, items = [], []
    for n in (12, 13, 15, 16, 17, 20, 32):
        words = PROSE.split()[-n:]
        items.append((n, " ".join(words)))
        for i in range(n):
            edits = (["changed"], [], [words[i], words[i], "really"])
            rows += [(1000 * n + 10 * i + k, " ".join(["so", *words[:i], *e, *words[i + 1 :], "yes"]), "", 1) for k, e in enumerate(edits)]
    for n, text in items:
        own = [r for r in rows if r[0] // 1000 == n]
        assert [i for i, _, _ in leaks(spark, own, [(n, text)])] == sorted((r[0] for r in own), key=str)


def test_case_and_marks_do_not_count(spark):
    """Copies that keep the words are found, in any case and with any marks between the words, and only those."""
    item = "Yes. Élise met Tom. Then they went to Rome by train. Who paid? Tom did. How much, in euros, did Élise owe him? Ten."
    bare = re.sub(r"[^\w ]", "", item)
    mixed = " ".join(w.title() if i % 3 else w.lower() for i, w in enumerate(bare.split()))
    named = bare.replace("Tom", "Max").replace("Élise", "Ida")
    forms = [item, bare, item.lower(), item.upper(), item.title(), bare.title(), mixed, item.replace(" ", "! "), item.replace(".", ";")]
    rows = [(i, lead + form + " ok", "", 1) for i, (form, lead) in enumerate((f, x) for f in [*forms, named] for x in ("", "by ", "Go. "))]
    rows += [(100, "Nobody. Knows what went on there. Who cared? Few did. How many, in truth, did she ask? One.", "", 1)]
    found = leaks(spark, rows, [(1, item)])
    assert sorted(i for i, _, _ in found) == list(range(30))
    assert all(exact == (i < 27) for i, _, exact in found)


def test_lists_of_numbers_are_not_passages(spark):
    item = "Add 1 2 3 4 5 6 7 8 9 10 11 12 13 14 and then tell us in plain words what the whole long sum of all these numbers would have to be"
    other = "Lines 21 22 23 24 25 26 27 28 29 30 31 32 33 34 were lost"
    same = "See 1 2 3 4 5 6 7 8 9 10 11 12 13 14 there"
    assert [i for i, _, _ in leaks(spark, [(1, other, "", 1), (2, same, "", 1)], [(1, item)])] == [2]


def test_filter_keeps_columns(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, "clean", "b"), (3, None, "c")], "doc_id long, text string, _h1 string")
    kept = decontaminate.without_leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_windows_of_numbers_join_by_their_values(spark):
    """Texts of numbers against lists of numbers: what is joined stays in proportion to what is held."""
    draw = random.Random(5)
    rows = [(i, " ".join(str(draw.randint(1, 99)) for _ in range(1500)), "", 1) for i in range(12)]
    items = [(i, "Sort these: " + " ".join(str(draw.randint(1, 99)) for _ in range(24)) + " please") for i in range(25)]
    rows.append((50, "look " + items[3][1][12:], "", 1))
    assert [(d, i) for d, i, _ in leaks(spark, rows, items)] == [(50, 3)]
    texts = spark.createDataFrame([(t,) for _, t, _, _ in rows], "_text string")
    grams = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id long, text string"))
    held = texts.select(decontaminate.windows(F.col("_text"), [8]).alias("_w")).select(F.explode("_w.hash").alias("hash"))
    assert held.join(grams, "hash").count() < 2000


def variants(items, draw):
    """Items as other texts may hold them."""
    for _, text in items:
        own = text.split()
        at = draw.randrange(len(own))
        yield "So. " + text + " End."
        yield " ".join(own[:at] + own[at + 1 :])
        yield re.sub(r"\d+", lambda m: str(int(m[0]) + 1), text)
        yield "By " + re.sub(r"[^\w ]", "", text).title()
        yield "see " + " ".join(own[at : at + draw.randint(8, 16)]) + " there"
        yield re.sub(r"\b[A-Z][a-z]+", "Zoe", text)


def test_query_against_brute_force(spark, tmp_path):
    """All pairs of the given tables and of planted variants, and no others, by the rule stated anew."""
    sf = "/root/testdata/sf0.01"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    planted = [(10_000 + i, t) for i, t in enumerate(variants(items, random.Random(2)))]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + planted
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    index = item_windows(items)
    want = {(d, item) for d, text in docs for item in leaked(text, index)}
    got = [(r.doc_id, r.item_id) for r in queries.op4_decontamination(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # Recall on what was planted: whole items with other marks or one word less.
    whole = [(10_000 + 6 * n + k, item) for n, (item, _) in enumerate(items) for k in (0, 1, 3)]
    assert sum(x in want for x in whole) / len(whole) > 0.95
