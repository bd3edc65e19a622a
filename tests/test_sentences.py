from sigloom.operators import sentences


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_abbreviations_are_learned_and_do_not_end_sentences(spark):
    texts = [
        "We met approx. nine people. They left. See cf. the note.",
        "It took approx. two hours! Did it? Yes.\n\nNext cf. page four (end.) Then more.",
        "About approx. ten. J. Smith wrote cf. this. It was fine",
        "They left early. He left. She left. all left",
    ]
    words = sentences.word_rows(frame(spark, texts))
    assert {r.core: (r.n_period, r.n_plain, r.n_small) for r in sentences.abbreviations(words).collect()} == {"approx": (3, 0, 3), "cf": (3, 0, 3)}
    got = {}
    for r in sorted(sentences.split_by_statistics(frame(spark, texts)).collect()):
        got.setdefault(r.doc_id, []).append(r.sentence)
    assert got == {
        0: ["We met approx. nine people.", "They left.", "See cf. the note."],
        1: ["It took approx. two hours!", "Did it?", "Yes.", "Next cf. page four (end.)", "Then more."],
        2: ["About approx. ten.", "J. Smith wrote cf. this.", "It was fine"],
        3: ["They left early.", "He left.", "She left.", "all left"],
    }


def test_odd_texts(spark):
    rows = frame(spark, ["", None, "\n \n", "...", "one", "3.14 is pi. 2 too."])
    got = sorted((r.doc_id, r.sent_no, r.sentence) for r in sentences.split_by_statistics(rows).collect())
    assert got == [(3, 0, "..."), (4, 0, "one"), (5, 0, "3.14 is pi."), (5, 1, "2 too.")]
    assert sentences.split_by_statistics(rows.limit(0)).count() == 0


def test_words_are_dealt_once(spark, monkeypatch):
    """Repeated and null keys share their numbers, sentences go over batches, and no window or list of words is made."""
    monkeypatch.setattr(sentences, "LEAST", 1)
    texts = [(1, "One. Two\nThree four"), (1, "One. Two\nThree four"), (None, "Ab cd. " * 30), (2, "x " * 50 + "etc. yy. " + "Z " * 9)]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = sentences.split_by_statistics(rows)
        got = sorted((r.doc_id or 0, r.sent_no, r.sentence) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [(0, i, "Ab cd.") for i in range(30)]
    # The words of a place stay together, as the sum over peers has it.
    want += [(1, 1, "One. One."), (1, 2, "Two Two"), (1, 4, "Three Three four four")]
    want += [(2, 0, "x " * 50 + "etc. yy."), (2, 1, " ".join("Z" * 9))]
    assert got == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
