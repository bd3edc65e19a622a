import itertools
import random

import numpy as np

from sigloom.llm import queries, toxicity
from sigloom.llm.toxicity import Model, Scorer


def test_marginals_against_all_paths():
    draw = np.random.default_rng(3)
    start, moves = 0.4, draw.normal(size=(2, 2))
    lengths = np.array([1, 4, 5, 2])
    emissions = draw.normal(size=(4, 5))
    got = toxicity.marginals(emissions, lengths, start, moves)[0]
    for row, n in enumerate(lengths):
        mass, toxic = 0.0, np.zeros(5)
        for path in itertools.product((0, 1), repeat=int(n)):
            score = start * path[0] + sum(emissions[row, i] for i in range(n) if path[i])
            weight = np.exp(score + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            mass += weight
            toxic[:n] += weight * np.array(path)
        assert np.allclose(got[row], toxic / mass)


def test_plain_and_padded_sentences_agree():
    model = Model(weights={"bad": 6.0}, bias=-3.0, moves=np.array([[0.3, -1.0], [0.2, 0.5]]), start=-0.5)
    scorer = Scorer(model)
    text = "all fine here. some bad word! fine\nfine fine fine, bad bad"
    together = scorer.evidence([text, "all fine here", "", "..."])[1]
    alone = np.concatenate([scorer.evidence([part])[1][0] for part in ("all fine here", "some bad word", "fine", "fine fine fine, bad bad")])
    assert np.allclose(together[0], alone)
    assert [len(x) for x in together] == [12, 3, 0, 0]
    spans = scorer.score([text])["spans"][0]
    assert [text[a:b] for a, b, _ in spans] == ["bad", "bad", "bad"]


def corpus(n=400):
    draw = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("lo", "mi", "nu")]
    rows = []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randint(5, 60))]
        toxic = i % 4 == 0
        for _ in range(draw.randint(2, 4) * toxic):
            text.insert(draw.randrange(len(text)), draw.choice(["idiot", "scumbag", "rotter"]))
        rows.append((i, " ".join(text) + ".", int(toxic)))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = corpus()
    more = [(901, None, 1), (902, "", 0), (903, "x", None), (None, "y", 1), (1, "again", 0), (1, rows[1][1], 0)]
    train = spark.createDataFrame(rows[:300] + more, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(train.select("doc_id", "text"), train)
    docs = spark.createDataFrame(
        [(r[0], r[1], "a") for r in rows[300:]] + [(None, "idiot", "b"), (-1, None, "b"), (-2, "", None), (-2, "", None), (-3, "ok " * 50_000, "c")],
        "doc_id long, text string, score string",
    )
    got = {}
    for r in toxicity.score_toxicity(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(got[i][0].predicted == t for i, _, t in rows[300:]) >= 97
    assert len(got[-2]) == 2 and got[-1][0].predicted == got[-2][0].predicted == got[-3][0].predicted == 0
    assert all(0 <= r.score <= 1 for own in got.values() for r in own) and got[-1][0].spans == []
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    alone = toxicity.fit_toxicity(train, train.filter("toxic = 0"))
    assert not toxicity.fit_toxicity(train.limit(0), train.limit(0)).weights
    assert toxicity.score_toxicity(docs, alone).filter("predicted = 1").count() == 0


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").filter("held_out and toxic is not null").collect()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows) > 0
