import random

import pytest
from pyspark.sql import functions as F

from sigloom import scale


@pytest.mark.parametrize("kind", ["spread", "ties", "one", "few"])
def test_selection_equals_a_sort(spark, monkeypatch, kind):
    """Exact first rows whatever the scores: all different, few values, a single value, fewer rows than asked for."""
    monkeypatch.setattr(scale, "DIRECT_K", 5)
    draw = random.Random(kind)
    score = {"spread": lambda: round(draw.random() * 50, 6), "ties": lambda: float(draw.randint(0, 3)), "one": lambda: 2.5, "few": draw.random}[kind]
    size = 20 if kind == "few" else 900
    rows = [("abc"[i % 3], f"w{draw.randint(0, 10**6):06d}{i}", score()) for i in range(size)] + [("d", "é", 1.0), ("d", "", 0.0), (None, "x", 1.0)]
    df = spark.createDataFrame(rows, "topic string, term string, score double").repartition(4)
    order, digits = [F.desc("score"), F.asc("term")], [*scale.score_digits("score"), *scale.name_digits("term")]
    for k in (6, 40, 290):
        want = {(t, i + 1, w) for t in [*"abcd", None] for i, (_, w) in enumerate(sorted((-s, w) for x, w, s in rows if x == t)[:k])}
        got = scale.top_per_group(df, ["topic"], order, k, ["term"], digits=digits)
        assert {(r.topic, r.rank, r.term) for r in got.collect()} == want
        held = scale.select_first(df, ["topic"], digits, k)
        assert held.count() <= 5 * (1 + scale.SPARE) * k
        flat = [w for _, w in sorted((-s, w) for _, w, s in rows)[:k]]
        assert [r.term for r in scale.top_n(df, order, k, ["term"], digits).collect()] == flat


def test_selection_of_nothing(spark):
    df = spark.createDataFrame([], "topic string, term string, score double")
    assert scale.select_first(df, ["topic"], scale.score_digits("score"), 3).count() == 0
    assert scale.select_first(df, [], scale.score_digits("score"), 3).count() == 0


def test_discarded_tables_leave_no_files(spark):
    import os

    kept, gone = scale.settle(spark.range(3)), scale.settle(spark.range(4))
    path = scale._paths[gone]
    scale.discard(gone)
    assert not os.path.exists(path) and kept.count() == 3


def test_settled_tables_leave_no_shuffle_files(spark):
    import time

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in files.mkString("\n").split("\n") if "shuffle_" in name}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = shuffled(), spark.conf.get(name, None)
    table = scale.settle(spark.range(1000).repartition(4, "id"))
    end = time.time() + 10
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before and table.count() == 1000 and spark.conf.get(name, None) == held
