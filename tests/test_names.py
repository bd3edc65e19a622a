import random
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest

from sigloom.operators import names


def brute(words, phrases):
    listed = {}
    for text, tag in phrases:
        key = tuple(text.split())
        if key and tag is not None:
            listed[key] = min(tag, listed.get(key, tag))
    out, at = [], 0
    while at < len(words):
        for size in range(len(words) - at, 0, -1):
            if tuple(words[at : at + size]) in listed:
                out.append((at, size, " ".join(words[at : at + size]), listed[tuple(words[at : at + size])]))
                at += size
                break
        else:
            at += 1
    return out


@pytest.mark.parametrize("part", [1000, 3])
def test_names_equal_a_search_from_every_place(spark, part):
    draw = random.Random(part)
    texts = [[draw.choice("abc") for _ in range(draw.randint(0, 30))] for _ in range(60)] + [None, ["é"] * 5]
    phrases = [(" ".join(draw.choices("abc", k=draw.randint(1, 5))), draw.choice("XYZ")) for _ in range(14)]
    phrases += [("", "X"), ("  ", "Y"), ("a b", None), ("é  é", "E")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, tokens array<string>")
    table = spark.createDataFrame(phrases, "phrase string, tag string")
    got = {}
    for r in sorted(names.find_names(docs, table, part=part).collect()):
        got.setdefault(r.doc_id, []).append((r.start, r.words, r.phrase, r.tag))
    assert got == {i: want for i, t in enumerate(texts) if (want := brute(t or [], phrases))}


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, ["a"])], "doc_id long, tokens array<string>")
    assert names.find_names(docs, spark.createDataFrame([], "phrase string, tag string")).count() == 0


def test_a_task_holds_few_texts_and_small_states():
    """A batch is worked on in pieces, and a phrase costs the automaton a few hundred bytes."""
    rows = [{"words": [f"a{i}", f"b{i % 997}", f"c{i}"], "tag": "T"} for i in range(20_000)]
    tracemalloc.start()
    automaton = names.Automaton((r["words"], r["tag"]) for r in rows)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 700 * len(rows) and automaton.matches(["x", "a5", "b5", "c5", "a6"]) == [(1, 3, "T")]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("tag", pa.string())]))
    batch = pa.record_batch([pa.array(range(1000)), pa.array([["a1", "b1", "c1"]] * 1000), pa.array([[]] * 1000, kind)], names=["doc_id", "_t", "_m"])
    found = list(names._finder(SimpleNamespace(value=names._packed(rows)), 1, True)(iter([batch])))
    assert max(b.num_rows for b in found) <= 200 and sum(b.num_rows for b in found) == 1000
    assert all(m == [{"start": 0, "words": 3, "tag": "T"}] for b in found for m in b.column("_m").to_pylist())
