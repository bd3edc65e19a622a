import random

import numpy as np
import pytest
import xxhash

from sigloom.llm import queries, simhash
from sigloom.llm.components import connected_components


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks, ids, most=3):
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = x if least.get(r) is None else least[r] if x is None else min(x, least[r])
    return [least[find(i)] for i in range(len(marks))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One two", "A a A a A a a", "Éa É b c\x0bd e f", "x " * 3000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    marks = [brute_fingerprint(d.text) for d in docs]
    groups = brute_components(marks, [d.doc_id for d in docs])
    got = queries.op7_simhash_dedup(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted((d.doc_id, f"{m:016x}", g) for d, m, g in zip(docs, marks, groups, strict=True))


def test_links_against_all_pairs(spark, monkeypatch):
    draw = random.Random(7)
    marks = {draw.getrandbits(64) for _ in range(60)}
    for mark in list(marks):
        for _ in range(6):
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                mark ^= 1 << bit
            marks.add(mark)
    marks = sorted(marks)
    signed = [int(np.uint64(m).astype(np.int64)) for m in marks]
    monkeypatch.setattr(simhash, "TILE", 3)
    edges = simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long"))
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in edges.collect())
    joined = dict(map(tuple, connected_components(edges).collect()))
    want = brute_components(marks, list(range(len(marks))))
    names = [joined.get(s, s) for s in signed]
    assert all((names[i] == names[j]) == (want[i] == want[j]) for i in range(len(marks)) for j in range(i))


def crowd(n, seed=3):
    """Fingerprints that share a half."""
    draw = random.Random(seed)
    return [(int(np.uint64(0xABCDEF0100000000 | x).astype(np.int64)),) for x in draw.sample(range(1 << 32), n)]


def test_crowded_entries_stay_in_proportion(spark, monkeypatch):
    counts = {}
    held = []
    settle = simhash.settle

    def counted(df, label="table"):
        out = settle(df, label)
        held.append(out.count())
        return out

    monkeypatch.setattr(simhash, "settle", counted)
    monkeypatch.setattr(simhash, "TILE", 512)
    for n in (2000, 8000):
        held.clear()
        marks = simhash.settle(spark.createDataFrame(crowd(n), "fp long"))
        simhash.links(marks).collect()
        counts[n] = sum(held[1:])
    assert counts[8000] < 64 * 8000 and counts[8000] < 5 * max(counts[2000], 8000)


def test_a_ball_of_near_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 5)
    draw = random.Random(9)
    core = draw.getrandbits(64)
    marks = sorted({core ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in (draw.choices(range(64), k=3) for _ in range(150))})
    signed = [int(np.uint64(m).astype(np.int64)) for m in marks]
    joined = dict(map(tuple, connected_components(simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long"))).collect()))
    want = brute_components(marks, list(range(len(marks))))
    names = [joined.get(s, s) for s in signed]
    assert all((names[i] == names[j]) == (want[i] == want[j]) for i in range(len(marks)) for j in range(i))


def test_edges_of_the_input(spark):
    rows = [(5, "a b c d e", "x"), (5, "a b c d e", "x"), (None, "a b c d e", "y"), (3, None, None), (2, "", "z"), (9, "w " * 9000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumnRenamed("fp", "component")
    got = simhash.simhash_groups(docs).collect()
    assert sorted(((r.doc_id, r.component) for r in got), key=str) == sorted(
        [(5, 5), (5, 5), (None, 5), (3, 2), (2, 2), (9, 9)], key=str
    )
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(rows, "a long, b long"))
    assert got.count() == 301 + 200
    assert got.groupBy("label").count().count() == 2
