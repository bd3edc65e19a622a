import hashlib
import random
import re
import zlib

import pytest

from sigloom.llm import periods
from sigloom.llm.text_queries import op13_periodic_runs


def brute(words, repeats=4, least=6):
    """All runs by comparing the words of every lag, and what is left without their repeats."""
    runs = []
    for q in range(1, len(words) // repeats + 1):
        at = 0
        while at + q < len(words):
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            size = at - start + q
            if at > start and size >= max(least, repeats * q):
                piece = words[start : start + size]
                if not any(q % d == 0 and piece[d:] == piece[:-d] for d in range(1, q)):
                    runs.append((start, size, q))
            at = max(at, start + 1)
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def wordy(rng):
    letters, words = "abcde"[: rng.choice([1, 2, 2, 3, 5])], []
    while len(words) < rng.randint(0, 150):
        if rng.random() < 0.4:
            period = [rng.choice(letters) for _ in range(rng.randint(1, 20))]
            words += (period * 9)[: rng.randint(len(period), 9 * len(period))]
        else:
            words += [rng.choice(letters) for _ in range(rng.randint(0, 10))]
    return " ".join(words)


@pytest.mark.parametrize("repeats, least", [(4, 6), (3, 1), (5, 12)])
def test_runs_equal_brute_force(spark, repeats, least):
    rng = random.Random(7)
    texts = [wordy(rng) for _ in range(150)] + [None, "", " \n ", "x", "a " * 5000, "a\x1cb " * 4, "é é " * 7]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "b " * 9, 2)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = periods.find_runs(docs, repeats=repeats, least=least).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", (texts[r.doc_id] if r.doc_id is not None else "b " * 9) or "")
        runs, kept = brute(words, repeats, least)
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(words), runs, kept)


def test_many_overlapping_stretches_stay_linear():
    import numpy as np

    # A word that stands everywhere, and a period that comes back after other text.
    words = np.array(([1] * 50 + [2]) * 400 + [3] + [1, 2] * 4000, dtype=np.int64)
    own, start, length, period = periods.word_runs(words, np.array([len(words)]))
    assert [(s, n, q) for s, n, q in zip(start, length, period) if q > 1] == [(0, 51 * 400, 51), (20401, 8000, 2)]
    assert sum(q == 1 for q in period) == 400


def test_empty_table_and_repeats(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periods.find_runs(docs).collect() == []
    with pytest.raises(ValueError):
        periods.find_runs(docs, repeats=2)


def test_query_equals_the_contract(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, wordy(rng) if i % 3 else " ".join(map(str, range(i)))) for i in range(300)] + [(301, None), (None, "c " * 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    made = 0
    for i, text in rows:
        words, n = (text or "").split(), len((text or "").split())
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (j - a) % p] for j in range(a, n)]
            made += 1
        runs, kept = brute(words)
        told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        milli = best[1] * 1000 // best[2] if runs else None
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, milli)
        assert r.runs_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert made > 10
