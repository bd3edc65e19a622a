import hashlib
import random
from collections import Counter

import numpy as np

from sigloom.llm import layout_queries, repeats


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(draw):
    letters = "abcdeé "

    def words(n):
        return "".join(draw.choice(letters) for _ in range(n))

    shared = [words(draw.randint(20, 90)) for _ in range(6)]
    texts = [None, "", "short", "x" * 300, "ab" * 200, words(500) * 2]
    for _ in range(60):
        texts.append(words(draw.randint(0, 60)) + "".join(draw.choice(shared) + words(draw.randint(0, 9)) for _ in range(draw.randint(0, 5))))
    base = words(400)
    for _ in range(8):
        at = draw.randrange(400)
        texts.append(base[:at] + words(3) + base[at + 2 :])
    return texts + texts[10:20] + [base] * 4


def crowded(draw, n, size):
    """Texts with one passage in other surroundings: nearly a window long, so that some windows come back."""
    letters = "abcdefgh"
    passage = "".join(draw.choices(letters, k=size))
    return ["".join(draw.choices(letters, k=50)) + passage + draw.choice(letters) * draw.randint(0, 3) + "".join(draw.choices(letters, k=50)) for _ in range(n)]


def held(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = repeats.drop_repeats(docs, **options).collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_against_brute_force(spark, monkeypatch):
    for seed, options in ((1, {}), (2, {"bucket": 1}), (3, {"bucket": 3})):
        texts = corpus(random.Random(seed))
        assert held(spark, texts, width=40, gram=9, **options) == brute(texts, 40), (seed, options)


def test_crowded_buckets_are_dealt_again(spark, monkeypatch):
    counts = []
    settle = repeats.settle

    def counted(df, label="table"):
        out = settle(df, label)
        counts.append((label, out.count()))
        return out

    monkeypatch.setattr(repeats, "settle", counted)
    for size in (30, 37, 39, 41, 60):
        for option in (1, 20):
            texts = crowded(random.Random(size), 300, size) + corpus(random.Random(size))[:30]
            counts.clear()
            assert held(spark, texts, width=40, gram=9, bucket=option) == brute(texts, 40), (size, option)
            cut = dict(counts)["surroundings"]
            # One piece of a text at a time can be in doubt, and a pass makes two of it.
            assert all(n <= 2 * cut for label, n in counts if label == "halves")
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", 0)
    assert held(spark, texts, width=40, gram=9, bucket=5) == brute(texts, 40)


def test_long_texts_in_parts():
    data = np.frombuffer(("abcdefgh" * 50 + "".join(random.Random(4).choices("abcdef", k=900))).encode(), dtype=np.uint8)
    whole = repeats.anchors(data, np.array([len(data)]), 40, 9)
    want = {(s, int(p), int(d)) for lo, hi, p, d in zip(*whole[1:5], strict=True) for s in range(lo, hi + 1)}
    got = set()
    for at in range(0, len(data) - 39, 100):
        part = data[at : at + 139]
        own = repeats.anchors(part, np.array([len(part)]), 40, 9)
        got |= {(s + at, int(p) + at, int(d)) for lo, hi, p, d in zip(*own[1:5], strict=True) for s in range(lo, hi + 1)}
    assert got == want


def test_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "y" * 250), (None, None), (1, "z" * 10)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed) for r in repeats.drop_repeats(docs).collect()) == [(0, 0), (10, 0), (250, 250)]
    assert repeats.drop_repeats(docs.limit(0)).count() == 0


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in layout_queries.op5_suffix_dedup(spark, sf).collect()}
    assert got == dict(zip(texts, brute(list(texts.values()), 200), strict=True))
