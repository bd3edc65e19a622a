import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sigloom.llm import align
from sigloom.llm.text_queries import op12_token_alignment

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "The quick brown fox jumps over the lazy dog.",
    "été à l'école <|endoftext|> </s>  two  spaces\n\nand lines\t",
    "日本語のテキスト 🙂🙂 naïve",
    "a ▁ mark",
    "zero\u0000byte",
    "x",
    " ",
    "",
    None,
    "word " * 3000,
    "a" * 4000,
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(align.A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=align.B_PATH)


def tokens_of(text, libraries):
    """(id, start, end) of both tokenizations by the public libraries, byte by byte; none if one of them is not exact."""
    if not text:
        return [], []
    a, b = libraries
    whole = (" " + text).encode()
    letters = align.byte_of_letter()
    raw_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    raw_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        raw_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else b"" if i < 3 else piece.replace("▁", " ").encode()))
    out = []
    for raw in (raw_a, raw_b):
        if b"".join(r for _, r in raw) != whole:
            return [], []
        ends = np.cumsum([len(r) for _, r in raw]).tolist()
        out.append([(i, e - len(r), e) for (i, r), e in zip(raw, ends, strict=True)])
    return out


def brute(texts, libraries):
    tokens = [tokens_of(t, libraries) for t in texts]
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in tokens]
    counts = Counter(pair for own in links for pair in set(own))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    for (a, b), own in zip(tokens, links, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        sides = [[[str(x[0]) for x in side if lo < x[2] <= hi] for side in (a, b)] for lo, hi in zip([0, *cuts], cuts)]
        told = ";".join("|".join(map(",".join, group)) for group in sides)
        digest = hashlib.sha256(told.encode()).hexdigest() if told else ""
        best = sum(counts[p] == most[p[0]] for p in own)
        yield (len(a), len(b), len(cuts), len(own), best, sum(counts[p] for p in own), digest, sum(len(x) * len(y) for x, y in sides))


def test_query_equals_the_libraries(spark, tmp_path, libraries):
    texts = TEXTS[:-2] + ["word " * 60, "a" * 300]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, TEXTS[0])] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]
    got = sorted((tuple([r.doc_id if r.doc_id is not None else -1, *(r[c] for c in columns)]) for r in op12_token_alignment(spark, str(tmp_path)).collect()))
    want = sorted((-1 if i is None else i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], libraries), strict=True))
    assert got == want
    assert sum(w[1] > 0 for w in want) >= 8


def test_counts_do_not_depend_on_the_join(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, row int")

    def rows():
        return sorted((r.doc_id, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in align.align(docs).collect())

    broadcast = rows()
    monkeypatch.setattr("sigloom.scale.BROADCAST_ROWS", 0)
    assert rows() == broadcast
    assert align.align(docs.limit(0)).collect() == []


def test_gustavson_product_equals_dense():
    rng = np.random.default_rng(5)
    for _ in range(20):
        x, y = rng.integers(0, 3, (7, 11)), rng.integers(0, 3, (11, 5))

        def rows(m):
            at = np.nonzero(m)
            out = align.Rows.of_places(at[0], at[1], *m.shape)
            out.values = m[at].astype(np.int64)
            return out

        def dense(r):
            out = np.zeros((len(r.starts) - 1, r.width), dtype=np.int64)
            out[r.rows(), r.columns] = r.values
            return out

        assert np.array_equal(dense(rows(x).times(rows(y))), x @ y)
        assert np.array_equal(dense(rows(x).transposed()), x.T)
