import hashlib
import random

import pytest
import sentencepiece

from sigloom.llm import pieces, queries
from sigloom.llm.pieces import SPACE, Vocabulary

ODD = [
    "", " ", "  ", "a", "  Hello  world\n é ", "\n", "\t\tx", "日本語 ☃🙂 ok", "<s> </s> <unk> <0x41>", "x" * 5000, " " * 37 + "hello  ", "the" * 3000,
    " a" * 1000, "\u0000 b", "naïve ÉTÉ 'quoted' it's",
]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model()


def unigram(model):
    """The same file, marked as a unigram vocabulary."""
    at = model.rfind(b"\x18\x02 \x80\xfa\x01")
    return model[: at + 1] + b"\x01" + model[at + 2 :]


def test_same_ids_as_the_library(model, spark, sf):
    own, library = Vocabulary(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    draw = random.Random(1)
    texts += ["".join(draw.choice("ab cdeéß☃日\n\t  .,'🙂tionthe") for _ in range(draw.randint(0, 40))) for _ in range(500)]
    got = [x.tolist() for x in own.encode_all(texts)]
    assert got == library.encode(texts)
    assert [own.decode(x) for x in got] == texts


def test_best_scores_in_unigram_mode(model):
    """Words alone, where the library's single precision still tells scores apart."""
    own, library = Vocabulary(unigram(model)), sentencepiece.SentencePieceProcessor(model_proto=unigram(model))
    assert not own.bpe
    for word in ["the", "and", "with", "withthe", "tion", "nothing", "retitioning", "internationalization", "zxqj"]:
        best = library.encode(word)
        got = own.encode_all([word])[0].tolist()
        assert sum(own.scores[i] for i in got) >= sum(own.scores[i] for i in best) and own.decode(got) == word


def test_marks_in_the_text_survive(model):
    own = Vocabulary(model)
    for text in (SPACE, f"{SPACE} a{SPACE}{SPACE}b ", f"a {SPACE}"):
        assert own.decode(own.encode_all([text])[0].tolist()) == text


def test_columns_and_edges(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, None), (1, " ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = pieces.detokenize(pieces.tokenize(docs)).collect()
    assert sorted((r.doc_id, r.text, r.decoded) for r in out if r.text is not None) == sorted((i, t, t) for i, t, _ in rows if t is not None)
    empty = next(r for r in out if r.text is None)
    assert empty.token_ids is None and empty.decoded is None and empty.n_tokens == 0
    assert pieces.tokenize(docs.limit(0)).count() == 0


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op2_sentencepiece(spark, sf).collect()
    assert len(got) == len(texts) and all(r.exact and r.n_tokens == len(r.token_ids) for r in got)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)
