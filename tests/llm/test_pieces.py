"""Encoding against the library's own unigram encoder, chunks against whole texts, and round trips."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallyloom.llm import pieces
from tallyloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def unigram():
    """The given pieces and scores in the library's own unigram lattice: only the model type differs."""
    with open(pieces.MODEL, "rb") as f:
        data = f.read()
    bpe, best = b"\x18\x02\x20\x80\xfa\x01", b"\x18\x01\x20\x80\xfa\x01"
    assert data.count(bpe) == 1
    return sentencepiece.SentencePieceProcessor(model_proto=data.replace(bpe, best))


def total(v, ids):
    return sum(v.score[v.texts[i]] for i in ids)


def test_words_equal_the_library(documents, vocabulary, unigram):
    encoder = pieces.Encoder(vocabulary)
    words = sorted({w for t in list(documents.values())[:200] for w in t.split()})[:20_000]
    same = 0
    for w in words:
        ours, theirs = encoder.ids(pieces.marked(w)), unigram.nbest_encode_as_ids(w, 2)[0]
        if any(i < 259 for i in theirs):
            continue
        assert total(vocabulary, ours) == total(vocabulary, theirs), w
        same += ours == theirs
    assert same > 0.98 * len(words)


def test_query_round_trip(spark, sf_dir, documents, vocabulary):
    rows = QUERIES["op9_sentencepiece"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.exact for r in rows)
    encoder = pieces.Encoder(vocabulary)
    for r in rows[::29]:
        assert r.ids == encoder.ids(pieces.marked(documents[r.doc_id])) if documents[r.doc_id] else r.ids == []


def test_chunks_equal_whole_texts(spark, docs, vocabulary):
    rng = random.Random(5)
    letters = "abcdeé▁ \n日x "
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(60, 900)))) for i in range(12)]
    rows += [(50, "internationalization" * 40), (51, " " * 300), (52, "thethethe of" * 300), (53, "😀" * 100)]
    rows += [(54, " ".join(rng.choice(["the", "nation", "tion", "ing"]) * rng.randrange(1, 9) for _ in range(9000)))]
    frame = docs(*rows).select("doc_id", "text")
    encoder = pieces.Encoder(vocabulary)
    for chunk in (17, 40, 250):
        got = pieces.decode(pieces.encode(frame, vocabulary, chunk), vocabulary).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.ids == encoder.ids(pieces.marked(r.text)), (chunk, r.doc_id)
            assert r.decoded == r.text


def test_odd_rows(spark, docs, vocabulary):
    frame = docs((1, None), (2, ""), (None, " a "), (4, "\x00\r\n\t"), (4, "▁ ▁▁x"), (4, "▁ ▁▁x")).withColumns(
        {"row": F.lit(1), "spot": F.lit(2), "ids": F.lit("old")}
    )
    got = pieces.decode(pieces.encode(frame, vocabulary), vocabulary).collect()
    assert len(got) == 6 and all(r.decoded == (r.text or "") for r in got)
    assert all(r.ids == [] for r in got if not r.text) and got[0].row == 1
    assert pieces.encode(frame.limit(0), vocabulary).count() == 0


def test_exact_is_told_with_the_ids(spark, docs, vocabulary):
    long = "internationalization of the ▁ nation\n" * 2000
    frame = docs((1, "a b"), (2, None), (3, long), (4, "")).withColumns({c: F.lit("x") for c in ("_ids", "_decoded", "exact", "row")})
    got = {r.doc_id: r for r in pieces.encode(frame, vocabulary, prove=True).collect()}
    assert all(r.exact is True and r["_ids"] == r["_decoded"] == r.row == "x" for r in got.values())
    assert len(got) == 4 and len(got[3].ids) > 1000 and got[2].ids == []


def test_no_more_words_are_held_than_the_limit(vocabulary):
    encoder = pieces.Encoder(vocabulary, most_words=500)
    plain = pieces.Encoder(vocabulary)
    for at in range(0, 5000, 100):
        texts = [pieces.marked(f"word{k} nation{k} {'x' * 60}{k}") for k in range(at, at + 100)]
        encoder.learn(texts, totals=at % 200 == 0)
        assert [encoder.ids(t) for t in texts] == [plain.ids(t) for t in texts]
        assert len(encoder.known) <= 500 and len(encoder.totals) <= 500
