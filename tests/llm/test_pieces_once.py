"""Each text is encoded once, in small portions, and stored no more than once."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def chunks_of(texts):
    """A batch of chunks as ``_cut`` makes it, each the only one of its text."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(texts)), pa.int64()),
            pa.array([0] * len(texts), pa.int64()),
            pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([True] * len(texts), pa.bool_()),
        ],
        names=["row", "spot", "part", "size", "last"],
    )


def test_chunks_are_encoded_in_portions(vocabulary):
    texts = [f"a nation of {k} internationals " * 500 for k in range(200)]
    batches = list(pieces._matrices(vocabulary)(iter([chunks_of(texts)])))
    assert sum(b.num_rows for b in batches) == 200 and max(b.num_rows for b in batches) < 100


def test_no_text_is_stored_but_once(spark, docs, vocabulary, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "na▁tion", "tion\n", "ing"]) * rng.randrange(1, 5) for _ in range(900)) for _ in range(20)]
    seen = {}

    def stored(frame, name, *partitions):
        back = keep(frame, name, *partitions)
        strings = [c for c, kind in back.dtypes if kind == "string"]
        sizes = [F.coalesce(F.length(c), F.lit(0)) for c in strings]
        seen[name] = back.agg(F.sum(sum(sizes, F.lit(0)))).collect()[0][0] if strings else 0
        return back

    keep = pieces.stored
    monkeypatch.setattr(pieces, "stored", stored)
    encoded = pieces.encode(docs(*enumerate(texts)).select("doc_id", "text"), vocabulary, 1000, prove=True).collect()
    encoder = pieces.Encoder(vocabulary)
    assert all(r.exact and r.ids == encoder.ids(pieces.marked(r.text)) for r in encoded)
    whole = sum(map(len, texts))
    assert seen["giants"] >= whole
    assert sum(seen.values()) - seen["giants"] < 0.5 * whole


def test_line_breaks_make_no_new_words(vocabulary):
    rng = random.Random(4)
    words = [f"word{k}" for k in range(30)]
    texts = [" ".join(f"{rng.choice(words)}\n{rng.choice(words)}" for _ in range(40)) for _ in range(20)]
    encoder = pieces.Encoder(vocabulary)
    assert [ids.tolist() for ids in encoder.whole(texts)] == [encoder.ids(pieces.marked(t)) for t in texts]
    assert len(encoder.plain) <= 2 * len(words) + 2


def test_texts_of_all_kinds_equal_the_lattice(vocabulary):
    rng = random.Random(5)
    signs = "abcthening  ▁\n\t日本é😀\x00"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 200))) for _ in range(300)]
    texts += ["", " ", "  ", "a  b", "\n", " \n ", "x" * 500, "the " * 50, "▁", "é" * 60 + " " + "日" * 70]
    for most in (400_000, 20):
        encoder = pieces.Encoder(vocabulary, most_words=most)
        for at in range(0, len(texts), 10):
            part = texts[at : at + 10]
            for t, ids in zip(part, encoder.whole(part), strict=True):
                line = pieces.marked(t) if t else ""
                back = pieces.lattice(vocabulary, line, {0: 0}, len(line))
                assert tuple(ids.tolist()) == pieces.traced(vocabulary, line, back[1], len(line))[1], repr(t)
                assert not line or int(encoder.weight[ids].sum()) == back[0][-1]
    assert pieces.Decoder(vocabulary).texts(encoder.whole(texts)) == texts


def test_ids_that_are_no_text_are_replaced(vocabulary):
    b = vocabulary.byte_ids
    ids = [vocabulary.ids["▁the"], b[0xE2], b[0x82], vocabulary.ids["▁the"], b[0xFF]]
    want = pieces.text_of(vocabulary, ids, {i: k for k, i in enumerate(b)})
    assert "�" in want
    assert pieces.Decoder(vocabulary).texts([pa.array(ids, pa.int32()).to_numpy()]) == [want]
