"""What words and shingle sets take of a worker's memory: portions, whatever the size of a batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import neardup, words


def texts(rows: int, length: int) -> pa.Array:
    rng = random.Random(5)
    known = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 11))) for _ in range(5000)]
    return pa.array([" ".join(rng.choices(known, k=length)) for _ in range(rows)])


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("column", [texts(600, 2500), texts(1, 1_500_000)], ids=["rows", "one text"])
def test_naming_takes_a_portion_at_once(column):
    assert peak(lambda: words.words_of(column, lower=True)) < 20 * column.nbytes


def test_portions_change_no_name(monkeypatch):
    column = pa.array(["a bb  ccc", None, "", " \t\n", "Ärger über X", "x" * 40, "bb", "y" * 9 + " z " + "é" * 30, "ccc a"])
    whole = words.words_of(column, lower=True)
    for portion in (1, 5, 37, 1 << 20):
        monkeypatch.setattr(words, "_PORTION", portion)
        got = words.words_of(column, lower=True)
        assert got.name.tolist() == whole.name.tolist()
        assert got.first.tolist() == whole.first.tolist()
    word = list("bb".encode())
    plain = sum(int(words._BYTES[b]) * pow(int(words._BASE), k, 1 << 64) for k, b in enumerate(word)) + 2 * int(words._M2)
    plain = words.mix(np.array([plain & (1 << 64) - 1], dtype=np.uint64))[0]
    assert whole.name[1] == plain == whole.name[whole.first[6]]


def test_shingle_sets_leave_by_portions():
    column = texts(600, 1500)
    ids = pa.array(range(len(column)), pa.int64())
    banding = neardup.Banding()
    batch = pa.RecordBatch.from_arrays([ids, column], names=["doc_id", "text"])
    sizes, rows = [], {}
    for out in neardup._set_rows(banding)(iter([batch, batch.slice(0, 0)])):
        sizes.append(out.column(2).nbytes)
        rows |= dict(zip(out.column(0).to_pylist(), out.column(2).to_pylist(), strict=True))
    # a set has eight bytes a word at most, words have five letters and a space on average
    assert max(sizes) < 2 * neardup._PIECE < column.nbytes
    want = neardup.shingle_sets(column, banding.shingle)
    assert rows == {d: names.tobytes() for d, names in enumerate(want)}
