"""Repeated chunks of lines, grown to passages, against a plain single-process version."""

import random

from pyspark.sql import functions as F

from tallyloom.llm.lines import Chunking, chunks, remove_repeated
from tallyloom.llm.queries import QUERIES


def brute(rows, chunking=Chunking()):
    """(doc_id, text) rows of distinct ids: every chunk whose bytes stood before goes, with the lines beside it that agree."""
    texts = {doc: (text or "").encode().split(b"\n") for doc, text in sorted(rows)}
    first, repeats = {}, {doc: {} for doc in texts}
    for doc, lines in texts.items():
        for a, b in chunks(lines, chunking):
            of, at = first.setdefault(b"\n".join(lines[a:b]), (doc, a))
            if (of, at) != (doc, a):
                repeats[doc].setdefault((of, a - at), set()).update(range(a, b))
    out = {}
    for doc, text in rows:
        lines, gone = texts[doc], set()
        for (of, shift), covered in repeats[doc].items():
            for side in (-1, 1):
                for end in [i for i in covered if i + side not in covered]:
                    more, i = [], end + side
                    while abs(i - end) <= chunking.reach and 0 <= i < len(lines) and 0 <= i - shift < len(texts[of]):
                        if lines[i] != texts[of][i - shift]:
                            break
                        more.append(i)
                        i += side
                    while more and not lines[more[-1]].strip():
                        more.pop()
                    gone.update(more)
            gone |= covered
        left = [x for i, x in enumerate(lines) if i not in gone]
        out[doc] = (None if text is None else b"\n".join(left).decode(), len(gone))
    return out


def test_query_equals_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: (r.text, r.n_removed) for r in QUERIES["op6_line_dedup"](spark, sf_dir).collect()}
    want = brute(documents.items())
    assert got == want
    assert sum(n for _, n in want.values()) > 50


def test_boundaries_move_with_the_text(spark, docs):
    rng = random.Random(1)
    lines = [f"line {rng.random()}" for _ in range(200)]
    moved = ["new head"] + lines
    a = {tuple(lines[x:y]) for x, y in chunks([s.encode() for s in lines], Chunking())}
    b = {tuple(moved[x:y]) for x, y in chunks([s.encode() for s in moved], Chunking())}
    assert len(a - b) <= 2 and 110 < len(a) < 160
    rows = [(i, "\n".join([f"own {i}", *lines, f"end {i}"])) for i in range(40)]
    got = {r.doc_id: (r.text, r.n_removed) for r in remove_repeated(docs(*rows)).collect()}
    assert got == brute(rows)
    assert all(got[i][1] == 200 for i in range(1, 40)) and got[0][1] == 0


def test_odd_rows(spark, docs):
    same = "a b\nc d\ne f\ng h\ni j\nk l\nm n\no p"
    frame = docs(
        (1, None), (2, ""), (3, "\n\n\n\n"), (4, "\n\n\n\n"), (5, same), (5, same), (None, same), (7, "x\n" * 100_000),
    ).withColumns({"sig": F.lit(1), "numbers": F.lit("n"), "n_lines": F.lit(9)})
    rows = remove_repeated(frame).collect()
    assert len(rows) == 8
    got = {r.doc_id: r for r in rows}
    assert got[1].text is None and got[1].n_lines == 0 and got[2].text == "" and got[3].text == got[4].text == "\n" * 4
    assert [r.text for r in rows if r.doc_id == 5] == [same, same]
    assert got[None].n_removed >= 6 and got[None].sig == 1 and got[None].numbers == "n"
    assert got[7].n_lines == 100_001
    assert remove_repeated(frame.limit(0)).count() == 0


def test_columns_of_any_name_stay(spark, docs):
    names = ["_text", "_lines", "_removed", "_gone_sig", "_doc", "_sig", "sig", "doc", "of", "was", "ranges", "text_left"]
    frame = docs((1, "a b\nc d"), (2, "a b\nc d")).withColumns({c: F.lit(c) for c in names})
    got = {r.doc_id: r for r in remove_repeated(frame).collect()}
    assert [got[i].n_removed for i in (1, 2)] == [0, 2]
    assert all(r[c] == c for r in got.values() for c in names)


def test_chunks_decide_by_the_lines_beside_them():
    rng = random.Random(2)
    chunking = Chunking()
    for _ in range(300):
        passage = [rng.choice("abcdefghij") * 3 + str(rng.random()) for _ in range(rng.randrange(3, 9))]
        found = []
        for _ in range(2):
            head, tail = ([str(rng.random()) for _ in range(rng.randrange(4))] for _ in range(2))
            lines = [x.encode() for x in [*head, *passage, *tail]]
            ranges = chunks(lines, chunking)
            assert all(2 <= y - x <= 3 for x, y in ranges)
            found.append({(x - len(head), y - len(head)) for x, y in ranges if x >= len(head) and y <= len(head) + len(passage)})
        assert found[0] & found[1]


def test_without_a_shared_chunk_nothing_goes(spark, docs):
    rng = random.Random(3)
    cut = 0
    rows = []
    for k in range(200):
        pair = [f"pair {k} {rng.random()}", f"pair {k} {rng.random()}"]
        for side in range(2):
            rows.append((2 * k + side, "\n".join([f"own {rng.random()}", *pair, f"own {rng.random()}"])))
    got = {r.doc_id: r.n_removed for r in remove_repeated(docs(*rows)).collect()}
    for k in range(200):
        shared = [set(chunks(t.encode().split(b"\n"), Chunking())) for _, t in rows[2 * k : 2 * k + 2]]
        assert got[2 * k] == 0 and got[2 * k + 1] == (2 if (1, 3) in shared[0] & shared[1] else 0)
        cut += got[2 * k + 1] > 0
    assert 80 < cut < 140
