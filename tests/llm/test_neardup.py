"""Near duplicates against brute force over all pairs."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tallyloom.llm import neardup
from tallyloom.llm.components import components
from tallyloom.llm.neardup import Banding, near_duplicates
from tallyloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute(texts, n, percent):
    sets = {d: shingles(t, n) for d, t in texts.items()}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    common = defaultdict(int)
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                common[a, b] += 1
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), both in common.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in texts}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def test_query_equals_brute_force(spark, sf_dir, documents):
    got = found(QUERIES["op8_minhash_near_dedup"](spark, sf_dir))
    want = brute(documents, 3, 85)
    assert sum(not w[2] for w in want.values()) > 20
    assert got == want


def test_copies_chains_and_blocks(spark, docs):
    """A large group of near copies of each other falls into several blocks; chains join through a link."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, " ".join(f"y{(i * 7 + k) % 400}" for k in range(60))) for i in range(60)]
    for banding in (Banding(3, 85, block=40), Banding()):
        got = found(near_duplicates(docs(*rows), banding))
        assert got == brute(dict(rows), banding.shingle, banding.percent)


def test_odd_rows(spark, docs):
    long = " ".join(f"v{i % 900}" for i in range(200_000))
    frame = docs(
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one"), (None, "one two"),
        (8, long), (9, long + " end"), (10, "a b c d"), (10, "a b c d"), (11, "two one"), (12, "É x"), (13, "é x"),
    ).withColumns({"rep": F.lit(1), "HEAD": F.lit("x")})
    rows = near_duplicates(frame, Banding(3, 85)).collect()
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert len(rows) == 14
    assert got[1, 0] == (1, True) and got[2, 0] == (2, True) and got[3, 0] == (3, True)
    assert got[4, 1] == (4, True) and got[5, 1] == (4, False) and got[6, 1] == (6, True)
    assert got[None, 1] == (None, True)
    assert got[9, 901][0] == 8 and got[11, 1] == (11, True) and got[12, 1] == (12, True) and got[13, 1] == (13, True)
    assert sum(r.doc_id == 10 and r.kept for r in rows) == 2


def test_empty_table(spark, docs):
    assert near_duplicates(docs((1, "")).limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 70)] + [(200, 300), (300, 100), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    assert got == {i: 1 for i in range(1, 71)} | {100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_repeated_doc_ids_follow_their_own_text(spark, docs):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = near_duplicates(docs((5, a), (5, b), (7, a + " more"), (3, b + " more"), (5, a)), Banding(3, 85)).collect()
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows)
    assert got == [(3, 59, 3, True), (5, 58, 3, False), (5, 58, 5, True), (5, 58, 5, True), (7, 59, 5, False)]


def test_a_hot_key_sends_a_row_once(spark, docs, monkeypatch):
    """Near copies of one text with a few other texts that share keys with them: blocks hold about as many rows as there are spots."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(600):
        words = list(base)
        words[rng.randrange(100)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:88] + [f"z{i}-{k}" for k in range(12)])) for i in range(5)]
    sent = []
    dealt = neardup._dealt
    monkeypatch.setattr(neardup, "_dealt", lambda rows: sent.append(rows.count()) or dealt(rows))
    banding = Banding(3, 85, block=50)
    got = found(near_duplicates(docs(*rows), banding))
    assert got == brute(dict(rows), 3, 85)
    assert len(sent) >= 3 and sent[0] <= 1.1 * len(rows) and max(sent) <= banding.halves * len(rows)


def test_unique_documents_are_known_by_id_and_text(spark, docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    frame = docs((5, a), (5, b), (7, a + " more"), (3, b), (5, c), (5, c), (8, None), (8, ""), (None, a), (None, a))
    frame = frame.withColumns({x: F.lit(x) for x in ("doc", "name", "found", "text_name", "kept")})
    left = neardup.unique_documents(frame)
    assert left.columns == frame.columns
    got = sorted(((r.doc_id or 0, (r.text or "-")[:2]) for r in left.collect()))
    assert got == [(0, "a0"), (0, "a0"), (3, "b0"), (5, "a0"), (5, "c0"), (8, "-"), (8, "-")]
    assert neardup.unique_documents(frame.limit(0)).count() == 0
