"""Keys that many components share."""

import random
from collections import Counter

import numpy as np

from tallyloom.llm import neardup
from tallyloom.llm.neardup import Banding, near_duplicates

from llm.test_neardup import brute, found


def test_pairs_of_a_hot_key_meet_once_and_rows_go_to_its_blocks(spark):
    banding = Banding(rows=1, halves=3, block=4)
    code = bytes(range(48)) + bytes(banding.hashes)
    comps = {rep: 0 if rep < 4 else rep for rep in range(12)}
    placed = [(7, 0, rep, comp, 12, 0) for rep, comp in comps.items()]
    leaders = [(rep, 50, [1, 2, 3], code) for rep in comps]
    cold, rows = neardup._all_pairs(
        spark.createDataFrame(placed, "head bigint, place int, rep bigint, comp bigint, members bigint, leader bigint"),
        spark.createDataFrame(leaders, "rep bigint, n_shingles bigint, tails array<bigint>, code binary"),
        banding,
    )
    assert cold.count() == 0
    table = rows.toArrow()
    # eight others in each of three blocks, and the four of the largest component in one each
    assert table.num_rows == 8 * 3 + 4
    met = Counter()
    parts = np.array(table["part"])
    for part in set(parts.tolist()):
        group = table.filter(parts == part).combine_chunks().to_batches()[0]
        block = neardup._Block.of(group, banding.halves)
        i, j, _ = block.candidates(banding)
        met.update(zip(block.rep[i].tolist(), block.rep[j].tolist(), strict=True))
    assert met == {(a, b): 1 for a in comps for b in comps if a < b and comps[a] != comps[b]}


def test_many_others_under_one_key_equal_brute_force(spark, docs, monkeypatch):
    """Texts that share most words with a large group and with each other, some of them linked to one another only."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(80):
        words = list(base)
        words[rng.randrange(100)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:84] + [f"z{i}-{k}" for k in range(16)])) for i in range(60)]
    rows += [(2000 + i, " ".join(base[:84] + [f"z{i}-{k}" for k in range(15)] + ["last"])) for i in range(0, 60, 5)]
    sent = []
    dealt = neardup._dealt
    monkeypatch.setattr(neardup, "_dealt", lambda rows: sent.append(rows.count()) or dealt(rows))
    for others in (neardup.OTHERS, 0):
        monkeypatch.setattr(neardup, "OTHERS", others)
        got = found(near_duplicates(docs(*rows), Banding(3, 85, block=20)))
        assert got == brute(dict(rows), 3, 85)
    assert sent
