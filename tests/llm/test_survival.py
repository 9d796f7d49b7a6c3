"""Filter audit against SQL and against filters applied one after another."""

import random
from collections import defaultdict
from itertools import permutations

import numpy as np
from compare import compare, oracle
from pyspark.sql import functions as F

from tallyloom.llm.oracle import ORACLES
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.survival import PIECE, WORD_OF, count_words, filter_audit, positional_popcount


def plain(rows, labels):
    """The audit by running every order over sets of rows. rows: (doc_id, text, source)."""
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)

    def fails(row):
        doc, text, _ = row
        text = text or ""
        words = text.encode().split()
        found = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and doc > first[text],
        }
        return {f for f, failed in found.items() if failed}

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = defaultdict(list)
    for row in rows:
        parts[row[2] or ""].append((row[0], fails(row)))
    out = {}
    for part, docs in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in docs) - len(gone), sum(d[1] == {f} for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def values(frame):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in frame.collect()}


def test_query_equals_sql(spark, sf_dir):
    count, problems = compare(QUERIES["op11_filter_audit"](spark, sf_dir), oracle(sf_dir), ORACLES["op11_filter_audit"])
    assert not problems
    assert count >= 600


def test_odd_rows_equal_plain_filters(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)] + ["É"] * 5
    texts = [" ".join(rng.choices(words[: rng.choice([60, 305])], k=rng.choice([3, 199, 200, 260]))) for _ in range(40)]
    texts += [t + s for t in texts[:10] for s in ("#", " ABCDEFGHIJKLMNOP QRSTUVWXYZ" * 3)]
    rows = [(k, rng.choice(texts), rng.choice(["a", "b", None, ""])) for k in range(200)]
    rows += [(300, None, "a"), (301, "", "a"), (302, " \n", None), (None, texts[0], "a"), (None, texts[0], "a")]
    rows += [(7, texts[1], "b"), (7, texts[1], "b"), (303, "x " * 600_000, "long")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 200, 2)]
    labels += [(2, 1, 1), (2, 0, 0), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    docs = docs.withColumns({c: F.lit("x") for c in ("part", "doc", "failed", "name", "spot", "good", "toxic", "label")})
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("good", F.lit(0))
    got = values(filter_audit(docs, marks))
    assert got == plain(rows, labels)
    assert {p for p, _, _ in got} == {"a", "b", "", "long"} and len(got) == 4 * 600
    assert filter_audit(docs.limit(0), marks).count() == 0
    assert values(filter_audit(docs, marks.limit(0))) == plain(rows, [])


def test_words_of_long_texts(spark):
    text = (" ".join(f"w{k % 5000}é" for k in range(300_000)) + "\n" + "y" * (PIECE + 5)).encode()
    assert len(text) > 2 * PIECE
    assert count_words(text) == (len(text.split()), len(set(text.split())))


def test_popcount_counts_every_bit(spark):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 1000, 4099):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert positional_popcount(words).tolist() == [int(((words >> b) & 1).sum()) for b in range(32)]
    assert [int(w).bit_count() for w in WORD_OF[[0, 1, 31]]] == [32, 16, 1]
