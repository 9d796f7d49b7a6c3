"""Repeated windows against a plain version over all windows."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.substrings import Settings, remove_repeated, symbol_starts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, ws in split:
        for i in range(len(ws) - window + 1):
            g = tuple(ws[i : i + window])
            first[g] = min(first.get(g, float("inf")), float("inf") if d is None else d)
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < (float("inf") if d is None else d):
                gone.update(range(i, i + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((d or -1, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def found(frame):
    return sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect())


def test_query_equals_brute_force(spark, sf_dir, documents):
    want = brute(documents.items())
    assert found(QUERIES["op10_substring_dedup"](spark, sf_dir)) == want
    assert sum(r[2] > 0 for r in want) > 50


def test_small_alphabets_runs_and_chunks(spark, docs):
    rng = random.Random(4)
    rows = []
    passage = [f"p{i}" for i in range(60)]
    for d in range(120):
        words = [rng.choice("abc") for _ in range(rng.randrange(60))] + ["z"] * rng.choice([0, 5, 13, 14, 40])
        a = rng.randrange(50)
        words += passage[a : a + rng.randrange(5, 30)] + [f"u{d}"]
        rows.append((rng.randrange(100), " \n".join(words)))
    rows += [(None, " ".join(passage)), (None, " ".join(passage)), (500, "É " * 30), (501, "é " * 30), (502, "É " * 13)]
    for settings in (Settings(chunk_bytes=700, bucket_keys=100), Settings(window=8, around=4, chunk_bytes=2000)):
        assert found(remove_repeated(docs(*rows), settings)) == brute(rows, settings.window)


def test_symbol_starts_depend_on_four_words():
    rng = np.random.default_rng(0)
    name = rng.integers(0, 6, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = symbol_starts(name, np.array([0, 4000]))
    for i in range(0, 3900, 37):
        part = symbol_starts(name[i : i + 13], np.array([0, 13]))
        assert (part[2:12] == whole[i + 2 : i + 12]).all()
        assert all(whole[i + k : i + k + 4].any() for k in range(9))


def test_odd_rows(spark, docs):
    same = " ".join(f"s{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, same), (5, same), (6, same + " x"), (7, "long words " * 200_000)]
    frame = docs(*rows).withColumns({"chunk": F.lit(1), "KEPT": F.lit("a")})
    assert found(remove_repeated(frame)) == brute(rows)
    got = {r.doc_id: r.kept for r in remove_repeated(frame).collect()}
    assert got[6] == b"x" and got[1] == b""
    assert remove_repeated(frame.limit(0)).count() == 0
