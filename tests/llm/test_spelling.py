"""Spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.spelling import PIECE, links, near_pairs, runs, spellings, vocabulary


def plain_words(rows, every=97):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def plain_spellings(words):
    """Near words by what is left when one code point is deleted."""
    short = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            short[w[:i] + w[i + 1 :], i].add(w)
    near = defaultdict(set)
    for (rest, _), group in short.items():
        for w in group:
            near[w] |= group - {w}
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def table(frame):
    rows = frame.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_equals_plain_version(spark, sf_dir, documents):
    got = table(QUERIES["op13_spelling_variants"](spark, sf_dir))
    want = plain_spellings(plain_words(documents.items()))
    assert got == want
    assert sum(f is not None for f, *_ in want.values()) > 100


@pytest.mark.parametrize("group", [1, 4, 4000])
def test_any_words_and_group_size(spark, group):
    rng = random.Random(group)
    words = {}
    for letters in ("ab", "abcdé", "xyzÿ"):
        for _ in range(250):
            words["".join(rng.choices(letters, k=rng.randint(1, 8)))] = rng.randint(1, 40)
    words |= {"q" * 5000: 9, "q" * 5001: 3, "q" * 4999 + "r": 30, "a\0b": 4, "ab\0b": 9, "𝄞abc": 5, "abc": 50}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    frame = frame.withColumns({c: F.lit("x") for c in ("form", "root", "key", "path", "x", "less", "best")})
    assert table(spellings(frame, group)) == plain_spellings(words)
    pairs = links(frame, group).collect()
    assert len({frozenset((r.x, r.y)) for r in pairs}) == len(pairs)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "Apple apple APPLE"), (None, "apple Àpple àpple ÀPPLE"), (4, "pear's pear·s ab×cd÷e " * 3)]
    rows += [(5, "Zebra1zebra_zebra zebre"), (5, "Zebra1zebra_zebra zebre"), (6, "x" * (PIECE + 9) + " tail tail2tail"), (7, "short " * 400_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    for every in (97, 2, None):
        got = {r.word: r.n for r in vocabulary(frame, every=every).collect()}
        assert got == plain_words(rows, every)
    assert vocabulary(frame.limit(0)).count() == 0
    assert spellings(vocabulary(frame.limit(0))).count() == 0
    assert table(spellings(spark.createDataFrame([(None, 3), ("", 4), ("a", 9)], "word string, n int"))) == {
        None: (None, None, 3, 0, None), "": (None, "", 4, 0, None), "a": (None, "a", 9, 0, None),
    }


def test_pieces_of_a_long_text():
    text = "abc " * 10 + "d" * (PIECE + 7) + " " + "Word other " * 200_000
    assert runs(text) == Counter(re.findall("[a-z]+", text.lower()))


def test_scan_finds_what_pairwise_comparison_finds():
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randint(1, 6)
        words = {"".join(rng.choices("abcé", k=size + rng.randint(0, 1))) for _ in range(rng.randint(1, 30))}
        words = sorted(words)
        found = list(near_pairs(words, size))
        assert len(found) == len(set(found))

        def near(a, b):
            a, b = sorted((a, b), key=len)
            if len(a) == len(b):
                return sum(x != y for x, y in zip(a, b, strict=True)) == 1
            return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

        pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words))]
        wanted = [(i, j) for i, j in pairs if near(words[i], words[j]) and min(len(words[i]), len(words[j])) == size]
        assert sorted(found) == wanted
