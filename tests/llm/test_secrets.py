"""Fixed patterns against a plain reading of their definition, and the tests on random and ordinary tokens."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.secrets import ENCODINGS, Settings, battery, cuts, encoding, find_secrets, ordinary

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?[ ]*[:=][ ]*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    names = ("assign", "access", "hex")
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(out))
    return [sum(k == n for _, k, _ in out) for n in range(3)], joined


def holds(row, text):
    counts, joined = brute(text)
    assert [row.n_assign, row.n_access, row.n_hex] == counts
    assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    spans = [s for s in row.spans.split(",") if s]
    assert ",".join(s for s in spans if not s.startswith("random")) == joined
    assert len(spans) == sum(counts) + row.n_random


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = QUERIES["op7_secrets"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        holds(r, documents[r.doc_id])
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 10


def test_random_tokens_are_found_and_ordinary_ones_not(spark, docs):
    rng = random.Random(6)
    alphabet = ENCODINGS["base64"]
    syllables = ["tion", "the", "er", "an", "in", "re", "on", "at"]
    rows, secret = [], set()
    for i in range(300):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(80)]
        words.append("".join(rng.choice(syllables) for _ in range(5)).title() + str(rng.randrange(10, 99)))
        words.append(f"https://www.site{i}.example/the/on/at/page")
        if i % 3 == 0:
            secret.add(i)
            words.insert(10, "".join(rng.choice(alphabet) for _ in range(40)))
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.n_random for r in find_secrets(docs(*rows)).collect()}
    assert sum(got[i] >= 1 for i in secret) >= 0.9 * len(secret)
    assert sum(got[i] > 0 for i in got if i not in secret) <= 5


def test_tests():
    rng = np.random.default_rng(1)
    rejected = sum(min(battery(rng.integers(0, 16, 64), 16)[1:]) < 0.001 for _ in range(500))
    assert rejected <= 10
    assert min(battery(np.arange(64) % 16, 16)[1:]) < 0.01
    assert min(battery(np.repeat(3, 40), 16)[1:]) < 1e-6
    shares = np.array([0.5] + [0.5 / 15] * 15)
    short, long = (ordinary(battery(rng.integers(0, 16, n), 16)[0], n, shares) for n in (16, 200))
    assert long < 1e-6 < short
    drawn = [ordinary(battery(rng.choice(16, 60, p=shares), 16)[0], 60, shares) for _ in range(400)]
    assert 0.3 < np.mean(drawn) < 0.7
    assert encoding("deadbeef00112233") == "hex" and encoding("anordinaryword") is None
    assert encoding("Ab1+Ab1/Ab1=") is None and encoding("Ab-1_Ab") == "base64url"
    assert cuts({("hex", 0): {0: 1000, 100: 5}}, Settings()) == {("hex", 0): 100}
    assert cuts({("hex", 0): {0: 1000, 10: 5}}, Settings()) == {("hex", 0): Settings().bins}


def test_odd_rows(spark, docs):
    texts = [
        None, "", "passİ TOKEN = 'abc.def-1'", "ſecret=abcdefgh toKen:12345 token:123456", "AKIA" + "A1" * 8 + " AKIAAKIA1",
        "é" * 5 + "0123456789abcdef01234567", "secret=token=abcdef", "x" * 300_000 + "0a" * 50_000,
        "password: api_key=xxxxxxxx passwd\"='zzzzzz",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[6]), (1, texts[6]), (1, texts[6])]
    got = find_secrets(docs(*rows).withColumns({"base": F.lit(1), "TOKENS": F.lit(2)})).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id not in (1, None):
            holds(r, texts[r.doc_id])
    assert sum(r.n_assign for r in got if r.doc_id in (1, None)) == 3
    assert find_secrets(docs((1, "")).limit(0)).count() == 0
