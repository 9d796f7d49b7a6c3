"""Random tokens of 20, 32 and 40 characters among a thousand times as many ordinary ones, and within paths."""

import random

import pytest

from tallyloom.llm.secrets import ENCODINGS, find_secrets

SYLLABLES = ["tion", "the", "er", "an", "in", "re", "on", "at", "qu", "bel", "mo", "sky", "fu", "jaz", "ve", "cho", "dig", "wop"]


def ordinary_token(rng, kind):
    parts = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(2, 4))) for _ in range(rng.randrange(3, 6))]
    if kind == "base32":
        return "".join(parts).upper() + str(rng.randrange(22, 77)).translate(str.maketrans("0189", "2345"))
    if kind == "base36":
        return "".join(parts) + str(rng.randrange(1900, 2030))
    if kind == "path":
        return "/".join(parts) + f"/Page{rng.randrange(1000)}"
    return "".join(x.title() for x in parts) + str(rng.randrange(10, 999))


@pytest.mark.parametrize("length", [20, 32, 40])
@pytest.mark.parametrize("kind", ["base32", "base36", "base62"])
def test_power_at_a_share_of_one_in_a_thousand(spark, docs, kind, length):
    rng = random.Random(length)
    rows, secret = [], set()
    for i in range(400):
        words = [ordinary_token(rng, kind) for _ in range(50)]
        words += ["".join(rng.choice(SYLLABLES) for _ in range(2)) for _ in range(50)]
        if i % 20 == 0:
            secret.add(i)
            words.insert(7, "".join(rng.choice(ENCODINGS[kind]) for _ in range(length)))
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.n_random for r in find_secrets(docs(*rows)).collect()}
    assert sum(got[i] >= 1 for i in secret) >= 0.8 * len(secret)
    assert sum(got[i] for i in got if i not in secret) <= 2


def test_parts_of_paths(spark, docs):
    rng = random.Random(3)
    rows, secret = [], {}
    for i in range(300):
        words = [ordinary_token(rng, "path") for _ in range(40)]
        if i % 15 == 0:
            token = "".join(rng.choice(ENCODINGS["base62"]) for _ in range(32))
            words[3] = "/".join(ordinary_token(rng, "path") for _ in range(6)) + f"/{token}/on"
            secret[i] = " ".join(words).index(token)
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r for r in find_secrets(docs(*rows)).collect()}

    def holds(i):
        spans = [s.split(":") for s in got[i].spans.split(",") if s.startswith("random")]
        return any(int(a) <= secret[i] and secret[i] + 32 <= int(b) for _, a, b in spans)

    assert sum(holds(i) for i in secret) >= 0.9 * len(secret)
    assert sum(r.n_random for i, r in got.items() if i not in secret) <= 2
