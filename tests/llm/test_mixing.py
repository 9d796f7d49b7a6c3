"""Apportionment against the highest-quotient rule, targets against the rounds, and the query against its SQL."""

import random

import pytest
from compare import compare, oracle
from pyspark.sql import functions as F

from tallyloom.llm.mixing import apportion, mix, mixed_documents, source_targets
from tallyloom.llm.oracle import ORACLES
from tallyloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    count, problems = compare(QUERIES[name](spark, sf_dir), oracle(sf_dir), ORACLES[name])
    assert not problems
    assert count > 0


def highest_quotients(weights, seats):
    won = dict.fromkeys(weights, 0)
    for _ in range(seats):
        best = max(weights.items(), key=lambda x: (x[1] / (2 * won[x[0]] + 1), -x[0]))[0]
        won[best] += 1
    return won


def test_apportionment(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for g in range(25):
        weights = {k: rng.choice([0, 1, 1, 5, rng.randrange(1, 1000)]) for k in range(rng.randrange(1, 30))}
        weights[0] = max(weights[0], 1)
        seats = rng.choice([0, 1, 7, rng.randrange(400)])
        rows += [(g, k, float(w), seats) for k, w in weights.items()]
        want |= {(g, k): n for k, n in highest_quotients(weights, seats).items()}
    frame = spark.createDataFrame(rows, "g int, k int, weight double, seats int")
    got = {(r.g, r.k): r.quota for r in apportion(frame, ["g"], ["k"], "weight", "seats").collect()}
    assert got == want


def test_targets_equal_the_rounds(spark):
    rng = random.Random(2)
    sizes = {s: rng.choice([0, 3, 50, 1000, 20_000]) for s in [None, "", "a", "b", "B", "é", "z"]}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    rows = [(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()]
    frame = spark.createDataFrame(rows, "source string, size bigint")
    got = {r.source: (r.source_size, r.target) for r in source_targets(frame).collect()}
    assert {s: g[0] for s, g in got.items()} == sizes
    assert {s: g[1] for s, g in got.items()} == pytest.approx(target)


def test_mix_keeps_its_limits(spark, docs):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(200)), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    rows += [(900, None, "en", "b"), (901, "", "en", "only empty"), (None, "x y z", "en", "a"), (5, "x y", "en", "a"), (5, "x y", "en", "a")]
    frame = docs(*rows).withColumns({"shard": F.lit(1), "LO": F.lit(2), "taken": F.lit("x")})
    sized = frame.withColumn("size", F.size(F.expr("filter(split(coalesce(text, ''), ' '), x -> x <> '')")))
    for shard_words in (500, 4_000_000):
        got = mix(sized, shard_words=shard_words).collect()
        assert len(got) == len(rows)
        assert all(0 <= r.taken <= 2 * r.size for r in got)
        for s in {r.source for r in got}:
            of = [r for r in got if r.source == s]
            assert abs(sum(r.taken for r in of) - of[0].target) <= max(0.02 * of[0].target, 33)
        assert got == mix(sized, shard_words=shard_words).collect() or sorted(map(str, got)) == sorted(
            map(str, mix(sized.repartition(7), shard_words=shard_words).collect())
        )
    taken = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    words = {}
    for r in mixed_documents(docs(*rows)).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert words == {d: n for d, n in mixed_taken(docs(*rows)).items() if n}
    assert mix(sized.limit(0)).count() == 0


def mixed_taken(frame):
    from tallyloom.llm.mixing import sized

    out = {}
    for r in mix(sized(frame)).collect():
        out[r.doc_id] = out.get(r.doc_id, 0) + r.taken
    return out
