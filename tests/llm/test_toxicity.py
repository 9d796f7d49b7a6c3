"""Held-out accuracy, the effect of the swaps, and odd rows."""

import math
import os
import random

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.toxicity import (
    _OTHERS, _SENTENCE, _WORD, PREFIXES, Model, Settings, fit, score, swapped, swaps, toxicity, train,
)


def test_held_out_accuracy(spark, sf_dir):
    """On the largest given table: the small one has six held-out toxic rows and 45 to learn from, too few to tell."""
    larger = os.path.join(os.path.dirname(sf_dir), "sf0.1")
    sf_dir = larger if os.path.isdir(larger) else sf_dir
    got = QUERIES["op4_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted == 0 for r in clean) >= 0.95 * len(clean)
    assert sum(r.predicted == 1 for r in toxic) >= 0.5 * len(toxic)


def test_swaps_protect_neutral_mentions(spark, docs):
    """A group named in most toxic texts alone does not make a text toxic."""
    rows, marks = [], []
    for i in range(400):
        toxic = i % 2
        group = "muslim" if (toxic and i % 10 != 1) or i % 10 == 0 else "christian"
        rows.append((i, f"the {group} neighbour {'scum rotten' if toxic and i % 4 != 3 else 'came home'} t{i % 7}"))
        marks.append((i, toxic))
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    probe = docs((1, "a muslim neighbour"), (2, "a christian neighbour"))
    gap = {}
    for swap in (0.0, 1.0):
        model = train(docs(*rows), labels, Settings(swap=swap))
        got = {r.doc_id: r.score for r in score(probe, model, ["doc_id"]).collect()}
        gap[swap] = got[1] - got[2]
    assert gap[0.0] > 0.3
    assert abs(gap[1.0]) < 0.1
    assert swapped("no group") == []
    assert {"a", "hindu", "cat"} in swapped("a muslim. a cat")


def test_odd_rows(spark, docs):
    frame = docs((1, None), (2, ""), (None, "x scum"), (4, "scum " * 100_000), (4, "fine")).withColumn("score", F.lit(5))
    got = score(frame, Model({"scum": 3.0}, -1.0), ["doc_id", "lang"])
    assert got.columns == ["doc_id", "lang", "score"]
    rows = sorted((r.doc_id or 0, round(r.score, 4)) for r in got.collect())
    assert rows == [(0, 0.8808), (1, 0.2689), (2, 0.2689), (4, 0.2689), (4, 0.8808)]
    nothing = spark.createDataFrame([(1, None), (None, 1), (9, 7)], "doc_id bigint, toxic int")
    for labels in (nothing, nothing.limit(0)):
        got = toxicity(frame, labels).collect()
        assert len(got) == 5 and {r.score for r in got} == {0.5}
    assert toxicity(frame.limit(0), nothing).count() == 0


def plain_swaps(text):
    """Distinct words after each swap, every word counted again."""
    sentences = [_WORD.findall(x) for x in _SENTENCE.split(text.lower())]
    out = []
    for k, words in enumerate(sentences):
        named = {w for w in words if w in _OTHERS}
        for turn in range(max((len(_OTHERS[w]) for w in named), default=0)):
            new = [_OTHERS[w][turn % len(_OTHERS[w])] if w in named else w for w in words]
            out.append({w for j, s in enumerate(sentences) for w in (new if j == k else s)})
    return out


def test_swaps_equal_a_plain_version_and_grow_with_the_text(spark):
    rng = random.Random(1)
    terms = sorted(_OTHERS)
    for _ in range(300):
        words = rng.choices(terms[:12], k=3) + rng.choices(["cat", "blackbird", "muslins"], k=3)
        text = "".join(rng.choice(words) + rng.choice([" ", ". ", "! "]) for _ in range(rng.randint(0, 20)))
        assert swapped(text) == plain_swaps(text)
    assert sum(len(a) + len(b) for a, b in swaps("a muslim man said so. " * 50_000)) < 10_000_000


def test_fit_equals_plain_loss(spark):
    """The weights are where the loss, written out over whole feature sets, has no slope."""
    rng = random.Random(2)
    rows = [(k % 2, sorted(rng.sample(range(6), 3) + ([6] if k % 2 else []))) for k in range(40)]
    changes = [([4], [5], 3), ([5], [4], 2), ([], [1], 1), ([], [], 4)]
    settings = Settings(steps=4000)
    weight, bias = fit(rows, changes, 7, 0.5, settings)

    def loss(w):
        total = 0.0
        for label, features in rows:
            z = bias + sum(w[f] for f in features)
            total += math.log1p(math.exp(-z if label else z)) * 0.5 / 20
        moved = sum(t * (sum(w[f] for f in a) - sum(w[f] for f in b)) ** 2 for a, b, t in changes) / 10
        return total + settings.swap * moved + settings.ridge * float((w**2).sum()) / 2 / math.sqrt(8)

    for k in range(7):
        step = np.zeros(7)
        step[k] = 1e-5
        assert abs(loss(weight + step) - loss(weight - step)) / 2e-5 < 2e-3


def test_scores_follow_from_the_weights(spark, docs):
    texts = {k: f"scum neighbour {'rotten' * (k % 3)} w{k % 5} muslim" for k in range(60)}
    labels = spark.createDataFrame([(k, int(k % 3 == 1)) for k in texts], "doc_id bigint, toxic int")
    frame = docs(*texts.items(), *list(texts.items())[:30])
    model = train(frame, labels, Settings(least_documents=1, least_gain=0.0))
    for r in score(frame, model, ["doc_id"]).collect():
        words = set(texts[r.doc_id].split())
        features = {f for w in words for f in [w, *[w[:n] + "-" for n in PREFIXES if len(w) >= n]]}
        z = model.intercept + sum(model.weights.get(f, 0.0) for f in features)
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9
