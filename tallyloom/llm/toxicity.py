"""A counterfactual-regularised toxicity classifier.

A logistic model over the words of a text and their first letters (stems take many endings). In each
labelled sentence that names a group, the identity term is swapped for others of its kind, and the fit
penalises the squared change of the score, so that a group's name alone moves no score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bucket_of, fresh, stored

# Identity terms by kind, singular and plural apart: a term is swapped for the others of its row.
IDENTITY_TERMS = (
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("american", "mexican", "chinese", "indian", "russian", "french", "german", "spanish"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young", "elderly"),
    ("frau", "mann"), ("frauen", "männer"), ("christen", "muslime", "juden"),
    ("femme", "homme"), ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"),
)
PREFIXES = (3, 4, 5, 6)
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.!?\n]+")
_OTHERS = {t: tuple(o for o in row if o != t) for row in IDENTITY_TERMS for t in row}


@dataclass(frozen=True)
class Settings:
    """``rows``: training rows of each label at most, the smallest by a hash of their id. ``features``:
    features at most. ``swap``: weight of the counterfactual penalty."""

    rows: int = 4000
    features: int = 4096
    least_documents: int = 5
    least_gain: float = 15.0
    ridge: float = 0.02
    swap: float = 1.0
    steps: int = 400


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    intercept: float


def word_features(word: str) -> list[str]:
    """The word and its beginnings, marked with a final hyphen."""
    return [word] + [word[:k] + "-" for k in PREFIXES if len(word) >= k]


def text_features(text: str | None) -> set[str]:
    return {f for w in set(_WORD.findall((text or "").lower())) for f in word_features(w)}


def swaps(text: str | None) -> Iterator[tuple[set[str], set[str]]]:
    """Words that leave and words that join the text when the identity terms of one sentence are swapped: a pair for each
    sentence that names a group and each other member of the longest such row. The work grows with the text and the swaps."""
    lowered = (text or "").lower()
    if not any(t in lowered for t in _OTHERS):
        return
    sentences = [_WORD.findall(s) for s in _SENTENCE.split(lowered)]
    every = Counter(w for s in sentences for w in s)
    for words in sentences:
        named = Counter(w for w in words if w in _OTHERS)
        for turn in range(max((len(_OTHERS[w]) for w in named), default=0)):
            joined = {_OTHERS[w][turn % len(_OTHERS[w])] for w in named}
            yield {w for w, n in named.items() if every[w] == n and w not in joined}, {w for w in joined if w not in every}


def swapped(text: str | None) -> list[set[str]]:
    """The distinct words of the text after each of its ``swaps``. Empty if it names no group."""
    words = set(_WORD.findall((text or "").lower()))
    return [(words - left) | joined for left, joined in swaps(text)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
            counts[toxic.as_py()].update(text_features(text.as_py()))
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string())] + [pa.array([c[k] for k in keys], pa.int64()) for c in counts],
            names=["feature", "clean", "toxic"],
        )


def _known_features(words, index: dict[str, int]) -> Counter:
    """Feature numbers with the number of the words that have each."""
    return Counter(index[f] for w in words for f in word_features(w) if f in index)


def _encode(index: dict[str, int]):
    """The feature numbers of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(_known_features(set(_WORD.findall((t.as_py() or "").lower())), index)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(own, pa.list_(pa.int32()))], names=["spot", "toxic", "own"]
            )

    return run


def _changes(index: dict[str, int]):
    """What each swap changes: feature numbers that join and that leave, with the number of swaps of a batch that do so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times: Counter = Counter()
            for text in batch.column(0):
                value = text.as_py()
                found = None
                for left, joined in swaps(value):
                    if found is None:
                        found = _known_features(set(_WORD.findall(value.lower())), index)
                    minus, plus = _known_features(left, index), _known_features(joined, index)
                    gone = tuple(sorted(f for f, n in minus.items() if found[f] == n and f not in plus))
                    new = tuple(sorted(f for f in plus if not found[f]))
                    times[new, gone] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([list(k[0]) for k in times], pa.list_(pa.int32())),
                    pa.array([list(k[1]) for k in times], pa.list_(pa.int32())),
                    pa.array(list(times.values()), pa.int64()),
                ],
                names=["joined", "gone", "times"],
            )

    return run


def fit(
    rows: list[tuple[int, list[int]]], changes: list[tuple[list[int], list[int], int]], n: int, prior: float, settings: Settings
):
    """Weights and intercept from (label, features) rows and from swaps: features that join, features that go, and how often.

    Loss: mean log loss with both labels weighing alike, plus ``swap`` times the mean squared change of the
    linear score over all swaps, plus the ridge. The intercept then moves to the labels' true odds.
    """
    label = np.array([r[0] for r in rows], dtype=float)
    if label.sum() in (0, len(label)):
        return np.zeros(n), float(np.log(prior) - np.log1p(-prior))
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    col = np.array([f for r in rows for f in r[1]], dtype=np.int64)
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (len(label) - label.sum()))
    times = np.array([c[2] for c in changes], dtype=float)
    change = [(k, f, 1.0) for k, c in enumerate(changes) for f in c[0]] + [(k, f, -1.0) for k, c in enumerate(changes) for f in c[1]]
    pair_row = np.array([c[0] for c in change], dtype=np.int64)
    pair_col = np.array([c[1] for c in change], dtype=np.int64)
    sign = np.array([c[2] for c in change])
    weight, bias = np.zeros(n), 0.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, settings.steps + 1):
        z = bias + np.bincount(row, weights=weight[col], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) * share
        grad = np.bincount(col, weights=error[row], minlength=n) + settings.ridge * weight / np.sqrt(n + 1)
        if len(change):
            moved = times * np.bincount(pair_row, weights=sign * weight[pair_col], minlength=len(changes))
            grad += 2 * settings.swap / times.sum() * np.bincount(pair_col, weights=sign * moved[pair_row], minlength=n)
        full = np.append(grad, error.sum())
        m = 0.9 * m + 0.1 * full
        v = 0.999 * v + 0.001 * full**2
        delta = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        weight -= delta[:n]
        bias -= delta[n]
    return weight, float(bias + np.log(prior) - np.log1p(-prior))


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks 0 or 1.

    Other values, null ids and null texts' words count for nothing; of several labels of one document the largest
    holds. With one label or none, scores are the share of toxic rows (one half without any).
    """
    settings = settings or Settings()
    marked = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    marked = stored(marked.withColumn("spot", F.xxhash64("doc_id")), "labels")
    totals = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    prior = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
    chosen = marked.where("toxic = 0").orderBy("spot", "doc_id").limit(settings.rows).unionByName(
        marked.where("toxic = 1").orderBy("spot", "doc_id").limit(settings.rows)
    )
    # one text for each chosen id, also where rows repeat it
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "spot")
    sample = sample.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic", "spot")
    sample = stored(sample, "labelled")
    n0 = min(totals.get(0, 0), settings.rows) + 1.0
    n1 = min(totals.get(1, 0), settings.rows) + 1.0
    counted = (
        sample.select("text", "toxic")
        .mapInArrow(_count, "feature string, clean bigint, toxic bigint")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= settings.least_documents)
    )
    p0, p1 = (F.col("clean") + 0.5) / n0, (F.col("toxic") + 0.5) / n1
    gain = F.col("clean") * F.log(p0 / ((p0 + p1) / 2)) + F.col("toxic") * F.log(p1 / ((p0 + p1) / 2))
    best = (
        counted.withColumn("gain", 2 * gain)
        .where(F.col("gain") >= settings.least_gain)
        .orderBy(F.col("gain").desc(), "feature")
        .limit(settings.features)
        .select("feature")
    )
    names = [r.feature for r in best.collect()]
    index = {f: k for k, f in enumerate(dict.fromkeys([*names, *_OTHERS]))}
    encoded = sample.select("spot", "text", "toxic").mapInArrow(_encode(index), "spot bigint, toxic int, own array<int>")
    rows = sorted((r.spot, r.toxic, list(r.own)) for r in encoded.collect())
    # one row for each way in which a swap changes the features: few, whatever the size of the texts
    changed = sample.select("text").mapInArrow(_changes(index), "joined array<int>, gone array<int>, times bigint")
    changed = changed.groupBy("joined", "gone").agg(F.sum("times").alias("times"))
    changes = sorted((list(r.joined), list(r.gone), r.times) for r in changed.collect())
    weights, intercept = fit([r[1:] for r in rows], changes, len(index), prior, settings)
    return Model({f: float(weights[k]) for f, k in index.items() if weights[k]}, intercept)


def _scores(model: Model, most_words: int = 400_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, ...]] = {}
        weights = model.weights
        for batch in batches:
            out = []
            for text in batch.column(0):
                found: set[str] = set()
                for w in set(_WORD.findall((text.as_py() or "").lower())):
                    features = known.get(w)
                    if features is None:
                        if len(known) >= most_words:
                            known.clear()
                        features = known[w] = tuple(f for f in word_features(w) if f in weights)
                    if features:
                        found.update(features)
                out.append(model.intercept + sum(weights[f] for f in sorted(found)))
            score = 1 / (1 + np.exp(-np.clip(np.array(out, dtype=float), -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score)], names=[*batch.schema.names[1:], "score"])

    return run


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row with ``score``, the probability that its ``text`` is toxic.

    Null and empty texts get the score of no words. Rows, also repeated ones, stay as they are; an empty table gives an
    empty result.
    """
    (text,) = fresh(keep, "text_to_score")
    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in docs.select(*keep).schema.fields)
    return docs.select(F.col("text").cast("string").alias(text), *keep).mapInArrow(
        _scores(model), f"{schema}, score double"
    )


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows that labels may be learnt from; the fifth by crc32 of the id is held out."""
    return docs.where(bucket_of(F.col("doc_id"), 5) != 0)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = train(training_rows(docs), labels, settings)
    held_out = bucket_of(F.col("doc_id"), 5) == 0
    return score(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
