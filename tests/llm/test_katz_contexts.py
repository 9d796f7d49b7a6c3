"""Sums go out for the contexts of texts held out only, and the scores are those of the whole model."""

import random

import numpy as np
import pytest

from tallyloom.llm import katz as module
from tallyloom.llm.katz import Settings, katz
from tallyloom.llm.packing import unpack

from llm.test_katz import agrees, held, random_rows, tokens_of


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_without_tables_equal_plain_version(spark, docs, order):
    rows = random_rows()
    agrees(rows, katz(docs(*rows), Settings(order=order, chunk_tokens=60, bucket_keys=40, tables=False)).scores, order)


def test_only_contexts_of_texts_held_out_are_summed(spark, docs, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(40))) for i in range(40)]
    sent = {}
    stored = module.stored

    def seen(frame, name, *partitions):
        back = stored(frame, name, *partitions)
        if name == "katz-texts":
            keys = [unpack(r["keys"], rising=True) for r in back.where("kind = 'mass'").select("keys").collect()]
            sent[len(sent)] = np.unique(np.concatenate(keys))
        return back

    monkeypatch.setattr(module, "stored", seen)
    for tables in (False, True):
        katz(docs(*rows), Settings(order=3, chunk_tokens=300, bucket_keys=400, tables=tables)).scores.count()
    grams = [set(), set()]
    for doc, text in rows:
        seq = tokens_of(text)
        for n in (1, 2):
            grams[held(doc)] |= {tuple(seq[i : i + n]) for i in range(len(seq) - n + 1)}
            grams[held(doc)].add(("start", seq[0]))
    # one more for the start of a text
    assert len(sent[0]) <= len(grams[1]) + 1 < len(grams[0]) / 2
    assert len(sent[1]) > 2 * len(sent[0])


def test_levels_are_counted_apart(spark, docs, monkeypatch):
    levels = []
    stored = module.stored

    def seen(frame, name, *partitions):
        back = stored(frame, name, *partitions)
        if name == "katz-counts":
            levels.append({r["level"] for r in back.select("level").distinct().collect()})
        return back

    monkeypatch.setattr(module, "stored", seen)
    katz(docs(*random_rows()), Settings(order=3, chunk_tokens=60, bucket_keys=40, tables=False)).scores.count()
    assert levels == [{1}, {2}, {3}]
