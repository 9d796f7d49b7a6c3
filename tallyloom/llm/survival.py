"""Which documents each order of five quality filters keeps, counted from truth-table words.

A document fails some of the filters. Its survival word has one bit for each of the 32 subsets of filters, set where the
document fails none of the subset. Positional popcounts of the words, by carry-save addition, say how many documents of a
part survive each subset, and every figure of every order follows from those 32 counts.

Filters: A under 200 words; B fewer than half of the words distinct; C more than 2 % capitals A-Z; D any of ``#$%&*|``;
E the same text as a document with a smaller doc_id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
SAME = 1 << FILTERS.index("E")
LABELS = ("all", "good", "toxic")
# A repeated text is told to its copies in so many parts.
SPREAD = 64
# Longer texts are split into words piece by piece; parts that a task counts before it hands them on.
PIECE = 1 << 20
MOST_PARTS = 10_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_CAPITALS = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"
_INNER = bytes(range(0x80, 0xC0))

# By failed filters: the word whose bit S is set where none of them is in S.
WORD_OF = np.array(
    [sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], dtype=np.uint32
)


def count_words(text: bytes) -> tuple[int, int]:
    """Words and distinct words of a text."""
    if len(text) <= PIECE:
        words = text.split()
        return len(words), len(set(words))
    seen, n, at = set(), 0, 0
    while at < len(text):
        gap = _SPACE.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        words = text[at:end].split()
        seen.update(words)
        n, at = n + len(words), end
    return n, len(seen)


def failed_filters(text: bytes) -> int:
    """Bits of the filters A to D that the text fails."""
    n, distinct = count_words(text)
    points = len(text.translate(None, _INNER))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return (n < 200) | (100 * distinct < 50 * n) << 1 | (100 * capitals > 2 * points) << 2 | (symbols > 0) << 3


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Failed filters and a 256-bit name of each text instead of the text."""
    for batch in batches:
        failed, names = [], []
        for value in batch.column(2).cast(pa.large_string()).cast(pa.large_binary()):
            text = value.as_py() or b""
            failed.append(int(failed_filters(text)))
            names.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(failed, pa.int32()), pa.array(names, pa.binary())],
            names=["part", "doc", "failed", "name"],
        )


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many words have each bit set.

    Three words of one weight become a sum of that weight and a carry of twice the weight, for all bits at once, until
    at most two words of each weight are left; only those are looked at bit by bit.
    """
    bits = np.arange(SUBSETS, dtype=np.uint32)
    counts = np.zeros(SUBSETS, dtype=np.int64)
    weight, level = 1, words
    while len(level):
        carries = [level[:0]]
        while len(level) >= 3:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * third :]])
        counts += weight * ((level[:, None] >> bits) & 1).sum(axis=0, dtype=np.int64)
        weight, level = 2 * weight, np.concatenate(carries)
    return counts


def _survivor_rows(found: dict) -> pa.RecordBatch:
    rows = [(p, k, s, int(n)) for p, of in found.items() for k in range(len(LABELS)) for s, n in enumerate(of[k])]
    types = {"part": pa.string(), "label": pa.int32(), "subset": pa.int32(), "n": pa.int64()}
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types))


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Survivors of every subset by part and label, as far as this task sees them."""
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        words = WORD_OF[batch.column(1).to_numpy(zero_copy_only=False)]
        kinds = [np.ones(len(code), bool)] + [batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)]
        order = np.argsort(code, kind="stable")
        parts = coded.dictionary.to_pylist()
        edges = np.searchsorted(code[order], np.arange(len(parts) + 1))
        for p, part in enumerate(parts):
            rows = order[edges[p] : edges[p + 1]]
            counts = np.stack([positional_popcount(words[rows[kind[rows]]]) for kind in kinds])
            found[part] = found[part] + counts if part in found else counts
        if len(found) >= MOST_PARTS:
            yield _survivor_rows(found)
            found = {}
    yield _survivor_rows(found)


def report(left: np.ndarray) -> Iterator[tuple]:
    """All orders and steps of one part from the survivors of each subset, by label: (order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    everyone, whole = left[0], SUBSETS - 1
    n = len(FILTERS)
    alone, unique, shapley = [], [], []
    for f in range(n):
        bit = 1 << f
        alone.append(everyone[0] - everyone[bit])
        unique.append(everyone[whole ^ bit] - everyone[whole])
        before = [s for s in range(SUBSETS) if not s & bit]
        orders = [factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) for s in before]
        shapley.append(sum(w * (everyone[s] - everyone[s | bit]) for w, s in zip(orders, before, strict=True)))
    for order in permutations(range(n)):
        name, done = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            now = done | 1 << f
            removed, good, toxic = (left[k][done] - left[k][now] for k in range(len(LABELS)))
            yield name, step, everyone[now], removed, alone[f] - removed, unique[f], good, toxic, shapley[f]
            done = now


_REPORT = {"part": pa.string(), "filter_order": pa.string(), "step": pa.int32()} | {
    c: pa.int64() for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
}


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            left = [[0] * SUBSETS for _ in LABELS]
            for cell in found.as_py():
                left[cell["label"]][cell["subset"]] = cell["n"]
            columns = zip(*[(part, *row) for row in report(left)], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _REPORT.values(), strict=True)], list(_REPORT)
            )


def failures(docs: DataFrame) -> DataFrame:
    """(part, doc, failed): the bits of the filters that each document fails, one row per row of ``docs``.

    Texts are equal when their SHA-256 is. The smallest doc_id of a text repeated is found over parts of its copies and
    told to each part, so that copies by the million do not meet in one task.
    """
    picked = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("bigint").alias("doc"),
        F.col("text").cast("string"),
    )
    facts = stored(picked.mapInArrow(_facts, "part string, doc bigint, failed int, name binary"), "filter-facts")
    facts = facts.withColumn("spot", F.pmod(F.xxhash64("doc"), F.lit(SPREAD)))
    spots = facts.groupBy("name", "spot").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    firsts = spots.groupBy("name").agg(
        F.min("least").alias("first"), F.max("most").alias("last"), F.collect_list("spot").alias("spots")
    )
    firsts = firsts.where("last > first").select("name", "first", F.explode("spots").alias("spot"))
    same = F.when(F.col("doc") > F.col("first"), SAME).otherwise(0)
    return facts.join(firsts, ["name", "spot"], "left").select("part", "doc", (F.col("failed") + same).alias("failed"))


def survivors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, label, subset, n): documents of a part that fail no filter of the subset; label 0 counts all, 1 those of
    quality 1, 2 the toxic ones."""
    kinds = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = failures(docs).join(kinds, "doc", "left")
    rows = rows.select("part", "failed", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    counted = rows.mapInArrow(_survivors, "part string, label int, subset int, n bigint")
    return counted.groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (source; null is the empty string), order of the five filters and step.

    ``kept``: documents left after the step; ``removed``: gone here; ``redundant``: failing its filter, gone before;
    ``unique_fails``: failing its filter only; ``good_lost``, ``toxic_lost``: of those removed, quality 1 and toxic 1;
    ``shapley``: its filter's removed documents over all 120 orders.

    ``docs`` has doc_id (an integer), source and text, ``labels`` doc_id, quality and toxic; other columns are not
    read, whatever their names. Null texts are empty: they fail A, and E after the first. Every row counts, repeated
    ones too; rows of one doc_id and text do not fail E by each other. A null doc_id never fails E, is nobody's smaller doc_id, and has no label.
    Several labels of one doc_id count as one that is good (toxic) if any is. No documents give no rows.
    """
    cells = survivors(docs, labels).groupBy("part").agg(F.collect_list(F.struct("label", "subset", "n")).alias("found"))
    schema = "part string, filter_order string, step int" + "".join(f", {c} bigint" for c in list(_REPORT)[3:])
    return cells.mapInArrow(_reports, schema)
