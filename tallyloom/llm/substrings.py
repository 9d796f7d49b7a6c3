"""Removal of repeated word windows by recompression.

Two rounds name pairs of neighbours: a class by the symbol's name says whether it may open or close a pair, so
equal passages get equal symbols but for their ends. Where a symbol starts depends on two words before and after
it, so every window of 13 words has a symbol start that all its occurrences share. A window is known by
the least-named such start with the words around it. Spark finds starts shared by several texts, and then
the windows of these starts are held against each other by their own names, over the whole table.

Names are 64-bit mixes of what they stand for, so equal symbols get equal names in every task without a table of
names; a window is taken for another with a chance near 2^-64 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored
from tallyloom.llm.packing import pack, unpack
from tallyloom.llm.words import join_names, mix, slices, text_bytes, words_in

_LAST = np.iinfo(np.int64).max
_NO = np.uint64(0xFFFFFFFFFFFFFFFF)
# Words that a symbol start of the second round depends on, before and behind it.
_BEFORE, _BEHIND = 2, 2


@dataclass(frozen=True)
class Settings:
    """``window``: words of a window. ``around``: words of a start's name, from two before it. ``chunk_bytes``, ``bucket_keys``:
    text of a chunk and names of a bucket, about."""

    window: int = 13
    around: int = 7
    chunk_bytes: int = 8 << 20
    bucket_keys: int = 2_000_000

    def __post_init__(self):
        if not 4 <= self.around <= self.window - 3:
            raise ValueError("a window must hold four places of a start with the words around it")


CHUNK = "chunk bigint, ids array<bigint>, sizes binary, body binary, bytes bigint"


def _chunks(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, made = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for begin, end in slices(settings.chunk_bytes, batch.column(1)):
                data, bounds = text_bytes(batch.column(1).slice(begin, end - begin))
                body = pa.Codec("zstd", compression_level=6).compress(data.tobytes(), asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([first + made], pa.int64()),
                        pa.array([keys[begin:end]], pa.list_(pa.int64())),
                        pa.array([pack(np.diff(bounds))], pa.binary()),
                        pa.array([body], pa.binary()),
                        pa.array([len(data)], pa.int64()),
                    ],
                    names=["chunk", "ids", "sizes", "body", "bytes"],
                )
                made += 1

    return run


def _pairs(names: np.ndarray, fresh: np.ndarray, round_: int) -> np.ndarray:
    """Which symbols are joined to the one before: it may open a pair, they may close one, and both are of one text."""
    closes = (mix(names ^ np.uint64(round_ * 0x51ED27)) & np.uint64(1)).astype(bool)
    joined = np.zeros(len(names), dtype=bool)
    joined[1:] = closes[1:] & ~closes[:-1] & ~fresh[1:]
    return joined


def symbol_starts(name: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word whether a symbol of the second round starts there; ``first`` has the bounds of the texts."""
    fresh = np.zeros(len(name) + 1, dtype=bool)
    fresh[first] = True
    fresh = fresh[:-1]
    starts = np.arange(len(name))
    symbols = name
    for round_ in (1, 2):
        joined = _pairs(symbols, fresh[starts], round_)
        heads = np.flatnonzero(~joined)
        paired = np.zeros(len(heads), dtype=bool)
        paired[:-1] = np.diff(heads) == 2
        if len(heads):
            paired[-1] = heads[-1] == len(symbols) - 2
        new = symbols[heads].copy()
        new[paired] = join_names(symbols[heads[paired]], symbols[heads[paired] + 1])
        starts, symbols = starts[heads], new
    out = np.zeros(len(name), dtype=bool)
    out[starts] = True
    return out


class _Chunk:
    """Words and windows of a chunk."""

    def __init__(self, row: dict, settings: Settings):
        self.ids = row["ids"]
        sizes = unpack(row["sizes"], kind=np.int64)
        self.data = np.frombuffer(
            pa.decompress(row["body"], decompressed_size=row["bytes"], codec="zstd", asbytes=True), dtype=np.uint8
        )
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        words = words_in(self.data, self.bounds, lower=False)
        self.name, self.first = words.name, words.first
        self.doc = np.array([_LAST if i is None else i for i in self.ids], dtype=np.int64)
        n, w = len(self.name), settings.window
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(n)
        self.opens = np.flatnonzero(left >= w)
        self.settings = settings

    def shared_starts(self) -> np.ndarray:
        """For each window the name of its least-named start with the words around."""
        n, s = len(self.name), self.settings
        name = np.full(n, _NO)
        starts = symbol_starts(self.name, self.first)
        at = np.flatnonzero(starts[: n - s.around + 1 + _BEFORE]) if n else np.zeros(0, np.int64)
        at = at[(at >= _BEFORE) & (at - _BEFORE + s.around <= n)]
        # the words around may belong to two texts here; no window then looks at that start
        name[at] = join_names(*[self.name[at - _BEFORE + k] for k in range(s.around)])
        best = np.full(len(self.opens), _NO)
        for k in range(_BEFORE, s.window - s.around + _BEFORE + 1):
            np.minimum(best, name[self.opens + k], out=best)
        return best

    def windows(self, which: np.ndarray) -> np.ndarray:
        """Names of the windows that open at the given places."""
        return join_names(*[self.name[which + k] for k in range(self.settings.window)])

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), np.diff(self.first))


def _by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """Ranges of sorted keys by bucket."""
    step = (1 << 64) // buckets + 1
    cuts = np.searchsorted(keys, np.array([b * step for b in range(1, buckets)], dtype=np.uint64))
    ends = [0, *cuts.tolist(), len(keys)]
    return [(b, slice(ends[b], ends[b + 1])) for b in range(buckets) if ends[b + 1] > ends[b]]


SENT = "bucket int, chunk bigint, keys binary, flags binary, docs binary"
ANSWER = "chunk bigint, bucket int, keys binary, flags binary, docs binary"
_TYPES = {"bucket": pa.int32(), "chunk": pa.int64(), "keys": pa.binary(), "flags": pa.binary(), "docs": pa.binary()}


def _rows(rows: list[dict]) -> dict[str, pa.Array]:
    return {c: pa.array([r.get(c) for r in rows], t) for c, t in _TYPES.items()}


def _signed(values: np.ndarray) -> bytes:
    """Ids as steps from the least, which stands in front."""
    least = int(values.min()) if len(values) else 0
    return least.to_bytes(8, "little", signed=True) + pack((values - least).astype(np.uint64))


def _ids(data: bytes) -> np.ndarray:
    return unpack(data[8:], kind=np.uint64).astype(np.int64) + int.from_bytes(data[:8], "little", signed=True)


def _send_starts(settings: Settings, buckets: int):
    """A chunk's distinct shared-start names, with a flag for those in several of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, settings)
                best = chunk.shared_starts()
                doc = chunk.doc[chunk.document()[chunk.opens]]
                keys, inverse = np.unique(best, return_inverse=True)
                inverse = inverse.reshape(-1)
                low, high = np.full(len(keys), _LAST), np.full(len(keys), np.iinfo(np.int64).min)
                np.minimum.at(low, inverse, doc)
                np.maximum.at(high, inverse, doc)
                several = low < high
                out = [
                    {
                        "bucket": b,
                        "chunk": row["chunk"],
                        "keys": pack(keys[part], rising=True),
                        "flags": np.packbits(several[part]).tobytes(),
                    }
                    for b, part in _by_bucket(keys, buckets)
                ]
                yield pa.RecordBatch.from_pydict(_rows(out))

    return run


def _find_shared(key, table):
    """For each chunk a flag for each of its names in a bucket: found in several documents."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    sent = [unpack(r["keys"], rising=True) for r in rows]
    flags = [np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=len(s)) for r, s in zip(rows, sent, strict=True)]
    _, inverse, count = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    inverse = inverse.reshape(-1)
    shared = count > 1
    shared[inverse[np.concatenate(flags).astype(bool)]] = True
    spread, at, out = shared[inverse], 0, []
    for r, s in zip(rows, sent, strict=True):
        out.append({"bucket": r["bucket"], "chunk": r["chunk"], "flags": np.packbits(spread[at : at + len(s)]).tobytes()})
        at += len(s)
    return pa.table(_rows(out)).select(["chunk", "bucket", "keys", "flags", "docs"])


def _send_windows(settings: Settings, buckets: int):
    """The distinct windows of a chunk's shared starts, with the smallest document of each."""

    def run(key, left, right):
        row = left.to_pylist()[0]
        chunk = _Chunk(row, settings)
        best = chunk.shared_starts()
        keys = np.unique(best)
        shared = np.zeros(len(keys), dtype=bool)
        answers = {r["bucket"]: r["flags"] for r in right.to_pylist()}
        for b, part in _by_bucket(keys, buckets):
            shared[part] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=part.stop - part.start)
        opens = chunk.opens[shared[np.searchsorted(keys, best)]] if len(keys) else chunk.opens
        doc = chunk.doc[chunk.document()[opens]]
        names, inverse = np.unique(chunk.windows(opens), return_inverse=True)
        inverse = inverse.reshape(-1)
        low, high = np.full(len(names), _LAST), np.full(len(names), np.iinfo(np.int64).min)
        np.minimum.at(low, inverse, doc)
        np.maximum.at(high, inverse, doc)
        out = [
            {
                "bucket": b,
                "chunk": row["chunk"],
                "keys": pack(names[part], rising=True),
                "flags": np.packbits(low[part] < high[part]).tobytes(),
                "docs": _signed(low[part]),
            }
            for b, part in _by_bucket(names, buckets)
        ]
        return pa.table(_rows(out)).select(["bucket", "chunk", "keys", "flags", "docs"])

    return run


def _find_first(key, table):
    """For each chunk the windows of a bucket that may stand in a document after the first, and that first document."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    sent = [unpack(r["keys"], rising=True) for r in rows]
    low = [_ids(r["docs"]) for r in rows]
    names, inverse = np.unique(np.concatenate(sent), return_inverse=True)
    inverse = inverse.reshape(-1)
    first = np.full(len(names), _LAST)
    np.minimum.at(first, inverse, np.concatenate(low))
    at, out = 0, []
    for r, s, own in zip(rows, sent, low, strict=True):
        least = first[inverse[at : at + len(s)]]
        at += len(s)
        several = np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=len(s)).astype(bool)
        later = (least < own) | several
        if later.any():
            out.append(
                {"bucket": r["bucket"], "chunk": r["chunk"], "keys": pack(s[later], rising=True), "docs": _signed(least[later])}
            )
    return pa.table(_rows(out)).select(["chunk", "bucket", "keys", "flags", "docs"])


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept binary, kept_sha256 string"


def _without(settings: Settings, with_text: bool):
    def run(key, left, right):
        row = left.to_pylist()[0]
        chunk = _Chunk(row, settings)
        answers = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        keys = np.concatenate([unpack(r["keys"], rising=True) for r in answers] or [np.zeros(0, np.uint64)])
        first = np.concatenate([_ids(r["docs"]) for r in answers] or [np.zeros(0, np.int64)])
        covered = np.zeros(len(chunk.name) + 1, dtype=np.int64)
        if len(keys):
            document = chunk.document()
            for begin in range(0, len(chunk.opens), 1 << 18):
                opens = chunk.opens[begin : begin + (1 << 18)]
                names = chunk.windows(opens)
                at = np.minimum(np.searchsorted(keys, names), len(keys) - 1)
                gone = opens[(keys[at] == names) & (first[at] < chunk.doc[document[opens]])]
                np.add.at(covered, gone, 1)
                np.add.at(covered, gone + settings.window, -1)
        keep = np.cumsum(covered[:-1]) == 0
        data, sums, removed, texts = chunk.data.tobytes(), [], [], []
        for d in range(len(chunk.ids)):
            a, b = int(chunk.first[d]), int(chunk.first[d + 1])
            words = data[chunk.bounds[d] : chunk.bounds[d + 1]].split()
            stays = keep[a:b]
            if not stays.all():
                words = [w for w, k in zip(words, stays.tolist(), strict=True) if k]
            text = b" ".join(words)
            sums.append(hashlib.sha256(text).hexdigest())
            removed.append(b - a - len(words))
            texts.append(text if with_text else None)
        return pa.table(
            {
                "doc_id": pa.array(chunk.ids, pa.int64()),
                "n_words": pa.array(np.diff(chunk.first).astype(np.int64)),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(texts, pa.binary()),
                "kept_sha256": pa.array(sums, pa.string()),
            }
        )

    return run


def remove_repeated(docs: DataFrame, settings: Settings | None = None, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept (UTF-8 words with one space between, if ``with_text``) and kept_sha256 of every row.

    A word goes if a window that covers it also starts in a document with a smaller doc_id; all windows are those
    of the input. Rows that share a doc_id leave each other alone. A row without a doc_id comes after all
    others and is the first of none. Null, empty and short texts have no windows and keep their words. A run of one
    word is one window however long it is. An empty table gives an empty result.
    """
    settings = settings or Settings()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = stored(source.mapInArrow(_chunks(settings), CHUNK), "substring-chunks")
    size = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(4, size // 24 // settings.bucket_keys)
    shared = chunks.mapInArrow(_send_starts(settings, buckets), SENT).groupBy("bucket").applyInArrow(_find_shared, ANSWER)
    by_chunk = chunks.groupBy("chunk")
    windows = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_send_windows(settings, buckets), SENT)
    firsts = windows.groupBy("bucket").applyInArrow(_find_first, ANSWER)
    found = by_chunk.cogroup(firsts.groupBy("chunk")).applyInArrow(_without(settings, with_text), RESULT)
    return found if with_text else found.drop("kept")
