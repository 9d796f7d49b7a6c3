"""Katz backoff language model: counting, discounts, backoff weights and scores.

Texts are read once and kept as chunks: the distinct words of some million tokens and the token
sequence as places among them. A chunk sends its distinct n-grams with their training counts to the owners of
their key's bucket, and gets the corpus counts back in the same order. Each n-gram of the corpus belongs to one of its chunks,
which adds its discounted probability and its lower-order probability to its context; from these
sums the contexts' owners get the exact backoff weights, for the tokens that need them. Every n-gram of a text that was learnt
from is known, so only texts held out need weights: chunks mark the n-grams that stand in such texts, the owners tell all chunks, and
unless the model's tables are asked for only marked contexts are summed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bucket_of, release, stored
from tallyloom.llm.packing import pack, unpack
from tallyloom.llm.words import join_names, mix, slices, words_of

# Names of the end token and of the start of a text, which is context only.
END, START = (int(x) for x in mix(np.array([0x656E64, 0x7374617274], dtype=np.uint64)))


@dataclass(frozen=True)
class Settings:
    """``order``: longest n-gram. ``cutoff``: counts up to it are discounted. ``held``: one text in so many is
    not learnt from. ``chunk_tokens``, ``bucket_keys``: tokens of a chunk and n-grams of a bucket, about. ``tables``: whether
    the counts and weights of the model are kept as tables; the scores need neither."""

    order: int = 2
    cutoff: int = 5
    held: int = 10
    chunk_tokens: int = 1_000_000
    bucket_keys: int = 1_200_000
    tables: bool = True


# Part of one count that counts above the cutoff give away: without it a context that has only such counts would
# leave nothing to unseen tokens.
RESERVE = 0.01


@dataclass(frozen=True)
class Discounts:
    """Discount factors of counts 0 to cutoff of one order (0 unused) and totals."""

    factor: tuple[float, ...]
    tokens: int
    types: int

    def reduced(self, counts: np.ndarray) -> np.ndarray:
        """Counts after the discount."""
        table = np.array(self.factor)
        small = table[np.minimum(counts, len(table) - 1)] * counts
        return np.where(counts < len(table), small, counts - RESERVE)


def good_turing(found: list[int], cutoff: int) -> tuple[float, ...]:
    """Katz's factors from the numbers of n-grams seen 1 to cutoff + 1 times.

    d_r = (r*/r - A) / (1 - A) with r* = (r + 1) n_(r+1) / n_r and A = (cutoff + 1) n_(cutoff+1) / n_1. Where
    that isn't between 0 and 1, the absolute discount n_1 / (n_1 + 2 n_2) is taken, or one half without singletons.
    """
    n = [0, *found]
    flat = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    share = (cutoff + 1) * n[cutoff + 1] / n[1] if n[1] else 1.0
    out = [1.0]
    for r in range(1, cutoff + 1):
        d = 0.0
        if n[r] and share < 1:
            d = ((r + 1) * n[r + 1] / n[r] / r - share) / (1 - share)
        out.append(d if 0 < d < 1 else (r - flat) / r)
    return tuple(out)


@dataclass(frozen=True)
class Unigrams:
    """Probability of a token, known or not; all known ones and one unknown sum to 1."""

    discounts: Discounts
    unseen: float

    @classmethod
    def of(cls, discounts: Discounts, found: list[int]) -> Unigrams:
        total = max(discounts.tokens, 1)
        small = range(1, len(discounts.factor))
        freed = sum((1 - discounts.factor[r]) * r * found[r - 1] for r in small)
        freed += RESERVE * (discounts.types - sum(found[r - 1] for r in small))
        return cls(discounts, freed / total if freed > 0 else 1.0)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.reduced(counts) / max(self.discounts.tokens, 1), self.unseen)


def _held_out(ids: list, held: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % held == 0 for i in ids], dtype=bool)


CHUNK = "chunk bigint, ids array<bigint>, sizes binary, words binary, places binary, tokens bigint"


def _chunks(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, ids, sizes, names = 0, [], [], []
        first = TaskContext.get().partitionId() << 24

        def flush():
            name = np.concatenate(names)
            words, places = np.unique(name, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([first + made], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([pack(np.concatenate(sizes))], pa.binary()),
                    pa.array([pack(words, rising=True)], pa.binary()),
                    pa.array([pack(places.reshape(-1))], pa.binary()),
                    pa.array([len(name)], pa.int64()),
                ],
                names=["chunk", "ids", "sizes", "words", "places", "tokens"],
            )

        held = 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for begin, end in slices(2 << 20, batch.column(1)):
                words = words_of(batch.column(1).slice(begin, end - begin), lower=True)
                ids.extend(keys[begin:end])
                sizes.append(words.counts() + 1)
                names.append(np.insert(words.name, words.first[1:], np.uint64(END)))
                held += len(names[-1])
                if held >= settings.chunk_tokens:
                    yield flush()
                    made, ids, sizes, names, held = made + 1, [], [], [], 0
        if ids:
            yield flush()

    return run


class _Chunk:
    """The n-grams of a chunk: for each level, or the one level ``only``, the sorted distinct keys, and each token's place among them."""

    def __init__(self, sizes: bytes, words: bytes, places: bytes, order: int, only: int | None = None):
        self.sizes = unpack(sizes, kind=np.int64)
        name = unpack(words, rising=True)[unpack(places, kind=np.int64)]
        self.end = np.cumsum(self.sizes)
        self.begin = self.end - self.sizes
        n = len(name)
        # place of each token in its text
        self.spot = np.arange(n) - np.repeat(self.begin, self.sizes)
        gram = name
        self.keys: list[np.ndarray | None] = []
        self.place: list[np.ndarray | None] = []
        for level in range(1, order + 1):
            if level > 1:
                # the n-gram's name comes from the shorter one that ends before it and its last token
                gram = join_names(np.concatenate([gram[:1], gram[:-1]]), name)
                if level == 2:
                    gram[self.begin] = join_names(np.full(len(self.begin), START, dtype=np.uint64), name[self.begin])
                used = np.flatnonzero(self.spot >= level - 2)
            else:
                used = np.arange(n)
            if only not in (None, level):
                self.keys.append(None)
                self.place.append(None)
                continue
            keys, inverse = np.unique(gram[used], return_inverse=True)
            place = np.full(n, -1, dtype=np.int32)
            place[used] = inverse.reshape(-1)
            self.keys.append(keys)
            self.place.append(place)

    def context(self, level: int) -> np.ndarray:
        """Place of each token's context among the keys of the level below, -1 for the start of a text."""
        below = self.place[level - 2]
        out = np.concatenate([below[:1], below[:-1]])
        out[self.begin] = -1
        return out


def _by_bucket(keys: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Places of sorted keys by bucket: a bucket is a range of keys."""
    step = (1 << 64) // buckets + 1
    cuts = np.searchsorted(keys, np.array([min(b * step, (1 << 64) - 1) for b in range(1, buckets)], dtype=np.uint64))
    return np.split(np.arange(len(keys)), cuts)


def _marks(settings: Settings, level: int) -> bool:
    """Whether n-grams of the level are marked that stand in texts held out: they may be contexts that need a weight."""
    return level < settings.order and not settings.tables


def _bits(flags: np.ndarray) -> bytes:
    return pa.compress(np.packbits(flags).tobytes(), codec="zstd", asbytes=True)


def _flags(data: bytes, n: int) -> np.ndarray:
    """The ``n`` flags that ``_bits`` was given."""
    raw = pa.decompress(data, decompressed_size=-(-n // 8), codec="zstd", asbytes=True)
    return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=n).astype(bool)


REQUEST = "bucket int, level int, chunk bigint, keys binary, counts binary, marked binary"


def _requests(settings: Settings, buckets: int, level: int):
    """The keys of one level for the owners of their buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, ids, sizes, words, places = (batch.column(k)[row].as_py() for k in range(5))
                chunk = _Chunk(sizes, words, places, level, only=level)
                learnt = np.repeat(~_held_out(ids, settings.held), chunk.sizes)
                keys, place = chunk.keys[level - 1], chunk.place[level - 1]
                counts = np.bincount(place[learnt & (place >= 0)], minlength=len(keys))
                marked = None
                if _marks(settings, level):
                    marked = np.zeros(len(keys), dtype=bool)
                    marked[place[~learnt & (place >= 0)]] = True
                out = []
                for b, part in enumerate(_by_bucket(keys, buckets)):
                    if len(part):
                        flags = None if marked is None else _bits(marked[part])
                        out.append((b, level, number, pack(keys[part], rising=True), pack(counts[part]), flags))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[k] for o in out], t)
                        for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))
                    ],
                    names=["bucket", "level", "chunk", "keys", "counts", "marked"],
                )

    return run


COUNTED = (
    "kind string, level int, bucket int, chunk bigint, keys binary, counts binary, owned binary, marked binary, "
    "found array<bigint>"
)


def _count(settings: Settings):
    """Corpus counts of one bucket of one level: the table, the answers to the chunks, and the numbers of counts."""

    def run(key, table):
        chunks = table["chunk"].to_pylist()
        order = sorted(range(len(chunks)), key=chunks.__getitem__)
        sent = [unpack(table["keys"][k].as_py(), rising=True) for k in order]
        counts = [unpack(table["counts"][k].as_py(), kind=np.int64) for k in order]
        keys, first, inverse = np.unique(np.concatenate(sent), return_index=True, return_inverse=True)
        inverse = inverse.reshape(-1)
        total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)
        owner = np.zeros(len(inverse), dtype=bool)
        owner[first] = True
        marked = np.zeros(len(keys), dtype=bool)
        if _marks(settings, key[1].as_py()):
            flags = [_flags(table["marked"][k].as_py(), len(part)) for k, part in zip(order, sent, strict=True)]
            marked[inverse[np.concatenate(flags)]] = True
        seen = total > 0
        found = [int((total == r).sum()) for r in range(1, settings.cutoff + 2)] + [int(total.sum()), int(seen.sum())]
        table_of = (pack(keys[seen], rising=True), pack(total[seen])) if settings.tables else (None, None)
        rows = [("table", None, *table_of, None, None, found)]
        at = 0
        for k, part in zip(order, sent, strict=True):
            span = slice(at, at + len(part))
            told = _bits(marked[inverse[span]]) if _marks(settings, key[1].as_py()) else None
            rows.append(("answer", chunks[k], None, pack(total[inverse[span]]), _bits(owner[span]), told, None))
            at += len(part)
        n = len(rows)
        return pa.table(
            {
                "kind": pa.array([r[0] for r in rows]),
                "level": pa.array([key[1].as_py()] * n, pa.int32()),
                "bucket": pa.array([key[0].as_py()] * n, pa.int32()),
                "chunk": pa.array([r[1] for r in rows], pa.int64()),
                "keys": pa.array([r[2] for r in rows], pa.binary()),
                "counts": pa.array([r[3] for r in rows], pa.binary()),
                "owned": pa.array([r[4] for r in rows], pa.binary()),
                "marked": pa.array([r[5] for r in rows], pa.binary()),
                "found": pa.array([r[6] for r in rows], pa.list_(pa.int64())),
            }
        )

    return run


EVALUATED = (
    "kind string, chunk bigint, bucket int, keys binary, seen binary, lower binary, doc binary, times binary, "
    "spot bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, partial double"
)
_EVALUATED = pa.schema(
    [("kind", pa.string()), ("chunk", pa.int64()), ("bucket", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "seen", "lower", "doc", "times")]
    + [(c, pa.int64()) for c in ("spot", "doc_id", "n_tokens", "n_known")]
    + [("base_score", pa.float64()), ("partial", pa.float64())]
)


def _evaluate(settings: Settings, buckets: int, discounts: list[Discounts], unigrams: Unigrams, texts: int):
    """A chunk's texts with all but the backoff weights; what it adds to the weights' sums, and where it needs them."""

    def run(key, left, right):
        rows: dict[str, list] = {f.name: [] for f in _EVALUATED}

        def put(n, **values):
            for f in _EVALUATED:
                rows[f.name].extend(values[f.name] if f.name in values else [None] * n)

        number = key[0].as_py()
        ids, sizes, words, places = (left[c][0].as_py() for c in ("ids", "sizes", "words", "places"))
        chunk = _Chunk(sizes, words, places, settings.order)
        levels, buckets_of = right["level"].to_pylist(), right["bucket"].to_pylist()
        counts, owned, marked = [], [], []
        for level in range(1, settings.order + 1):
            at = sorted((b, k) for k, (n, b) in enumerate(zip(levels, buckets_of, strict=True)) if n == level)
            parts = [unpack(right["counts"][k].as_py(), kind=np.int64) for _, k in at]

            def flags_of(column, at=at, parts=parts):
                flags = [_flags(right[column][k].as_py(), len(p)) for (_, k), p in zip(at, parts, strict=True)]
                return np.concatenate(flags) if flags else np.zeros(0, bool)

            counts.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
            owned.append(flags_of("owned"))
            marked.append(flags_of("marked") if _marks(settings, level) else None)
        tokens = len(chunk.spot)
        document = np.repeat(np.arange(len(ids)), chunk.sizes)
        one = counts[0][chunk.place[0]]
        lower = unigrams.probability(counts[0])[chunk.place[0]]
        base = np.log10((one + 0.1) / (discounts[0].tokens + 0.1 * (discounts[0].types + 1)))
        score, open_ = np.zeros(tokens), np.ones(tokens, dtype=bool)
        needed: list[tuple[np.ndarray, np.ndarray]] = []
        probability = [lower]
        for level in range(2, settings.order + 1):
            place, context = chunk.place[level - 1], chunk.context(level)
            own = np.where(place >= 0, counts[level - 1][place], 0)
            above = np.where(context >= 0, counts[level - 2][context], texts)
            reduced = discounts[level - 1].reduced(own)
            p = reduced / np.maximum(above, 1)
            probability.append(np.where(own > 0, p, 0.0))
            # one token of each n-gram that this chunk owns speaks for it
            speaks = np.zeros(tokens, dtype=bool)
            distinct, at = np.unique(place, return_index=True)
            speaks[at[distinct >= 0]] = owned[level - 1][distinct[distinct >= 0]]
            speaks &= own > 0
            if not settings.tables:
                # nobody needs the weights of other contexts
                speaks &= np.where(context >= 0, marked[level - 2][context], True)
            name = np.where(context >= 0, chunk.keys[level - 2][context], np.uint64(START))
            keys, inverse = np.unique(name[speaks], return_inverse=True)
            inverse = inverse.reshape(-1)
            top = np.zeros(len(keys))
            top[inverse] = above[speaks]
            seen = np.bincount(inverse, weights=reduced[speaks], minlength=len(keys))
            beneath = np.bincount(inverse, weights=probability[level - 2][speaks], minlength=len(keys))
            for b, part in enumerate(_by_bucket(keys, buckets)):
                if len(part):
                    put(
                        1, kind=["mass"], chunk=[number], bucket=[b], keys=[pack(keys[part], rising=True)],
                        seen=[pack(seen[part])], lower=[pack(beneath[part])], times=[pack(top[part].astype(np.int64))],
                    )
        for level in range(settings.order, 1, -1):
            place, context = chunk.place[level - 1], chunk.context(level)
            p = probability[level - 1]
            hit = open_ & (p > 0)
            score[hit] = np.log10(p[hit])
            open_ &= ~hit
            name = np.where(context >= 0, chunk.keys[level - 2][context], np.uint64(START))
            known = np.where(context >= 0, counts[level - 2][context], texts) > 0
            asks = open_ & (place >= 0) & known
            needed.append((name[asks], document[asks]))
        score[open_] = np.log10(lower[open_])
        name = np.concatenate([n for n, _ in needed]) if needed else np.zeros(0, np.uint64)
        doc = np.concatenate([d for _, d in needed]) if needed else np.zeros(0, np.int64)
        order = np.lexsort((doc, name))
        name, doc = name[order], doc[order]
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(name)))
        name, doc = name[at], doc[at]
        for b, part in enumerate(_by_bucket(name, buckets)):
            if len(part):
                put(
                    1, kind=["need"], chunk=[number], bucket=[b], keys=[pack(name[part], rising=True)],
                    doc=[pack(doc[part])], times=[pack(times[part])],
                )
        n = len(ids)
        put(
            n, kind=["text"] * n, chunk=[number] * n, spot=range(n), doc_id=ids, n_tokens=chunk.sizes.tolist(),
            n_known=np.bincount(document, weights=one > 0, minlength=n).astype(np.int64).tolist(),
            base_score=np.bincount(document, weights=base, minlength=n).tolist(),
            partial=np.bincount(document, weights=score, minlength=n).tolist(),
        )
        return pa.table({f.name: pa.array(rows[f.name], f.type) for f in _EVALUATED})

    return run


WEIGHED = "kind string, bucket int, keys binary, weights binary, chunk bigint, docs array<bigint>, deltas array<double>"


def _weigh(settings: Settings):
    """Backoff weights of one bucket of contexts, and what they add to the texts that need them."""

    def run(key, table):
        return _weighed(key, table, settings.tables)

    return run


def _weighed(key, table, tables: bool):
    kinds = table["kind"].to_pylist()
    mass = [k for k, kind in enumerate(kinds) if kind == "mass"]
    keys, inverse = np.unique(
        np.concatenate([unpack(table["keys"][k].as_py(), rising=True) for k in mass] or [np.zeros(0, np.uint64)]),
        return_inverse=True,
    )
    inverse = inverse.reshape(-1)

    def sums(column):
        parts = [unpack(table[column][k].as_py()) for k in mass]
        return np.bincount(inverse, weights=np.concatenate(parts) if parts else None, minlength=len(keys))

    seen, lower = sums("seen"), sums("lower")
    total = np.zeros(len(keys))
    if mass:
        total[inverse] = np.concatenate([unpack(table["times"][k].as_py(), kind=np.float64) for k in mass])
    weights = np.log10((total - seen) / total) - np.log10(1 - lower)
    rows = [("contexts", key[0].as_py(), pack(keys, rising=True), pack(weights), None, None, None)] if tables else []
    for k, kind in enumerate(kinds):
        if kind != "need":
            continue
        asked = unpack(table["keys"][k].as_py(), rising=True)
        docs, times = unpack(table["doc"][k].as_py(), kind=np.int64), unpack(table["times"][k].as_py(), kind=np.float64)
        at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
        weight = np.where(keys[at] == asked, weights[at], 0.0) if len(keys) else np.zeros(len(asked))
        distinct, inverse = np.unique(docs, return_inverse=True)
        deltas = np.bincount(inverse.reshape(-1), weights=weight * times, minlength=len(distinct))
        rows.append(("delta", key[0].as_py(), None, None, table["chunk"][k].as_py(), distinct.tolist(), deltas.tolist()))
    types = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
    names = ["kind", "bucket", "keys", "weights", "chunk", "docs", "deltas"]
    return pa.table({c: pa.array([r[k] for r in rows], types[k]) for k, c in enumerate(names)})


@dataclass
class Katz:
    """A trained model with the scores of its texts. With ``Settings.tables``, and else None:

    ``counts``: one row for each level and bucket with the sorted keys and counts of its n-grams. ``contexts``: the keys and
    log10 backoff weights of the contexts. Keys are 64-bit names of token sequences.
    """

    counts: DataFrame | None
    contexts: DataFrame | None
    discounts: list[Discounts]
    scores: DataFrame


def katz(docs: DataFrame, settings: Settings | None = None) -> Katz:
    """Learn from ``docs`` (doc_id, text) but for those held out, and score all of them.

    A text's tokens are its words with A-Z lowered and one end; its first token's context is the text's
    start. Scores: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null texts are empty; rows
    without doc_id count as the empty id and are held out; repeated rows count as often as they stand.
    Without any training text every token is unknown with probability 1. An empty table gives no scores.
    """
    settings = settings or Settings()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = stored(source.mapInArrow(_chunks(settings), CHUNK), "katz-chunks")
    tokens = chunks.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    learnt = bucket_of(F.col("id"), settings.held) != 0
    texts = chunks.select(F.explode("ids").alias("id")).where(learnt).count()
    buckets = max(4, -(-tokens // (2 * settings.bucket_keys)))

    # level by level, so that the keys of one level only are on their way at once
    by_level = []
    for level in range(1, settings.order + 1):
        requests = chunks.mapInArrow(_requests(settings, buckets, level), REQUEST)
        by_level.append(stored(requests.groupBy("bucket", "level").applyInArrow(_count(settings), COUNTED), "katz-counts", "kind"))
        release(docs.sparkSession)
    counted = reduce(DataFrame.unionByName, by_level)
    table = counted.where("kind = 'table'")
    sums = [F.sum(F.col("found")[k]).alias(f"n{k}") for k in range(settings.cutoff + 3)]
    totals = {r["level"]: [r[f"n{k}"] for k in range(settings.cutoff + 3)] for r in table.groupBy("level").agg(*sums).collect()}
    discounts = []
    for level in range(1, settings.order + 1):
        *found, total, types = totals.get(level, [0] * (settings.cutoff + 3))
        discounts.append(Discounts(good_turing(found, settings.cutoff), total, types))
    unigrams = Unigrams.of(discounts[0], totals.get(1, [0] * (settings.cutoff + 3))[: settings.cutoff + 1])

    answers = counted.where("kind = 'answer'").select("chunk", "level", "bucket", "counts", "owned", "marked")
    evaluate = _evaluate(settings, buckets, discounts, unigrams, texts)
    evaluated = stored(
        chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(evaluate, EVALUATED), "katz-texts", "kind"
    )
    release(docs.sparkSession, chunks, *([] if settings.tables else by_level))
    sums = evaluated.where("kind IN ('mass', 'need')").select("kind", "chunk", "bucket", "keys", "seen", "lower", "doc", "times")
    weighed = stored(sums.groupBy("bucket").applyInArrow(_weigh(settings), WEIGHED), "katz-weights", "kind")
    release(docs.sparkSession)
    deltas = (
        weighed.where("kind = 'delta'")
        .select("chunk", F.explode(F.arrays_zip("docs", "deltas")).alias("d"))
        .groupBy("chunk", F.col("d.docs").alias("spot"))
        .agg(F.sum("d.deltas").alias("delta"))
    )
    scores = (
        evaluated.where("kind = 'text'")
        .join(deltas, ["chunk", "spot"], "left")
        .select(
            "doc_id",
            (bucket_of(F.col("doc_id"), settings.held) == 0).alias("held_out"),
            "n_tokens",
            "n_known",
            F.lit(discounts[0].tokens).cast("long").alias("train_tokens"),
            "base_score",
            (F.col("partial") + F.coalesce("delta", F.lit(0.0))).alias("score"),
        )
    )
    if not settings.tables:
        return Katz(None, None, discounts, scores)
    contexts = weighed.where("kind = 'contexts'").select("bucket", "keys", "weights")
    return Katz(table.drop("kind", "chunk", "owned", "marked"), contexts, discounts, scores)
