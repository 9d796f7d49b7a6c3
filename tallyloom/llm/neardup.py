"""Near duplicates by MinHash with tensored banding, confirmed on whole shingle sets.

Two small collections of half keys A_1..A_m and B_1..B_m take 2 * m * r minhashes; each of the
m * m tables has the pair (A_i, B_j) as its key, so m * m tables cost the minhashes of 2 * m half
bands. Rows are shuffled by A_i and matched on B_j within the task: a text is sent m times and not m * m.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fresh, stored
from tallyloom.llm.components import components
from tallyloom.llm.words import join_names, mix, slices, words_of

# Bytes of text whose shingles a task holds at once; a longer text stands alone.
_PIECE = 1 << 20


@dataclass(frozen=True)
class Banding:
    """Shingle length, similarity in percent, minhashes of a half key, and half keys of a collection.

    A pair at the threshold s misses every table with a chance of about 2 * (1 - s^rows)^halves:
    0.00002 at 0.8 with 3 and 16, and at 0.85 with 3 and 12.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 3
    halves: int = 16
    block: int = 256

    @property
    def hashes(self) -> int:
        return 2 * self.rows * self.halves

    @property
    def least_equal(self) -> int:
        """Minhashes that a pair at the threshold has in common, less 5.5 standard deviations."""
        s = self.percent / 100
        return int(self.hashes * s - 5.5 * (self.hashes * s * (1 - s)) ** 0.5)


def shingle_sets(column: pa.Array, length: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle names of each text; a shorter text is one shingle."""
    for begin, end in slices(_PIECE, column):
        words = words_of(column.slice(begin, end - begin), lower=True)
        name, first = words.name, words.first
        n = len(name) - length + 1
        grams = join_names(*[name[k : n + k] for k in range(length)]) if n > 0 else name[:0]
        for d in range(end - begin):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= length:
                yield np.unique(grams[a : b - length + 1])
            elif b > a:
                yield join_names(*[name[k : k + 1] for k in range(a, b)], np.array([b - a], dtype=np.uint64))
            else:
                yield name[:0]


def _minhashes(names: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(names), 4096):
        part = names[at : at + 4096]
        np.minimum(least, (factors[:, None] * part[None, :]).min(axis=1), out=least)
    return least


FEATURES = "doc_id bigint, text_name bigint, n_shingles bigint, signature binary, heads array<bigint>, tails array<bigint>, code binary"


def _features(banding: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = mix(np.arange(1, banding.hashes + 1, dtype=np.uint64)) | np.uint64(1)
        m, r = banding.halves, banding.rows
        salt = mix(np.arange(1000, 1000 + 2 * m, dtype=np.uint64))
        for batch in batches:
            sizes, signatures, heads, tails, codes = [], [], [], [], []
            for names in shingle_sets(batch.column(1), banding.shingle):
                sizes.append(len(names))
                if not len(names):
                    signatures.append(None)
                    heads.append([])
                    tails.append([])
                    codes.append(None)
                    continue
                least = _minhashes(names, factors).reshape(2 * m, r)
                half = join_names(salt, *[least[:, k] for k in range(r)])
                signatures.append(_signature(names))
                heads.append(half[:m].view(np.int64))
                tails.append(half[m:].view(np.int64))
                codes.append(half.tobytes() + (mix(least.reshape(-1)) & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(heads, pa.list_(pa.int64())),
                    pa.array(tails, pa.list_(pa.int64())),
                    pa.array(codes, pa.binary()),
                ],
                names=["doc_id", "text_name", "n_shingles", "signature", "heads", "tails", "code"],
            )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Whole groups of rows with equal leading ``keys`` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []

    def values(batch, row):
        return tuple(batch.column(k)[row].as_py() for k in range(keys))

    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, dtype=bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= column[1:] != column[:-1]
        changed[0] = bool(held) and values(held[-1], held[-1].num_rows - 1) != values(batch, 0)
        cuts = np.flatnonzero(changed).tolist()
        at = 0
        for cut in cuts:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]


# Instead of the place of a second half key: rows come under all of their first half keys, or under one alone.
EACH, ALONE = -1, -2
# A row in a block of a hot key: of the key's largest component, which each have one block; another row in the one block where its
# pairs with later such rows are looked at; or another row elsewhere.
MAIN, HOME, VISITOR = 2, 1, 0


@dataclass
class _Block:
    """The rows of one block of one half key; ``turn`` is the place of the second half key if all rows share it, else EACH or
    ALONE."""

    rep: np.ndarray
    comp: np.ndarray
    size: np.ndarray
    half: np.ndarray
    sketch: np.ndarray
    place: np.ndarray
    own: np.ndarray
    turn: int

    @classmethod
    def of(cls, group: pa.RecordBatch, m: int) -> _Block:
        place, rep, comp, size, own = (group.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5, 6, 8))
        code = np.frombuffer(b"".join(group.column(7).to_pylist()), dtype=np.uint8).reshape(len(rep), -1)
        half = np.ascontiguousarray(code[:, : 16 * m]).view(np.uint64)
        return cls(rep, comp, size, half, code[:, 16 * m :], place, own, group.column(1)[0].as_py())

    def candidates(self, banding: Banding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of rows of different components, each in the first A_i that it shares (but for ALONE; and, in a block of one B_j, the first of
        these) and only if it shares a B_j, whose sizes and minhashes allow the similarity; with the number of equal minhashes. Rows that are
        in several blocks are a pair in one of them."""
        m, rep, comp, size = banding.halves, self.rep, self.comp, self.size
        out = []
        for at in range(0, len(rep), 64):
            rows = slice(at, at + 64)
            ok = (comp[rows, None] != comp[None, :]) & (rep[rows, None] < rep[None, :])
            ok &= (self.own[rows, None] != VISITOR) | (self.own[None, :] == MAIN)
            a, b = size[rows, None], size[None, :]
            ok &= 100 * np.minimum(a, b) >= banding.percent * np.maximum(a, b)
            i, j = np.nonzero(ok)
            i = i + at
            heads = self.half[i, :m] == self.half[j, :m]
            tails = self.half[i, m:] == self.half[j, m:]
            good = heads[np.arange(len(i)), self.place[i]] & tails.any(axis=1)
            if self.turn != ALONE:
                good &= heads.argmax(axis=1) == self.place[i]
            if self.turn >= 0:
                good &= tails.argmax(axis=1) == self.turn
            i, j = i[good], j[good]
            equal = (self.sketch[i] == self.sketch[j]).sum(axis=1)
            good = equal >= banding.least_equal
            out.append((i[good], j[good], equal[good]))
        return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def _pair_batch(x: list[np.ndarray], y: list[np.ndarray], equal: list[np.ndarray]) -> pa.RecordBatch:
    columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in (x, y, equal)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["x", "y", "equal"])


def _best_pairs(banding: Banding):
    """The likeliest partner in another component of each row of a block, and of rows under one key alone also the first: at most two
    pairs a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, score, held = [], [], [], 0
        for group in _groups(batches, 3):
            if group.num_rows < 2:
                continue
            block = _Block.of(group, banding.halves)
            i, j, equal = block.candidates(banding)
            one, two, both = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([equal, equal])
            orders = [np.lexsort((block.rep[two], -both, block.rep[one]))]
            if block.turn == ALONE:
                # the first of a key is in all of its blocks
                orders.append(np.lexsort((block.rep[two], block.rep[one])))
            for order in orders:
                new = np.ones(len(order), dtype=bool)
                new[1:] = block.rep[one[order[1:]]] != block.rep[one[order[:-1]]]
                x.append(block.rep[one[order]][new])
                y.append(block.rep[two[order]][new])
                score.append(both[order][new])
                held += len(x[-1])
            if held > 50_000:
                yield _pair_batch(x, y, score)
                x, y, score, held = [], [], [], 0
        yield _pair_batch(x, y, score)

    return run


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (i, j): through products of 0/1 matrices if pairs are many."""
    left, one = np.unique(i, return_inverse=True)
    right, two = np.unique(j, return_inverse=True)
    if len(i) < 4 * (len(left) + len(right)):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)])
    sets = [sets[k] for k in [*left, *right]]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    names, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count[column] > 1
    owner, column = owner[several], column[several]
    renumber = np.cumsum(count > 1) - 1
    column = renumber[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int((count > 1).sum()), 8192):
        a, b = np.searchsorted(column, [at, at + 8192])
        part = np.zeros((len(sets), 8192), dtype=np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        total += part[: len(left)] @ part[len(left) :].T
    return total[one, two].astype(np.int64)


def _spanning_links(banding: Banding):
    """Links between components in a block, all its candidate pairs held against whole sets; links that join
    what earlier ones have joined are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            if group.num_rows < 2:
                continue
            block = _Block.of(group, banding.halves)
            i, j, _ = block.candidates(banding)
            if not len(i):
                continue
            sets = [_unpack(s.as_py()) for s in group.column(9)]
            both = _common(sets, i, j)
            good = 100 * both >= banding.percent * (block.size[i] + block.size[j] - both)
            above: dict[int, int] = {}

            def top(c: int) -> int:
                while c in above:
                    c = above[c]
                return c

            links = []
            for a, b in zip(i[good].tolist(), j[good].tolist(), strict=True):
                p, q = top(int(block.comp[a])), top(int(block.comp[b]))
                if p != q:
                    above[max(p, q)] = min(p, q)
                    links.append((int(block.rep[a]), int(block.rep[b])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in links], pa.int64()), pa.array([k[1] for k in links], pa.int64())], names=["x", "y"]
            )

    return run


def _candidate_rows(banding: Banding):
    """The rows of each block that are in any candidate pair there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            if group.num_rows > 1:
                block = _Block.of(group, banding.halves)
                i, j, _ = block.candidates(banding)
                rows = pa.array(np.unique(np.concatenate([i, j])), pa.int64())
                yield pa.RecordBatch.from_arrays([group.column(k).take(rows) for k in (0, 1, 2, 4)], names=_SPOT)

    return run


def _signature(names: np.ndarray) -> bytes:
    return hashlib.blake2b(names.tobytes(), digest_size=16).digest()


def _set_rows(banding: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in slices(_PIECE, whole.column(1)):
                batch = whole.slice(begin, end - begin)
                sets = list(shingle_sets(batch.column(1), banding.shingle))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).cast(pa.int64()),
                        pa.array([_signature(names) for names in sets], pa.binary()),
                        pa.array([names.tobytes() for names in sets], pa.binary()),
                    ],
                    names=["doc_id", "signature", "names"],
                )

    return run


def _with_sets(
    sets: DataFrame | None, rows: DataFrame, leaders: DataFrame, source: DataFrame, banding: Banding
) -> DataFrame:
    """(rep, names): the whole shingle sets of these rows, beside those at hand."""
    needed = rows.select("rep").distinct()
    if sets is not None:
        needed = needed.join(sets.select("rep"), "rep", "left_anti")
    needed = stored(leaders.join(needed, "rep", "left_semi").select("rep", "doc_id", "signature"), "needed")
    texts = source.join(needed.select("doc_id").distinct(), "doc_id", "left_semi")
    made = texts.mapInArrow(_set_rows(banding), "doc_id bigint, signature binary, names binary")
    more = made.join(needed, ["doc_id", "signature"]).select("rep", "names").dropDuplicates(["rep"])
    more = stored(more, "sets")
    return more if sets is None else sets.unionByName(more)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint64)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                a, b = _unpack(one.as_py()), _unpack(two.as_py())
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["x", "y", "linked"]
            )

    return run


# Blocks of rows outside its largest component that a key may have to be dealt whole.
OTHERS = 4
# Rounds by the commonest key of each row, which join most copies before all keys are looked at.
LEADER_TURNS = 2
_ROW = ["place", "rep", "comp", "n_shingles", "code"]
_SPOT = ["head", "turn", "part", "rep"]


def _shared(spots: DataFrame, comps: DataFrame) -> DataFrame:
    """(head, place, rep, comp, members, leader): the rows of each half key that several components share, with their number and
    the smallest of them."""
    placed = spots.select("rep", "place", "head").join(comps, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    groups = (
        placed.groupBy("head")
        .agg(
            F.count(F.lit(1)).alias("members"), F.min("comp").alias("least"), F.max("comp").alias("most"),
            F.min("rep").alias("leader"),
        )
        .where("members > 1 AND least <> most")
        .select("head", "members", "leader")
    )
    return placed.join(groups, "head")


def _coded(placed: DataFrame, leaders: DataFrame) -> DataFrame:
    return placed.join(leaders.select("rep", "n_shingles", "tails", "code"), "rep")


def _dealt(rows: DataFrame) -> DataFrame:
    key = ["head", "turn", "part"]
    return rows.repartition(*key).sortWithinPartitions(*key)


def _with_leaders(placed: DataFrame, banding: Banding, turn: int) -> DataFrame:
    """Every row in one block of its key, another in another turn, and the key's leader in all of them, so that blocks are joined
    through it."""
    blocks = F.ceil(F.col("members") / banding.block)
    own = F.array(F.pmod(F.xxhash64("rep", F.lit(turn)), blocks))
    parts = F.when(F.col("rep") == F.col("leader"), F.sequence(F.lit(0).cast("bigint"), blocks - 1)).otherwise(own)
    return _dealt(placed.select("head", F.lit(ALONE).alias("turn"), F.explode(parts).alias("part"), *_ROW, F.lit(HOME).alias("own")))


def _one_block(placed: DataFrame) -> DataFrame:
    whole = [F.lit(EACH).alias("turn"), F.lit(0).cast("bigint").alias("part")]
    return _dealt(placed.select("head", *whole, *_ROW, F.lit(HOME).alias("own")))


def _all_pairs(placed: DataFrame, leaders: DataFrame, banding: Banding) -> tuple[DataFrame, DataFrame | None]:
    """Blocks in which any two rows of different components that share a table of keys meet: those of keys of one block, and others, if any.

    Most rows of a hot key are of one component by now; each of these goes to one block, and the few others to every
    block. A key with many others is first dealt to its second half keys, as only rows that share one are candidates; that sends each of its
    rows as often as there are half keys, or more, so keys of no more blocks than that are left whole, up to ``OTHERS`` blocks of others.
    """
    placed = placed.drop("leader")
    hot = placed.where(F.col("members") > banding.block)
    whole = [F.lit(EACH).alias("turn"), F.lit(0).cast("bigint").alias("part")]
    cold = _coded(placed.where(F.col("members") <= banding.block), leaders)
    cold = cold.select("head", *whole, *_ROW, F.lit(HOME).alias("own"))
    if hot.isEmpty():
        return cold, None
    starred = stored(_with_main(hot.drop("members"), ["head"]), "hot-keys")
    others = F.col("members") - F.col("main_rows")
    few = (others <= banding.block) | (F.col("members") <= banding.block * banding.halves) & (others <= banding.block * OTHERS)
    rows = _in_parts(_coded(starred.where(few), leaders), F.col("head"), F.lit(EACH), banding)
    many = starred.where(~few).drop("members", "main", "main_rows")
    if not many.isEmpty():
        tables = _coded(many, leaders).select("*", F.posexplode("tails").alias("turn", "tail")).drop("tails")
        tables = _with_main(tables, ["head", "turn", "tail"])
        # a table is known by its half keys
        rows = rows.unionByName(_in_parts(tables, F.xxhash64("head", "tail"), F.col("turn"), banding))
    return cold, rows


def _with_main(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of keys that several components share, with the number of rows and the largest component of their key."""
    sizes = rows.groupBy(*key, "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy(*key).agg(
        F.sum("n").alias("members"), F.max_by("comp", "n").alias("main"), F.max("n").alias("main_rows"),
        F.count(F.lit(1)).alias("comps"),
    )
    return rows.join(sizes.where("comps > 1").drop("comps"), key)


def _in_parts(rows: DataFrame, key: Column, turn: Column, banding: Banding) -> DataFrame:
    """The rows of ``_with_main`` in their blocks."""
    blocks = F.ceil(F.col("members") / banding.block)
    home, main = F.pmod(F.xxhash64("rep"), blocks), F.col("comp") == F.col("main")
    parts = F.when(main, F.array(home)).otherwise(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    own = F.when(main, MAIN).when(F.col("part") == home, HOME).otherwise(VISITOR)
    dealt = rows.withColumn("part", F.explode(parts)).withColumn("own", own)
    return dealt.select(key.alias("head"), turn.alias("turn"), "part", *_ROW, "own")


def _classes(known: DataFrame) -> DataFrame:
    """(signature, least, rep): the texts of equal shingle sets with their smallest doc_id, and a number of their own: that doc_id, or
    a negative one where a doc_id is the smallest of several texts."""
    classes = known.groupBy("signature").agg(F.min("doc_id").alias("least"))
    first = classes.groupBy("least").agg(F.min("signature").alias("first"))
    other = F.lit(-(1 << 62)) - F.xxhash64("signature").bitwiseAND(F.lit((1 << 62) - 1))
    rep = F.when(F.col("signature") == F.col("first"), F.col("least")).otherwise(other)
    return classes.join(first, "least").select("signature", "least", rep.alias("rep"))


def near_duplicates(docs: DataFrame, banding: Banding | None = None) -> DataFrame:
    """``grouped`` without the names of the texts."""
    return grouped(docs, banding).drop("text_name")


def unique_documents(docs: DataFrame, banding: Banding | None = None) -> DataFrame:
    """The rows of ``docs`` that ``grouped`` keeps, with all their columns; of rows that repeat doc_id and text one.

    Decisions are taken for doc_id and text together, so a text whose doc_id another text has too does not go with it.
    """
    rows = grouped(docs, banding)
    doc, name, found = fresh(docs.columns, "doc", "name", "found")
    named = [F.col("doc_id").alias(doc), F.col("text_name").alias(name)]
    gone = stored(rows.where(~F.col("kept")).select(*named).distinct(), "copies")
    twice = rows.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy(*named).agg(F.count(F.lit(1)).alias(found))
    twice = stored(twice.where(F.col(found) > 1).select(doc, name, F.lit(True).alias(found)), "repeated")

    def same(other: DataFrame):
        return (F.col("doc_id").cast("long") == other[doc]) & (F.xxhash64(F.col("text").cast("string")) == other[name])

    left = docs.join(gone, same(gone), "left_anti")
    if twice.isEmpty():
        return left
    marked = left.join(twice, same(twice), "left")
    once = marked.where(found).dropDuplicates([doc, name])
    return marked.where(F.col(found).isNull()).unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])


def grouped(docs: DataFrame, banding: Banding | None = None) -> DataFrame:
    """doc_id, text_name (a 64-bit name of the text), n_shingles, component_id and kept for every row of ``docs`` (doc_id, text;
    others are ignored).

    Rows of equal shingle sets are one class. Classes are linked if the
    intersection of their sets has at least ``percent`` of the union. ``component_id`` is the smallest
    doc_id reachable. First each class is held against the first and the likeliest partner in a block of its commonest key, where the
    key's first class also is, so that most copies are joined by a pair or two a row; then against its likeliest partner in all keys of one
    block; then all candidate pairs between components that are left are held against each other, block by block. Pairs inside a component
    need no check, and none between components is left out.

    Null, empty and word-free texts have 0 shingles, are linked with nothing and stay; so do
    rows without a doc_id, whose component is null. doc_id is an integer. Rows that repeat a doc_id follow their own text. An empty
    table gives an empty result.
    """
    banding = banding or Banding()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = source.select("*", F.xxhash64("text").alias("text_name"))
    features = stored(named.mapInArrow(_features(banding), FEATURES), "minhash")
    known = features.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(_classes(known), "classes")
    leaders = known.join(classes.withColumnRenamed("least", "doc_id"), ["signature", "doc_id"]).dropDuplicates(["rep"])
    leaders = stored(leaders.select("rep", "doc_id", "signature", "n_shingles", "heads", "tails", "code"), "leaders")

    heads = leaders.select("rep", F.posexplode("heads").alias("place", "head"))
    counts = heads.groupBy("head").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    spots = stored(heads.join(counts, "head"), "spots")

    comps = leaders.select("rep", F.col("rep").alias("comp")).limit(0)
    links = tested = sets = None
    for turn in range(LEADER_TURNS + 1):
        if turn == LEADER_TURNS:
            # all keys of one block that components still share: the likeliest partner of each row
            placed = _shared(spots, comps).where(F.col("members") <= banding.block)
            dealt = _one_block(_coded(placed, leaders))
        else:
            # the commonest key of each row alone, which joins most copies
            commonest = spots.groupBy("rep").agg(F.max_by(F.struct("place", "head"), "members").alias("at"))
            dealt = _with_leaders(_coded(_shared(commonest.select("rep", "at.*"), comps), leaders), banding, turn)
        found = dealt.mapInArrow(_best_pairs(banding), "x bigint, y bigint, equal bigint")
        if turn == LEADER_TURNS:
            best = F.max(F.struct("equal", (-F.col("y")).alias("y"))).alias("best")
            found = found.groupBy("x").agg(best).select("x", (-F.col("best.y")).alias("y"))
        pairs = found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        pairs = stored(pairs if tested is None else pairs.join(tested, ["x", "y"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        sets = _with_sets(sets, pairs.select(F.explode(F.array("x", "y")).alias("rep")), leaders, source, banding)
        one = sets.select(F.col("rep").alias("x"), F.col("names").alias("names_x"))
        two = sets.select(F.col("rep").alias("y"), F.col("names").alias("names_y"))
        joined = pairs.join(one, "x").join(two, "y").select("x", "y", "names_x", "names_y")
        checked = stored(
            joined.mapInArrow(_confirm(banding.percent), "x bigint, y bigint, linked boolean"), "checked"
        )
        tested = checked.select("x", "y") if tested is None else tested.unionByName(checked.select("x", "y"))
        new = checked.where("linked").select("x", "y")
        links = new if links is None else links.unionByName(new)
        comps = components(links).select(F.col("node").alias("rep"), F.col("root").alias("comp"))
    # in a key of one block the second turn has seen every pair: rows without a set have no partner there
    cold, others = _all_pairs(stored(_shared(spots, comps), "placed"), leaders, banding)
    rows = None if sets is None else cold.join(sets, "rep")
    if others is not None:
        others = stored(others, "hot-rows")
        schema = "head bigint, turn int, part bigint, rep bigint"
        likely = stored(_dealt(others).mapInArrow(_candidate_rows(banding), schema), "likely")
        sets = _with_sets(sets, likely, leaders, source, banding)
        more = others.join(likely, _SPOT, "left_semi").join(sets, "rep")
        rows = more if rows is None else rows.unionByName(more.select(*rows.columns))
    if rows is not None:
        rows = _dealt(rows.select("head", "turn", "part", *_ROW, "own", "names"))
        new = stored(rows.mapInArrow(_spanning_links(banding), "x bigint, y bigint"), "links")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            comps = components(links).select(F.col("node").alias("rep"), F.col("root").alias("comp"))
    # a component is called by its smallest doc_id
    names = comps.join(classes.select("rep", "least"), "rep").groupBy("comp").agg(F.min("least").alias("named"))
    component = F.coalesce("named", "least", "doc_id")
    has_id = F.col("doc_id").isNotNull()
    return (
        features.select("doc_id", "text_name", "n_shingles", "signature")
        .join(classes, "signature", "left")
        .join(comps.join(names, "comp"), "rep", "left")
        .select(
            "doc_id",
            "text_name",
            "n_shingles",
            F.when(has_id, component).alias("component_id"),
            F.coalesce(has_id & (F.col("doc_id") == component) | ~has_id, F.lit(True)).alias("kept"),
        )
    )
