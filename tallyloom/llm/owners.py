"""Exact duplicates by Patricia tries: of equal texts one row, the owner, stays.

Texts are dealt by their length and content hash. Each task inserts their full byte strings into a compressed radix
trie, one subtree per length and hash; an end node counts its text's rows and remembers the best of them. Rows arrive in
the order of length and hash, so a subtree is complete when the next begins: it then leaves the memory as rows.

A text that has more than its share of all rows or bytes is dealt to several tasks, whose end nodes meet in a second trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

# A text with more than one row (byte) in so many is hot; there are at most twice as many hot texts, and a hot text has at
# most so many parts.
SHARE = 1000

_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_INNER = bytes(range(0x80, 0xC0))


def normalised(text: bytes) -> bytes:
    return text.translate(None, _SPACES)


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    """A stretch of bytes, what may follow it by its first byte, and the text that ends here, if any."""

    __slots__ = ("edge", "next", "end")

    def __init__(self, edge: bytes):
        self.edge: bytes = edge
        self.next: dict[int, Node] = {}
        self.end: End | None = None


class End:
    """All rows of one text: (doc, part) of each, their number, and the best."""

    __slots__ = ("name", "rows", "count", "best", "place", "text")

    def __init__(self, name: bytes):
        self.name, self.rows, self.count, self.best, self.place, self.text = name, [], 0, None, 0, None

    def add(self, doc: int | None, points: int, count: int, part: int, text: bytes) -> None:
        """A row, or ``count`` rows for which one stands. Best has most code points, then the smallest doc_id (null last)."""
        rank = (-points, doc is None, doc or 0, part)
        if self.best is None or rank < self.best:
            self.best, self.place, self.text = rank, len(self.rows), text
        self.rows.append((doc, part))
        self.count += count

    def owner(self) -> int | None:
        return self.rows[self.place][0]


class Trie:
    """A Patricia trie over byte strings."""

    def __init__(self):
        self.root = Node(b"")

    def end_of(self, key: bytes) -> Node:
        """The node where ``key`` ends; every byte of the key has been compared or stored."""
        node, at = self.root, 0
        while at < len(key):
            child = node.next.get(key[at])
            if child is None:
                child = node.next[key[at]] = Node(key[at:])
            elif not key.startswith(child.edge, at):
                shared = common_length(child.edge, key[at : at + len(child.edge)])
                upper = Node(child.edge[:shared])
                child.edge = child.edge[shared:]
                upper.next[child.edge[0]] = child
                child = node.next[key[at]] = upper
            node, at = child, at + len(child.edge)
        return node

    def ends(self) -> Iterator[End]:
        """The ends of all texts, in byte order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.end is not None:
                yield node.end
            stack.extend(node.next[b] for b in sorted(node.next, reverse=True))


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py() or b""


def _key(text: bytes) -> tuple[int, int]:
    """Length and content hash of a normalised text."""
    return len(text), int.from_bytes(hashlib.sha256(text).digest()[:8], "big", signed=True)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [_key(normalised(text)) for text in _bytes(batch.column(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.int64()) for i in range(2)], names=["length", "hash"]
        )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their key and a running number, which deals the rows of a hot text to its parts."""
    turn = TaskContext.get().partitionId()
    for batch in batches:
        keys = [_key(normalised(text)) for text in _bytes(batch.column(1))]
        turns = pa.array(range(turn, turn + len(keys)), pa.int64())
        turn += len(keys)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array([k[i] for k in keys], pa.int64()) for i in range(2)], turns],
            names=["doc", "text", "length", "hash", "turn"],
        )


_CLOSED = {
    "doc": pa.int64(), "keep": pa.int64(), "size": pa.int64(), "best": pa.bool_(), "name": pa.binary(), "hot": pa.bool_(),
    "part": pa.int64(), "text": pa.large_binary(),
}
_CLOSED_SQL = "doc bigint, keep bigint, size bigint, best boolean, name binary, hot boolean, part bigint, text binary"
_BATCH_ROWS, _BATCH_BYTES = 10_000, 1 << 24


def _through_tries(with_text: bool, merge: bool):
    """Rows in the order of (length, hash, part) to rows with their owner.

    ``merge``: each row stands for ``size`` rows of a part; only the best rows come out, with the text's whole size.
    """

    def close(trie: Trie, hot: bool) -> Iterator[tuple]:
        names = set()
        for end in trie.ends():
            if end.name in names:
                raise ValueError(f"two texts share the SHA-256 {end.name.hex()}")
            names.add(end.name)
            for place, (doc, part) in enumerate(end.rows):
                best = place == end.place
                if merge and not best:
                    continue
                text = end.text if best and (with_text or hot) else None
                yield doc, end.owner(), end.count, best, end.name, hot and not merge, part, text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, now, hot, out, held = Trie(), None, False, [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(_CLOSED.values())], list(_CLOSED)
            )

        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("doc", "length", "hash", "part", "hot", "size")}
            for i, text in enumerate(_bytes(batch.column("text"))):
                doc, length, code, part, is_hot, size = (columns[c][i] for c in columns)
                key = (length, code) if merge else (length, code, part)
                if key != now:
                    for row in close(trie, hot):
                        out.append(row)
                        held += len(row[-1] or b"") + 100
                        if len(out) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                            yield batch_of(out)
                            out, held = [], 0
                    trie, now, hot = Trie(), key, is_hot
                plain = normalised(text)
                node = trie.end_of(plain)
                if node.end is None:
                    node.end = End(hashlib.sha256(plain).digest())
                node.end.add(doc, len(text.translate(None, _INNER)), size, part, text)
        for row in close(trie, hot):
            out.append(row)
        yield batch_of(out)

    return run


def _hot_keys(texts: DataFrame) -> DataFrame:
    """(length, hash, parts) of the texts that have more than one row or byte in SHARE: at most 2 * SHARE rows."""
    keys = texts.mapInArrow(_keys, "length bigint, hash bigint").groupBy("length", "hash").agg(F.count(F.lit(1)).alias("n"))
    seen = Observation()
    sums = [F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("length")).alias("bytes")]
    repeated = stored(keys.observe(seen, *sums).where("n > 1"), "text-keys")
    rows, size = (max(seen.get[c] or 0, 1) for c in ("rows", "bytes"))
    share = F.greatest(F.col("n") / rows, F.col("n") * F.col("length") / size) * SHARE
    parts = F.least(F.ceil(share), F.lit(SHARE)).cast("bigint")
    return repeated.where(share > 1).select("length", "hash", parts.alias("parts"))


def owners(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256; ``with_text`` adds the text that stays,
    null on other rows.

    Texts are equal when they are identical without spaces and characters 0x09-0x0D. The row with the most code points
    before that stays, then the smallest doc_id (null last), then any one of rows that repeat both. text_sha256 names
    the text without spaces. ``docs`` has doc_id (an integer) and text; other columns are not read, whatever
    their names. Null texts are empty and equal to texts of spaces. No documents give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("string").alias("text"))
    hot = _hot_keys(rows.select("text"))
    keyed = rows.mapInArrow(_keyed, "doc bigint, text string, length bigint, hash bigint, turn bigint")
    # at most 2 * SHARE rows of three numbers
    dealt = keyed.join(F.broadcast(hot), ["length", "hash"], "left").select(
        "doc", "length", "hash", F.coalesce(F.col("turn") % F.col("parts"), F.lit(0)).alias("part"),
        F.col("parts").isNotNull().alias("hot"), F.lit(1).cast("bigint").alias("size"), "text",
    )
    key = ["length", "hash", "part"]
    closed = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_through_tries(with_text, False), _CLOSED_SQL)
    closed = stored(closed, "text-owners")
    return _report(closed, _merged(closed), with_text)


def _merged(closed: DataFrame) -> DataFrame:
    """Owner, size and winning part of each hot text, from the best row of each of its parts."""
    heads = closed.where("hot AND best").select(
        "doc", F.lit(0).cast("bigint").alias("length"), F.xxhash64("name").alias("hash"), "part", "hot", "size",
        F.col("text").cast("string").alias("text"),
    )
    dealt = heads.repartition("hash").sortWithinPartitions("hash", "part")
    merged = dealt.mapInArrow(_through_tries(False, True), _CLOSED_SQL)
    return stored(merged.select("name", *[F.col(c).alias(f"hot_{c}") for c in ("keep", "size", "part")]), "hot-owners")


def _report(closed: DataFrame, merged: DataFrame, with_text: bool) -> DataFrame:
    # one row per hot text: at most 2 * SHARE rows, save for texts that share length and hash
    rows = closed.join(F.broadcast(merged), "name", "left")
    kept = F.col("best") & (~F.col("hot") | (F.col("part") == F.col("hot_part")))
    columns = [
        F.col("doc").alias("doc_id"),
        F.when(F.col("hot"), F.col("hot_keep")).otherwise(F.col("keep")).alias("keep_id"),
        F.when(F.col("hot"), F.col("hot_size")).otherwise(F.col("size")).alias("group_size"),
        kept.alias("kept"),
        F.lower(F.hex("name")).alias("text_sha256"),
    ]
    if with_text:
        columns.append(F.when(kept, F.col("text")).cast("string").alias("text"))
    return rows.select(*columns)
