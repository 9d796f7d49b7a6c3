"""Spelling variants: words of a vocabulary that differ by one inserted, deleted or replaced code point.

Two such words agree in the left or the right half of the shorter one, so words meet by half: each is dealt under the halves
of its length and of the length below. Within a group the words are sorted and scanned once per word: the rows of
the edit matrix, three cells wide, are kept as far as a candidate shares its beginning with the one before, and all candidates
whose shared beginning is already more than one edit away are skipped together.

A group too large for one task is dealt again by the halves of what its words do not yet share, until it is small or one code point is
left, where the alphabet bounds it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

# Words of a group that one task compares; entries that a task counts before it hands them on; text taken at once.
GROUP = 4_000
COUNTED = 200_000
PIECE = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")


# --- vocabulary ---


def runs(text: str) -> Counter:
    """Letter runs of a text with A-Z lower-cased, counted; long texts piece by piece."""
    found, at = Counter(), 0
    while at < len(text):
        gap = _BREAK.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = gap.start() if gap else len(text)
        found.update(_RUN.findall(text[at:end].encode().lower().decode()))
        at = end
    return found


def damaged(run: str, seed: int, every: int) -> str:
    """The run, less one code point for one in ``every`` of the pairs of document and run, chosen by their crc32."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count_rows(found: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.large_string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
    )


def _counting(least_length: int, every: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in runs(value.as_py() or "").items():
                    if len(word) >= least_length:
                        word = damaged(word, seed, every) if every else word
                        if len(word) >= least_length:
                            total[word] = total.get(word, 0) + n
                if len(total) >= COUNTED:
                    yield _count_rows(total)
                    total = {}
        yield _count_rows(total)

    return run


def vocabulary(docs: DataFrame, least_length: int = 5, least_n: int = 3, every: int | None = None) -> DataFrame:
    """(word, n): letter runs of at least so many code points and occurrences. With ``every``, one in so many pairs of
    document and run loses a code point first. Null texts have no words; a null doc_id counts as the empty text."""
    picked = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counted = picked.mapInArrow(_counting(least_length, every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


# --- near pairs ---


def _steps() -> list[int]:
    """The banded matrix as a table: the next row for a row and for which of three code points of the query match.

    A row has the distances of a candidate's first d code points to the query's first d - 1, d and d + 1, at most 2
    each, as one number in base 3.
    """
    table = []
    for a, b, c in product(range(3), repeat=3):
        for x, y, z in product((1, 0), repeat=3):
            low = min(a + x, b + 1, 2)
            middle = min(b + y, c + 1, low + 1, 2)
            high = min(c + z, middle + 1, 2)
            table.append(9 * low + 3 * middle + high)
    return table


_STEP = _steps()
_EQUAL, _DEAD = 9 * 1 + 0 * 3 + 1, 26
# Distance in each cell of a row.
_CELL = [[row // 9, row // 3 % 3, row % 3] for row in range(27)]


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def near_pairs(words: list[str], shorter: int) -> Iterator[tuple[int, int]]:
    """Positions of words at one edit from each other in a sorted list of words of ``shorter`` code points or one more;
    not both of the longer ones. Equal words are no pair."""
    n = len(words)
    common = [0, *[shared(words[k - 1], words[k]) for k in range(1, n)], -1]
    # the next place that shares less with its predecessor
    jump, stack = [0] * (n + 1), []
    for k in range(n + 1):
        while stack and common[stack[-1]] > common[k]:
            jump[stack.pop()] = k
        stack.append(k)
    step, dead = _STEP, _DEAD
    for i, query in enumerate(words[:-1] if n else []):
        length = len(query)
        # a mark that no text has stands on either side
        q = f"\ud800{query}\ud800\ud800"
        rows = [_EQUAL] * (max(common[i + 1], 0) + 1)
        j = i + 1
        while j < n:
            keep = common[j]
            word = words[j]
            del rows[keep + 1 :]
            row, d = rows[-1], len(rows)
            size = len(word)
            while d <= size:
                x = word[d - 1]
                row = step[row * 8 + (q[d - 1] == x) * 4 + (q[d] == x) * 2 + (q[d + 1] == x)] if d <= length + 1 else dead
                if row == dead:
                    break
                rows.append(row)
                d += 1
            if row == dead and d <= size:
                j += 1
                while common[j] >= d:
                    j = jump[j]
                continue
            if (size == shorter or length == shorter) and _CELL[row][length - size + 1] == 1:
                yield i, j
            j += 1


def _first_path(x: str, y: str, shorter: int, path: str) -> bool:
    """Whether ``path`` is the first way the pair meets: right halves count only where left ones differ."""
    a = b = 0
    for side in path:
        half = (shorter - a - b) // 2
        if side == "l":
            a += half
        elif x[a : a + half] == y[a : a + half]:
            return False
        else:
            b += half
    return True


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the groups, whose rows arrive together and sorted."""

    def close(group: list[tuple], shorter: int, path: str, back: bool) -> list[tuple]:
        found = []
        if len(group) > 1 and any(len(w) == shorter for w, _ in group):
            for i, j in near_pairs([w for w, _ in group], shorter):
                (x, nx), (y, ny) = group[i], group[j]
                x, y = (x[::-1], y[::-1]) if back else (x, y)
                if _first_path(x, y, shorter, path):
                    found.append((x, nx, y, ny))
        return found

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.large_string(), pa.int64(), pa.large_string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["x", "nx", "y", "ny"]
        )

    now, group, out = None, [], []
    for batch in batches:
        for key, shorter, path, back, spot, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (key, shorter, path) != now:
                if now:
                    out += close(group, now[1], now[2], was_back)
                now, group = (key, shorter, path), []
                was_back = back
                if len(out) >= 10_000:
                    yield batch_of(out)
                    out = []
            group.append((spot, n))
    if now:
        out += close(group, now[1], now[2], was_back)
    yield batch_of(out)


def _side(name: str, key: list[Column], part: Column, a: Column, b: Column) -> Column:
    return F.struct(
        F.xxhash64(*key, F.lit(name), part).alias("key"),
        F.concat(F.col("path"), F.lit(name)).alias("path"),
        a.cast("int").alias("a"),
        b.cast("int").alias("b"),
    )


def _halved(rows: DataFrame, key: list[Column]) -> DataFrame:
    """Every row twice: under the left and under the right half of what its group does not share yet."""
    a, b, half = F.col("a"), F.col("b"), F.floor((F.col("shorter") - F.col("a") - F.col("b")) / 2).cast("int")
    left = _side("l", key, F.substr("word", a + 1, half), a + half, b)
    right = _side("r", key, F.substr("word", F.length("word") - b - half + 1, half), a, b + half)
    return rows.select("word", "n", "shorter", F.explode(F.array(left, right)).alias("to")).select(
        "word", "n", "shorter", "to.*"
    )


def links(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(x, nx, y, ny): every pair of distinct words (word, n) at one edit, once, in either order."""
    length = F.length("word")
    shorter = F.explode(F.array(length, length - 1)).alias("shorter")
    first = words.where(F.col("word") != "").select("word", "n", shorter)
    first = first.select("*", F.lit("").alias("path"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    open_rows = _halved(first, [F.col("shorter")])
    pairs, key = None, ["key", "shorter", "path"]
    while True:
        # groups of at most one free code point are bounded by the alphabet
        sizes = open_rows.groupBy(*key, "a", "b").agg(F.count(F.lit(1)).alias("size"))
        large = sizes.where((F.col("size") > group) & (F.col("shorter") - F.col("a") - F.col("b") > 1))
        large = stored(large.select(*key), "large-groups")
        done = large.isEmpty()
        ready = open_rows if done else open_rows.join(large, key, "left_anti")
        back = F.col("b") > F.col("a")
        spot = F.when(back, F.reverse("word")).otherwise(F.col("word")).alias("spot")
        ready = ready.select(*key, back.alias("back"), spot, "n").repartition("key").sortWithinPartitions(*key, "spot")
        found = ready.mapInArrow(_scan, "x string, nx bigint, y string, ny bigint")
        pairs = found if pairs is None else pairs.unionByName(found)
        if done:
            return pairs
        open_rows = stored(_halved(open_rows.join(large, key, "left_semi"), [F.col("key")]), "open-groups")


# --- forms and roots ---


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms (word, form). Every round doubles the distance looked ahead."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(roots.join(ahead, "root", "left").select("word", "root", "next"), "roots")
        if step.where("next IS NOT NULL").isEmpty():
            return step.select("word", "root")
        roots = stored(step.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spellings(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of
    largest n, of equals the first in code-point order, if that n is at least twice its own; else null, with a null form_n. The root is
    the last form from the word on, the word itself if it has none. Words are distinct; a null or empty word is near
    none. Columns other than word and n are not read, whatever their names. No words give no rows.
    """
    words = stored(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("bigint").alias("n")), "words")
    pairs = stored(links(words, group), "near-words")
    both = pairs.unionByName(pairs.selectExpr("y AS x", "ny AS nx", "x AS y", "nx AS ny"))
    best = both.groupBy(F.col("x").alias("word"), F.col("nx").alias("n")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("ny")).alias("less"), F.col("y"))).alias("best")
    )
    has_form = -F.col("best.less") >= 2 * F.col("n")
    best = stored(
        best.select(
            "word", "n_near", F.when(has_form, F.col("best.y")).alias("form"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = roots_of(best.where("form IS NOT NULL").select("word", "form"))
    return (
        words.join(best, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n",
        )
    )
