"""SentencePiece encoding and decoding with the best-scoring pieces (unigram lattice).

The best segmentation is a path of greatest score sum. Long documents are cut into chunks. A chunk's
transfer matrix holds, for each number of its first characters that a piece of the previous chunk covers and each
number of characters by which its last piece reaches into the next, the best score in between. Max-plus products of the
matrices, an associative scan, give the scores at every cut; a second scan composes the chunks' choices from the end;
then every chunk traces its own pieces. What lies between the first and the last place of a chunk that no piece crosses does
not depend on other chunks and is encoded with the matrix.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fresh, release, stored
from tallyloom.llm.words import mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Stands for a space mark that is in the text itself: no text holds a lone surrogate.
_MARK = "\udc81"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_BREAK = re.compile(f"[^{SPACE}]{SPACE}")
_NONE = -(1 << 60)
_MIX = np.uint64(0x9E3779B97F4A7C15)
# Longer words are not remembered.
_LONG = 48


@dataclass
class Vocabulary:
    """Pieces with id and score, byte pieces, and the score of a character that no piece has."""

    score: dict[str, int]
    ids: dict[str, int]
    # every piece and every beginning of one: its score or None, and whether longer pieces begin with it
    steps: dict[str, tuple[int | None, bool]]
    byte_ids: tuple[int, ...]
    texts: tuple[str, ...]
    unknown: int
    longest: int
    words_apart: bool
    name: str
    trie: Trie | None = None


def load(path: str = MODEL) -> Vocabulary:
    """The pieces of a SentencePiece model file with byte fallback and whole-number scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    plain = [
        i for i in range(len(texts)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    score = {texts[i]: round(model.get_score(i)) for i in plain}
    starts = {t[:k] for t in score for k in range(1, len(t))}
    v = Vocabulary(
        score=score,
        ids={texts[i]: i for i in plain},
        steps={t: (score.get(t), t in starts) for t in starts | score.keys()},
        byte_ids=byte_ids,
        texts=tuple(texts),
        unknown=min(score.values()) - 10,
        longest=max(map(len, score)),
        words_apart=not any(SPACE in t.lstrip(SPACE) for t in score),
        name=hashlib.sha256(repr((texts, score, byte_ids)).encode()).hexdigest(),
    )
    v.trie = Trie(v)
    return v


def marked(text: str, first: bool = True) -> str:
    """Spaces as marks, with one more in front of a text."""
    return SPACE * first + text.replace(SPACE, _MARK).replace(" ", SPACE)


def unmarked(text: str) -> str:
    return text.replace(SPACE, " ").replace(_MARK, SPACE)


def lattice(v: Vocabulary, text: str, begin: dict[int, int], upto: int) -> tuple[list[int], list[int]]:
    """Best score at each position of ``text`` and the start of the last piece there.

    ``begin`` has the scores at positions where a piece may start first. Pieces start before ``upto`` and may end
    behind it. Of equal scores the longest last piece wins.
    """
    step, n = v.steps.get, len(text)
    alone = (v.unknown, False)
    best, back = [_NONE] * (n + 1), [-1] * (n + 1)
    for p, s in begin.items():
        best[p] = s
    for i in range(upto):
        here = best[i]
        if here == _NONE:
            continue
        j = i + 1
        found, more = step(text[i], alone)
        if found is None:
            found = v.unknown
        if here + found > best[j]:
            best[j], back[j] = here + found, i
        while more and j < n:
            j += 1
            known = step(text[i:j])
            if known is None:
                break
            found, more = known
            if found is not None and here + found > best[j]:
                best[j], back[j] = here + found, i
    return best, back


def piece_ids(v: Vocabulary, piece: str) -> tuple[int, ...]:
    found = v.ids.get(piece)
    if found is not None:
        return (found,)
    return tuple(v.byte_ids[b] for b in (SPACE if piece == _MARK else piece).encode())


def traced(v: Vocabulary, text: str, back: list[int], end: int) -> tuple[int, tuple[int, ...]]:
    """Where the path to ``end`` starts, and its ids."""
    parts = []
    while back[end] >= 0:
        parts.append(piece_ids(v, text[back[end] : end]))
        end = back[end]
    return end, tuple(chain.from_iterable(reversed(parts)))


class Trie:
    """The pieces as arrays, for many words at a time."""

    def __init__(self, v: Vocabulary):
        nodes = {"": 0} | {t: k + 1 for k, t in enumerate(sorted(v.steps))}
        letters = sorted({c for t in v.score for c in t})
        number = {c: k for k, c in enumerate(letters)}
        # the number of each code point, -1 where no piece has it; what lies behind the last one shares its last place
        self.letter = np.full(ord(letters[-1]) + 2, -1, dtype=np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        self.width = len(letters)
        # edges in a hash table with probing: about six places for each, so that one look is enough as a rule
        self.bits = max(4, (6 * len(v.steps)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.to = np.full(1 << self.bits, -1, dtype=np.int32)
        left = np.array([nodes[t[:-1]] * len(letters) + number[t[-1]] for t in v.steps], dtype=np.int64)
        to = np.array([nodes[t] for t in v.steps], dtype=np.int32)
        at, self.probes = self._slot(left), 0
        while len(left):
            self.probes += 1
            free = self.keys[at] == -1
            first = np.zeros(len(at), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = np.flatnonzero(free & first)
            self.keys[at[put]], self.to[at[put]] = left[put], to[put]
            rest = ~(free & first)
            left, to, at = left[rest], to[rest], (at[rest] + 1) & ((1 << self.bits) - 1)
        self.score = np.full(len(nodes), _NONE, dtype=np.int64)
        self.ids = np.full(len(nodes), -1, dtype=np.int32)
        for t, s in v.score.items():
            self.score[nodes[t]], self.ids[nodes[t]] = s, v.ids[t]
        self.more = np.zeros(len(nodes), dtype=bool)
        self.more[[nodes[t] for t, (_, more) in v.steps.items() if more]] = True
        # the node of each letter, then of none, and what a character alone scores
        self.first = np.array([nodes[c] if c in nodes else 0 for c in letters] + [0], dtype=np.int32)
        self.alone = np.where(self.score[self.first] == _NONE, v.unknown, self.score[self.first])

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def child(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The nodes that the letters lead to, -1 for none; letter -1 is in no piece."""
        key = node * np.int64(self.width) + letter
        key[letter < 0] = -2
        at = self._slot(key)
        there = self.keys[at]
        out = np.where(there == key, self.to[at], -1)
        for _ in range(self.probes - 1):
            on = np.flatnonzero((there != key) & (there != -1))
            if not len(on):
                break
            at[on] = (at[on] + 1) & ((1 << self.bits) - 1)
            there[on] = self.keys[at[on]]
            out[on] = np.where(there[on] == key[on], self.to[at[on]], -1)
        return out

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """The letters of code points."""
        return self.letter[np.minimum(codes, len(self.letter) - 1)]

    def best(self, letter: np.ndarray, length: np.ndarray) -> tuple[list[int], list[bytes | None]]:
        """Scores of words, whose letters lie end to end, and their ids as bytes of 32-bit integers, None if no piece has one of
        the characters.

        The same steps as ``lattice``, for all words at once: first every piece that starts at any character, then the scores,
        place by place in the words.
        """
        n, longest = len(length), int(length.max())
        # one place more for each word than it has characters: its end
        begin = np.cumsum(length + 1) - length - 1
        place = np.arange(len(letter)) - np.repeat(np.cumsum(length) - length, length)
        spot = np.arange(len(letter)) + np.repeat(np.arange(n), length)
        left = np.repeat(length, length) - place

        node = self.first[letter]
        froms, tos, scores, ids = [spot], [spot + 1], [self.alone[letter]], [self.ids[node]]
        places, at, depth = [place], np.flatnonzero(self.more[node] & (left > 1)), 1
        node = node[at]
        while len(at):
            node = self.child(node, letter[at + depth])
            depth += 1
            found = node >= 0
            at, node = at[found], node[found]
            score = self.score[node]
            piece = score != _NONE
            start = at[piece]
            froms.append(spot[start])
            tos.append(spot[start] + depth)
            scores.append(score[piece])
            ids.append(self.ids[node[piece]])
            places.append(place[start])
            on = self.more[node] & (left[at] > depth)
            at, node = at[on], node[on]

        places = np.concatenate(places)
        order = np.argsort(places.astype(np.int16), kind="stable")
        bounds = np.searchsorted(places[order], np.arange(longest + 1))
        source, target = np.concatenate(froms)[order], np.concatenate(tos)[order]
        value, name = np.concatenate(scores)[order], np.concatenate(ids)[order]
        total = np.full(len(letter) + n, _NONE, dtype=np.int64)
        total[begin] = 0
        last = np.zeros(len(letter) + n, dtype=np.int64)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            reached, to = total[source[a:b]] + value[a:b], target[a:b]
            better = np.flatnonzero(reached > total[to])
            hit = to[better]
            total[hit], last[hit] = reached[better], better + a

        rows, here, steps = np.arange(n), begin + length, []
        while len(rows):
            edge = last[here]
            taken = np.full(n, -2, dtype=np.int32)
            taken[rows] = name[edge]
            steps.append(taken)
            here = source[edge]
            on = here > begin[rows]
            rows, here = rows[on], here[on]
        paths = np.stack(steps[::-1], axis=1)
        odd = (paths == -1).any(axis=1).tolist()
        counts = (paths != -2).sum(axis=1).tolist()
        held, width = paths.tobytes(), 4 * len(steps)
        ends = range(width, len(held) + 1, width)
        ids = [None if strange else held[end - 4 * count : end] for strange, count, end in zip(odd, counts, ends, strict=True)]
        return total[begin + length].tolist(), ids


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Encoder:
    """Ids of marked text between two places where a piece must end; words are remembered, up to a number.

    The ids of a word are kept as the bytes of 32-bit integers, which take a fraction of a tuple's memory.
    """

    def __init__(self, v: Vocabulary, most_words: int = 400_000):
        self.v, self.most = v, most_words
        self.known: dict[str, bytes] = {}
        self.totals: dict[str, int] = {}
        # ids of parts of texts by name: those met since half the number was reached, and those met before
        self.plain: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}
        # a number for each letter, and a factor for each place in a word
        self.drawn = mix(np.arange(1, v.trie.width + 1, dtype=np.uint64) * _MIX)
        self.power = np.multiply.accumulate(np.full(_LONG + 1, _MIX))
        # the score of each id; that of a character that no piece has is with its first byte
        self.weight = np.zeros(len(v.texts), dtype=np.int64)
        self.weight[list(v.ids.values())] = [v.score[t] for t in v.ids]
        self.weight[[i for b, i in enumerate(v.byte_ids) if not 0x80 <= b < 0xC0]] = v.unknown

    def learn(self, texts: list[str], totals: bool = False) -> None:
        """Remember the new words of some marked texts, all found at once, and on request their scores; odd words are left
        to ``word``. Never more words are held than ``most_words`` or those of these texts."""
        if not self.v.words_apart:
            return
        words = {w for t in texts for w in _WORD.findall(t) if len(w) <= _LONG}
        held = self.totals if totals else self.known
        new = [w for w in words if w not in held]
        if len(held) + len(new) > self.most:
            self.known.clear()
            self.totals.clear()
            new = list(words)
        for word, total, ids in self._best(new):
            if ids is not None:
                self.known[word] = ids
                if totals:
                    self.totals[word] = total

    def _best(self, words: list[str]) -> Iterator[tuple[str, int, bytes | None]]:
        for at in range(0, len(words), 8_000):
            part = words[at : at + 8_000]
            letter = self.v.trie.numbers(_codes("".join(part)))
            yield from zip(part, *self.v.trie.best(letter, np.array([len(w) for w in part])), strict=True)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        return self.split([marked(t) if t else "" for t in texts])

    def split(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of marked texts. A text is cut before its marks, and around characters that no piece has: no piece crosses either.
        Where marks follow each other a text goes the way of ``learn``.

        Parts are known by 64-bit names of their letters, no Python object stands for a word that was met before.
        """
        if len(self.plain) >= self.most // 2:
            self.older, self.plain = self.plain, {}
        odd = [not self.v.words_apart or SPACE * 2 in t for t in texts]
        self.learn([t for t, o in zip(texts, odd, strict=True) if o])
        even = iter(self._split_even([t for t, o in zip(texts, odd, strict=True) if not o]))
        return [self.array(t) if o else next(even) for t, o in zip(texts, odd, strict=True)]

    def _split_even(self, texts: list[str]) -> list[np.ndarray]:
        codes = _codes("".join(texts))
        if not len(codes):
            return [np.zeros(0, dtype=np.int32)] * len(texts)
        letter = self.v.trie.numbers(codes)
        bounds = np.cumsum([0, *map(len, texts)])
        strange = letter < 0
        opens = strange | (codes == ord(SPACE))
        opens[1:] |= strange[:-1]
        opens[bounds[bounds < len(codes)]] = True
        start = np.flatnonzero(opens)
        size = np.diff(start, append=len(codes))
        drawn = self.drawn[letter]
        drawn[strange] = mix(codes[strange] + np.uint64(len(self.drawn)))
        place = np.arange(len(codes)) - np.repeat(start, size)
        name = mix(np.add.reduceat(drawn * self.power[np.minimum(place, _LONG)], start) + size.astype(np.uint64) * _MIX)
        # longer words are no part of what is remembered, each has a name of its own
        long = np.flatnonzero(size > _LONG)
        name[long] = mix(start[long].astype(np.uint64))
        distinct, first, which = np.unique(name, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        found = list(map(self.plain.get, keys))
        new = np.array([k for k, ids in enumerate(found) if ids is None], dtype=np.int64)
        self._learn_even(new, keys, found, codes, letter, start[first], size[first])
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        held = np.frombuffer(b"".join(found), dtype=np.int32)
        count, begin = counts[which], (np.cumsum(counts) - counts)[which]
        ends = np.cumsum(count)
        ids = held[np.arange(ends[-1]) + np.repeat(begin - ends + count, count)]
        edges = np.append(ends - count, ends[-1])[np.searchsorted(start, bounds)].tolist()
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def _learn_even(self, new: np.ndarray, keys: list[int], found: list, codes: np.ndarray, letter: np.ndarray, start, size) -> None:
        """Put the ids of the new parts among those found, and remember them."""

        def text(k: int) -> str:
            return codes[start[k] : start[k] + size[k]].tobytes().decode("utf-32-le", "surrogatepass")

        rest = []
        for k in new.tolist():
            ids = self.older.get(keys[k])
            if ids is not None:
                found[k] = self.plain[keys[k]] = ids
            elif size[k] > _LONG:
                found[k] = self.word(text(k))
            else:
                rest.append(k)
        rest = np.array(rest, dtype=np.int64)
        for at in range(0, len(rest), 8_000):
            part = rest[at : at + 8_000]
            length = size[part]
            flat = np.arange(length.sum()) + np.repeat(start[part] - np.cumsum(length) + length, length)
            for k, ids in zip(part.tolist(), self.v.trie.best(letter[flat], length)[1], strict=True):
                found[k] = self.plain[keys[k]] = self.word(text(k)) if ids is None else ids

    def word(self, word: str) -> bytes:
        if len(self.known) >= self.most:
            self.known.clear()
        _, back = lattice(self.v, word, {0: 0}, len(word))
        ids = np.array(traced(self.v, word, back, len(word))[1], dtype=np.int32).tobytes()
        if len(word) <= _LONG:
            self.known[word] = ids
        return ids

    def word_total(self, word: str) -> int:
        if len(self.totals) >= self.most:
            self.totals.clear()
        found = lattice(self.v, word, {0: 0}, len(word))[0][-1]
        if len(word) <= _LONG:
            self.totals[word] = found
        return found

    def ids(self, text: str) -> list[int]:
        return self.array(text).tolist()

    def array(self, text: str) -> np.ndarray:
        words = _WORD.findall(text) if self.v.words_apart else [text] if text else []
        known, word = self.known, self.word
        return np.frombuffer(b"".join([known.get(w) or word(w) for w in words]), dtype=np.int32)

    def total(self, text: str) -> int:
        words = _WORD.findall(text) if self.v.words_apart else [text] if text else []
        totals, word_total = self.totals, self.word_total
        return sum(t if (t := totals.get(w)) is not None else word_total(w) for w in words)


def _breaks(v: Vocabulary, text: str, upto: int) -> tuple[int, int] | None:
    """First and last position in a chunk that no piece crosses, at least a piece's length from its start."""
    if not v.words_apart:
        return None
    found = _BREAK.search(text, v.longest - 1, upto + 1)
    if found is None:
        return None
    final = text.rfind(SPACE, 0, upto + 1)
    while text[final - 1] == SPACE:
        final = text.rfind(SPACE, 0, final)
    return found.end() - 1, final


def lead(v: Vocabulary, text: str) -> list[int]:
    """Best score from each of the first positions to the end of ``text``, where a piece must end."""
    step, n = v.steps.get, len(text)
    alone = (v.unknown, False)
    best = [_NONE] * n + [0]
    for i in range(n - 1, -1, -1):
        j = i + 1
        found, more = step(text[i], alone)
        most = best[j] + (v.unknown if found is None else found)
        while more and j < n:
            j += 1
            known = step(text[i:j])
            if known is None:
                break
            found, more = known
            if found is not None:
                most = max(most, best[j] + found)
        best[i] = most
    return best[: v.longest]


def transfer(v: Vocabulary, head: str, tail: str | None, middle: int, size: int, last: bool) -> np.ndarray:
    """The chunk's max-plus matrix, by rows of entry states. ``head`` goes to the first place that no piece crosses, ``middle`` is
    the score from there to the last such place, and ``tail`` goes on from it. Without such places the tail is None and the head
    is all; ``size`` is the place in the last text where the next chunk begins."""
    n = v.longest

    def ends(best: list[int]) -> np.ndarray:
        row = np.full(n, _NONE, dtype=np.int64)
        reach = best[size : size + 1] if last else best[size : size + n]
        row[: len(reach)] = reach
        return row

    if tail is None:
        starts = range(min(n, size + 1))
        rows = [ends(lattice(v, head, {s: 0}, size)[0]) for s in starts]
        return np.concatenate(rows + [np.full(n * (n - len(starts)), _NONE, dtype=np.int64)])
    row = ends(lattice(v, tail, {0: 0}, size)[0])
    heads = np.array(lead(v, head), dtype=np.int64)
    return np.where(row[None] == _NONE, _NONE, heads[:, None] + middle + row[None]).ravel()


def product(a: list[int], b: list[int], n: int) -> list[int]:
    """Max-plus product of two matrices given by rows."""
    x, y = np.array(a, dtype=np.int64).reshape(n, n), np.array(b, dtype=np.int64).reshape(n, n)
    both = np.where((x[:, :, None] <= _NONE) | (y[None] <= _NONE), _NONE, x[:, :, None] + y[None])
    return both.max(axis=1).ravel().tolist()


def then(a: list[int], b: list[int], n: int) -> list[int]:
    """Composition of two state maps: ``a`` first."""
    return [b[s] if s >= 0 else -1 for s in a]


def scan(frame: DataFrame, combine: Callable, n: int, width: int = 64) -> DataFrame:
    """(row, spot, before) from (row, spot, value): the combined values of all earlier spots of the row, null for the first.

    Blocks of ``width`` spots are combined apart and their totals scanned the same way, so no task holds more than one block of
    a row.
    """

    def run(key, table):
        rows = sorted(zip(table["spot"].to_pylist(), table["value"].to_pylist(), strict=True))
        spots, befores, total = [], [], None
        for spot, value in rows:
            spots.append(spot)
            befores.append(total)
            total = value if total is None else combine(total, value, n)
        spots.append(None)
        befores.append(total)
        count = len(spots)
        return pa.table(
            {
                "row": pa.array([key[0].as_py()] * count, pa.int64()),
                "block": pa.array([key[1].as_py()] * count, pa.int64()),
                "spot": pa.array(spots, pa.int64()),
                "before": pa.array(befores, pa.list_(pa.int64())),
            }
        )

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outer, inner = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            both = [i if o is None else o if i is None else combine(o, i, n) for o, i in zip(outer, inner, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(both, pa.list_(pa.int64()))], names=["row", "spot", "before"]
            )

    blocks = frame.withColumn("block", F.floor(F.col("spot") / width))
    schema = "row bigint, block bigint, spot bigint, before array<bigint>"
    local = stored(blocks.groupBy("row", "block").applyInArrow(run, schema), "scan")
    inside = local.where("spot IS NOT NULL")
    if local.where("block > 0").isEmpty():
        return inside.select("row", "spot", "before")
    totals = local.where("spot IS NULL").select("row", F.col("block").alias("spot"), F.col("before").alias("value"))
    outer = scan(totals, combine, n, width).select("row", F.col("spot").alias("block"), F.col("before").alias("outer"))
    joined = inside.join(outer, ["row", "block"]).select("row", "spot", "outer", "before")
    return joined.mapInArrow(compose, "row bigint, spot bigint, before array<bigint>")


# The encoder of this process, which remembers the words of earlier tasks.
_ENCODERS: dict[str, Encoder] = {}


def _encoder(v: Vocabulary) -> Encoder:
    if v.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[v.name] = Encoder(v)
    return _ENCODERS[v.name]


def _whole(v: Vocabulary, at_column: int, prove: bool):
    """Rows with the ids of their text; ``prove`` adds whether decoding them gives the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(v)
        decoder = Decoder(v) if prove else None
        for batch in batches:
            for at, end in slices(1 << 20, batch.column(at_column)):
                part = batch.slice(at, end - at)
                values = part.column(at_column).to_pylist()
                flat = encoder.whole([t or "" for t in values])
                ends = np.concatenate([[0], np.cumsum([len(ids) for ids in flat])]) if flat else [0]
                exact = [back == (t or "") for t, back in zip(values, decoder.texts(flat), strict=True)] if decoder else []
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)))
                columns, names = [*part.columns, ids], [*part.schema.names, "ids of a row"]
                if decoder:
                    columns, names = [*columns, pa.array(exact, pa.bool_())], [*names, "exact of a row"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _cut(chunk: int, ahead: int):
    """Chunks with the ``ahead`` characters behind them; the last has up to twice as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                value = text.as_py()
                count = max(1, len(value) // chunk)
                for at in range(0, count, 256):
                    spots = range(at, min(count, at + 256))
                    ends = [len(value) if k == count - 1 else (k + 1) * chunk for k in spots]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(spots), pa.int64()),
                            pa.array(spots, pa.int64()),
                            pa.array([value[k * chunk : e + ahead] for k, e in zip(spots, ends, strict=True)], pa.string()),
                            pa.array([e - k * chunk for k, e in zip(spots, ends, strict=True)], pa.int64()),
                            pa.array([k == count - 1 for k in spots], pa.bool_()),
                        ],
                        names=["row", "spot", "part", "size", "last"],
                    )

    return run


def _matrices(v: Vocabulary):
    """For each chunk its head and tail, the place in the tail (or else the head) where the next chunk begins, the ids between head
    and tail, and its matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(v)
        for whole in batches:
            for at, end in slices(1 << 20, whole.column(2)):
                batch = whole.slice(at, end - at)
                spots, texts, sizes, lasts = (batch.column(k).to_pylist() for k in range(1, 5))
                texts = [marked(t, s == 0) for s, t in zip(spots, texts, strict=True)]
                sizes = [n + (s == 0) for s, n in zip(spots, sizes, strict=True)]
                cuts = [_breaks(v, t, n) for t, n in zip(texts, sizes, strict=True)]
                heads = [t[: c[0]] if c else t for t, c in zip(texts, cuts, strict=True)]
                tails = [t[c[1] :] if c else None for t, c in zip(texts, cuts, strict=True)]
                sizes = [n - c[1] if c else n for n, c in zip(sizes, cuts, strict=True)]
                middles = encoder.split([t[c[0] : c[1]] if c else "" for t, c in zip(texts, cuts, strict=True)])
                values = [
                    transfer(v, h, t, int(encoder.weight[ids].sum()), n, last)
                    for h, t, ids, n, last in zip(heads, tails, middles, sizes, lasts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array([unmarked(h)[s == 0 :] for s, h in zip(spots, heads, strict=True)], pa.string()),
                        pa.array([t and unmarked(t) for t in tails], pa.string()),
                        pa.array(sizes, pa.int64()),
                        batch.column(4),
                        _lists(middles, np.int32),
                        _lists(values, np.int64),
                    ],
                    names=["row", "spot", "head", "tail", "size", "last", "middle", "value"],
                )

    return run


def _lists(arrays: list[np.ndarray], kind: type) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, kind), *arrays])))


def _path(v: Vocabulary, head: str, tail: str | None, size: int, before: list[int] | None):
    """Given the scores at a chunk's start: start state of the best path to an end state, and its ids in head and tail."""
    begin = {0: 0} if before is None else {s: x for s, x in enumerate(before) if x > _NONE}
    if tail is None:
        _, back = lattice(v, head, begin, size)

        def path(state):
            return (*traced(v, head, back, size + state), ())

        return path
    entry, ids = traced(v, head, lattice(v, head, begin, len(head))[1], len(head))

    def path(state):
        return entry, ids, traced(v, tail, lattice(v, tail, {0: 0}, size)[1], size + state)[1]

    path.entry = entry
    return path


def _choices(v: Vocabulary):
    """For each chunk, the start state of the best path to each end state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for row in zip(*batch.columns[1:], strict=True):
                spot, head, tail, size, last, before = (x.as_py() for x in row)
                head, tail = marked(head, spot == 0), tail and marked(tail, False)
                path = _path(v, head, tail, size, before)
                reach = 1 if last else min(v.longest, len(head if tail is None else tail) - size + 1)
                entry = getattr(path, "entry", None)
                value = [path(k)[0] if entry is None else entry for k in range(reach)]
                value = [e if e < v.longest else -1 for e in value]  # no path ends in that state
                values.append(value + [-1] * (v.longest - len(value)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.int64()))], names=["row", "spot", "value"]
            )

    return run


def _ends(v: Vocabulary):
    """For each chunk the ids in its head, as side 0, and in its tail, as side 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spots, sides, ids = [], [], [], []
            for scalars in zip(*batch.columns, strict=True):
                row, spot, head, tail, size, _, before, state = (x.as_py() for x in scalars)
                _, first, final = _path(v, marked(head, spot == 0), tail and marked(tail, False), size, before)(state)
                rows += [row] * 2
                spots += [spot] * 2
                sides += [0, 2]
                ids += [np.array(first, dtype=np.int32), np.array(final, dtype=np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(spots, pa.int64()), pa.array(sides, pa.int32()), _lists(ids, np.int32)],
                names=["row", "spot", "side", "ids"],
            )

    return run


def long_ids(texts: DataFrame, v: Vocabulary, chunk: int) -> DataFrame:
    """(row, ids) of the texts (row, text), each cut into chunks of ``chunk`` to twice as many characters.

    A chunk is encoded once, between the first and the last place that no piece crosses; only the texts before and behind
    them, a few words, are read again when the scores and choices of other chunks are known.
    """
    schema = "row bigint, spot bigint, part string, size bigint, last boolean"
    kept = "row bigint, spot bigint, head string, tail string, size bigint, last boolean"
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = texts.select("row", "text").mapInArrow(_cut(chunk, v.longest - 1), schema).repartition(tasks, "row", "spot")
    chunks = stored(cut.mapInArrow(_matrices(v), f"{kept}, middle array<int>, value array<bigint>"), "chunks")
    del cut
    release(texts.sparkSession)
    # of the scores before a chunk only those from the start of the text count
    before = scan(chunks.select("row", "spot", "value"), product, v.longest)
    before = before.select("row", "spot", F.slice("before", 1, v.longest).alias("before"))
    edges = chunks.select("row", "spot", "head", "tail", "size", "last")
    placed = stored(edges.join(before, ["row", "spot"]).select(*edges.columns, "before"), "placed")
    choices = stored(placed.mapInArrow(_choices(v), "row bigint, spot bigint, value array<bigint>"), "choices")
    # from the end: spots count down, and the maps of all later chunks lead from the end's state 0 to this one's
    counts = choices.groupBy("row").agg(F.max("spot").alias("top"))
    turned = choices.join(counts, "row")
    later = scan(turned.select("row", (F.col("top") - F.col("spot")).alias("spot"), "value"), then, v.longest)
    states = (
        later.join(counts, "row")
        .select("row", (F.col("top") - F.col("spot")).alias("spot"), F.coalesce(F.col("before")[0], F.lit(0)).alias("state"))
    )
    ends = placed.join(states, ["row", "spot"]).select(*placed.columns, "state")
    ends = ends.mapInArrow(_ends(v), "row bigint, spot bigint, side int, ids array<int>")
    parts = ends.unionByName(chunks.select("row", "spot", F.lit(1).alias("side"), F.col("middle").alias("ids")))
    return parts.groupBy("row").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("spot", "side", "ids"))), lambda x: x["ids"])).alias("ids")
    )


def encode(docs: DataFrame, v: Vocabulary, chunk: int = 16_384, prove: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the piece ids of ``text``, and with ``prove`` also ``exact``: whether decoding the ids gives the
    text again (the empty one for null), found where the text was encoded.

    A mark stands in front of the text and for each space; characters that no piece has become their
    bytes, and so does a space mark of the text itself, so that decoding gives the very text. Of paths
    with equal scores the one whose last pieces are longest counts, also across chunks. Null and empty texts have no
    ids. Texts of twice ``chunk`` characters or more go by chunks. Columns stay, but a column named ids (or exact) is
    replaced. An empty table gives an empty result.
    """
    if chunk <= v.longest:
        raise ValueError("a chunk must be longer than any piece")
    docs = docs.drop("ids", "exact") if prove else docs.drop("ids")
    (row,) = fresh(docs.columns, "row")
    long = F.coalesce(F.length("text"), F.lit(0)) >= 2 * chunk
    # names that come with spaces and so meet no other column
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["`ids of a row` array<int>"]
    made = [F.col("`ids of a row`").alias("ids")]
    if prove:
        fields.append("`exact of a row` boolean")
        made.append(F.col("`exact of a row`").alias("exact"))
    at = docs.columns.index("text")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    short = docs.where(~long).mapInArrow(_whole(v, at, prove), ", ".join(fields)).select(*kept, *made)
    giants = stored(docs.where(long).withColumn(row, F.monotonically_increasing_id()), "giants")
    if giants.isEmpty():
        return short
    ids = long_ids(giants.select(F.col(row).alias("row"), F.col("text").cast("string").alias("text")), v, chunk)
    ids = ids.withColumnRenamed("row", row)
    whole = giants.join(ids, row).select(*kept, "ids")
    if prove:
        (text,) = fresh(whole.columns, "decoded")
        whole = decode(whole, v, text).withColumn("exact", F.col(text) == F.coalesce("text", F.lit(""))).drop(text)
    return short.unionByName(whole)


def text_of(v: Vocabulary, ids: list[int], byte_of: dict[int, int]) -> str:
    """The text of piece ids."""
    out: list[str] = []
    held = bytearray()
    texts = v.texts
    for i in ids:
        b = byte_of.get(i)
        if b is not None:
            held.append(b)
            continue
        if held:
            out.append(held.decode("utf-8", "replace"))
            held.clear()
        out.append(texts[i].replace(SPACE, " "))
    if held:
        out.append(held.decode("utf-8", "replace"))
    return "".join(out)[1:]


class Decoder:
    """Texts of piece ids; the bytes of the pieces are made once."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.byte_of = {i: b for b, i in enumerate(v.byte_ids)}
        pieces = [bytes([self.byte_of[i]]) if i in self.byte_of else t.replace(SPACE, " ").encode() for i, t in enumerate(v.texts)]
        self.pieces = pa.array(pieces, pa.large_binary())

    def raw(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, list[int]]:
        """The bytes of some texts, whose ids lie end to end, and where each text ends; each begins with its mark."""
        joined = self.pieces.take(pa.array(ids))
        _, offsets, data = joined.buffers()
        places = np.frombuffer(offsets, dtype=np.int64)[: len(joined) + 1]
        return data.to_pybytes() if data is not None else b"", places[ends].tolist()

    def texts(self, flat: list[np.ndarray]) -> list[str]:
        """The texts of some lists of ids."""
        ends = np.cumsum([0, *map(len, flat)])
        data, at = self.raw(np.concatenate([np.zeros(0, dtype=np.int32), *flat]), ends)
        out = []
        for ids, a, b in zip(flat, at[:-1], at[1:], strict=True):
            try:
                out.append(data[a:b].decode()[1:])
            except UnicodeDecodeError:
                # bytes that are no text: what lies between two pieces is read apart
                out.append(text_of(self.v, ids.tolist(), self.byte_of))
        return out


def _decode(v: Vocabulary, at_column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(v)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                nothing = np.zeros(0, dtype=np.int32)
                out = decoder.texts(
                    [ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else nothing for ids in part.column(at_column)]
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(out, pa.string())], names=[*part.schema.names, "text of a row"]
                )

    return run


def decode(encoded: DataFrame, v: Vocabulary, name: str = "decoded") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``: the encoded text, or the empty one for null. A column of that name
    is replaced."""
    encoded = encoded.drop(name)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields]
    return encoded.mapInArrow(_decode(v, encoded.columns.index("ids")), ", ".join([*fields, "`text of a row` string"])).select(
        *[F.col(f"`{c}`") for c in encoded.columns], F.col("`text of a row`").alias(name)
    )
