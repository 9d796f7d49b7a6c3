"""Words of whole Arrow text columns as arrays of 64-bit names, without a Python object per word.

A word is a longest stretch of bytes other than space and 0x09-0x0D. Its name is a polynomial over
its UTF-8 bytes modulo 2^64, mixed; equal words have equal names in every task. Two given words share a
name with a probability near 2^-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# Letters whose products are held at once.
_PORTION = 1 << 20


@dataclass
class Words:
    """Words of some documents, in order.

    ``first[d]`` to ``first[d + 1]`` are the words of document d; ``start`` and ``end`` are byte
    positions in ``data``.
    """

    data: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    name: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the bounds of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _polynomials(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The polynomial of each word; ``letters`` are the bytes of all words end to end. A portion of whole words goes at once, as its
    numbers take forty times its bytes."""
    power = np.ones(int(length.max()), dtype=np.uint64)
    np.multiply.accumulate(np.full(len(power) - 1, _BASE), out=power[1:])
    at = np.cumsum(length) - length
    out = np.empty(len(length), dtype=np.uint64)
    one = 0
    while one < len(length):
        end = max(one + 1, int(np.searchsorted(at, at[one] + _PORTION)))
        begin = at[one:end] - at[one]
        part = letters[at[one] : at[end - 1] + length[end - 1]]
        place = np.arange(len(part)) - np.repeat(begin, length[one:end])
        out[one:end] = np.add.reduceat(_BYTES[part] * power[place], begin)
        one = end
    return out


def words_of(column: pa.Array, lower: bool) -> Words:
    """The words of a text column; ``lower`` turns A-Z into a-z first."""
    return words_in(*text_bytes(column), lower)


def words_in(data: np.ndarray, bounds: np.ndarray, lower: bool) -> Words:
    """The words of texts that lie end to end in ``data``, text d from ``bounds[d]`` to ``bounds[d + 1]``."""
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    first = np.searchsorted(start, bounds)
    length = end - start
    if len(start):
        name = mix(_polynomials(data[inside], length) + length.astype(np.uint64) * _M2)
    else:
        name = np.zeros(0, dtype=np.uint64)
    return Words(data, first, start, end, name)


def join_names(*parts: np.ndarray) -> np.ndarray:
    """The name of a sequence from the names of its parts."""
    out = np.zeros_like(parts[0])
    for part in parts:
        out = mix(out * _BASE + part)
    return out


def slices(batch_bytes: int, column: pa.Array) -> list[tuple[int, int]]:
    """Row ranges of at most about ``batch_bytes`` of text each; a longer text stands alone."""
    _, bounds = text_bytes(column)
    cuts, at = [], 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + batch_bytes, side="right")) - 1)
        cuts.append((at, upto))
        at = upto
    return cuts
