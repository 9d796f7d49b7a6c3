"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests takes for random.

A token's encoding is inferred from its characters. Its symbols are tested for uniform use of the encoding's
alphabet (chi-squared), for too few or many runs above and below the middle, and for serial correlation. A random token
fails none of them. The p-value of a finding is the chance that ordinary text looks so: as uniform at that length
under the symbol shares of the whole corpus, or as surprising to its pairs of symbols beside equally likely symbols.
The false discovery rate is controlled for each encoding and class of lengths over all tokens of the corpus. Tokens
with separators are also tested part by part.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_PART = re.compile(r"[A-Za-z0-9+]{16,}")
_KEYWORDS = ("passw", "secret", "token", "api")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings and their alphabets in order; the first that holds all of a token's symbols is taken.
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SETS = {name: frozenset(a) for name, a in ENCODINGS.items()}
_PLACES = {name: {c: k for k, c in enumerate(a)} for name, a in ENCODINGS.items()}
SYMBOLS = "".join(sorted(set("".join(ENCODINGS.values()))))


@dataclass(frozen=True)
class Settings:
    """``rate``: false discovery rate. ``level``: p-value below which a test rejects randomness. ``lengths``: where
    classes of lengths start. ``step``: width of a bin of -log10 p; ``bins``: their number. ``prior``: symbols that the
    shares weigh against the pairs after a symbol; ``flat``: share of equally likely symbols in what follows one."""

    rate: float = 0.01
    level: float = 0.01
    lengths: tuple[int, ...] = (16, 20, 24, 32, 48, 96)
    step: float = 0.05
    bins: int = 400
    prior: float = 1000.0
    flat: float = 0.1


def encoding(token: str) -> str | None:
    """The narrowest encoding of a token with a digit and a letter or with both cases; None for plain words."""
    symbols = set(token)
    digit, lower, upper = (bool(symbols & set(c)) for c in (_DIGITS, _LOWER, _UPPER))
    if digit + lower + upper < 2:
        return None
    return next((name for name, s in _SETS.items() if symbols <= s), None)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(values: np.ndarray, size: int) -> tuple[float, float, float, float]:
    """Chi-squared statistic, and p-values of uniformity, runs and serial correlation for random symbols."""
    n = len(values)
    counts = np.bincount(values, minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    uniform = _normal_tail((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
    high = values >= size / 2
    above = int(high.sum())
    below = n - above
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * above * below / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs_p = 2 * _normal_tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 0.0
    centred = values - values.mean()
    spread = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / spread if spread else 1.0
    serial_p = 2 * _normal_tail(abs(serial + 1 / n) * math.sqrt(n))
    return chi, uniform, runs_p, serial_p


def ordinary(chi: float, n: int, shares: np.ndarray) -> float:
    """Chance that n symbols drawn with the given shares give a statistic as small as ``chi``."""
    a = len(shares)
    mean = a * float((shares * (1 - shares)).sum() + n * ((shares - 1 / a) ** 2).sum())
    third, square = float((shares**3).sum()), float((shares**2).sum())
    variance = a * a * (4 * (n - 1) * (n - 2) / n * (third - square**2) + 2 * (n - 1) / n * (square - square**2))
    return _normal_tail((mean - chi) / math.sqrt(max(variance, 1e-9)))


def likelier(total: dict[str, int], name: str, shares: np.ndarray, settings: Settings) -> np.ndarray:
    """log of the chance of each symbol after each, in ordinary text, times the size of the alphabet; last row: at the start."""
    alphabet = ENCODINGS[name]
    a = len(alphabet)
    pairs = np.array([[total.get(x + y, 0) for y in alphabet] for x in alphabet], dtype=float)
    after = (pairs + settings.prior * shares) / (pairs.sum(axis=1, keepdims=True) + settings.prior)
    return np.log(((1 - settings.flat) * np.vstack([after, shares]) + settings.flat / a) * a)


def surprise(values: np.ndarray, table: np.ndarray) -> float:
    """Chance, at most, that ordinary text is so much less likely than equally likely symbols are: the likelihood ratio
    has mean 1 in ordinary text, so it exceeds t with a chance of 1 / t at most."""
    before = np.concatenate([[len(table) - 1], values[:-1]])
    return math.exp(min(0.0, float(table[before, values].sum())))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    out = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCANNED = (
    "doc_id bigint, base array<struct<start:bigint,kind:int,end:bigint>>, "
    "tokens array<struct<start:bigint,end:bigint,encoding:string,chi:double,p:double,token:string>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_TESTED = pa.list_(
    pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("chi", pa.float64()), ("p", pa.float64())]
        + [("token", pa.string())]
    )
)


def tested(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Tokens and parts between separators, each token before its parts, with an encoding and touching no fixed span;
    their statistic and the battery's least p-value."""
    out = []
    for m in _TOKEN.finditer(text):
        spans = [m.span()]
        spans += [x for x in (p.span() for p in _PART.finditer(text, *m.span())) if x != m.span()]
        for start, end in spans:
            token = text[start:end]
            name = encoding(token)
            if name is None or any(a < end and start < b for a, _, b in base):
                continue
            places = _PLACES[name]
            values = np.fromiter((places[c] for c in token), dtype=np.int64, count=len(token))
            chi, *ps = battery(values, len(places))
            # three tests of one token: the least p-value of three
            p = min(1.0, 3 * min(ps))
            out.append({"start": start, "end": end, "encoding": name, "chi": chi, "p": p, "token": token})
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, tokens = [], []
        for text in batch.column(1):
            value = text.as_py() or ""
            spans = base_spans(value)
            base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
            tokens.append(tested(value, spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(base, _SPAN), pa.array(tokens, _TESTED)],
            names=["doc_id", "base", "tokens"],
        )


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of symbols and of pairs of them side by side."""
    size = len(SYMBOLS) + 1
    number = np.full(256, size - 1, dtype=np.int64)
    number[[ord(c) for c in SYMBOLS]] = np.arange(size - 1)
    single, double = np.zeros(size, dtype=np.int64), np.zeros(size * size, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0):
            data = text.as_buffer()
            if data is not None:
                found = number[np.frombuffer(data, dtype=np.uint8)]
                single += np.bincount(found, minlength=size)
                double += np.bincount(found[:-1] * size + found[1:], minlength=size * size)
    counts = {c: int(single[k]) for k, c in enumerate(SYMBOLS)}
    for k in np.flatnonzero(double).tolist():
        x, y = divmod(k, size)
        if max(x, y) < size - 1:
            counts[SYMBOLS[x] + SYMBOLS[y]] = int(double[k])
    yield pa.RecordBatch.from_pydict(
        {"symbol": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
    )


def _bin(p: float, settings: Settings) -> int:
    return min(settings.bins - 1, int(-math.log10(max(p, 1e-300)) / settings.step))


def _length_class(n: int, settings: Settings) -> int:
    return sum(n >= x for x in settings.lengths) - 1


def _judge(shares: dict[str, np.ndarray], tables: dict[str, np.ndarray], settings: Settings):
    """Encoding, class of lengths and bin of the p-value of each token that passes the battery or not."""

    def of(token: dict) -> tuple[str, int, int]:
        n = token["end"] - token["start"]
        places = _PLACES[token["encoding"]]
        values = np.fromiter((places[c] for c in token["token"]), dtype=np.int64, count=n)
        # two statistics of one token: the lesser p-value of two
        p = min(1.0, 2 * min(ordinary(token["chi"], n, shares[token["encoding"]]), surprise(values, tables[token["encoding"]])))
        if token["p"] < settings.level:
            p = 1.0
        return token["encoding"], _length_class(n, settings), _bin(p, settings)

    return of


def _histogram(judge):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(judge(t) for tokens in batch.column(0).to_pylist() for t in tokens)
            rows = list(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int32()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["encoding", "length", "bin", "n"],
            )

    return run


def cuts(counts: dict[tuple[str, int], dict[int, int]], settings: Settings) -> dict[tuple[str, int], int]:
    """Benjamini-Hochberg by bins: for each class the least bin whose upper p-value, times all tokens, is at most ``rate`` of the
    tokens in it or beyond."""
    out = {}
    for key, bins in counts.items():
        every, beyond, cut = sum(bins.values()), 0, settings.bins
        for b in sorted(bins, reverse=True):
            beyond += bins[b]
            if 10 ** (-b * settings.step) * every <= settings.rate * beyond:
                cut = b
        out[key] = cut
    return out


RESULT = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string"
)


def _result(judge, found: dict[tuple[str, int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for base, tokens in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = [(s["start"], s["kind"], s["end"]) for s in base]
                more, upto = [], 0
                for t in tokens:
                    if t["start"] < upto:
                        continue
                    name, length, b = judge(t)
                    if b >= found[name, length]:
                        upto = t["end"]
                        more.append((t["start"], 3, t["end"]))
                kinds = Counter(k for _, k, _ in spans)
                values = [kinds[0], kinds[1], kinds[2], len(more), hashlib.sha256(written(spans).encode()).hexdigest()]
                for column, value in zip(columns, [*values, written(sorted(spans + more))], strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    return run


def find_secrets(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Numbers and places of secrets for every row of ``docs`` (doc_id, text; others are ignored).

    Spans are kind:start:end in code points, end exclusive, by start and then kind; base_sha256 is that of the
    spans of the fixed patterns. Tokens and parts of tokens that touch a fixed span get none of their own, nor do
    the parts of a token that is found. Null and empty texts have no
    spans; rows stay apart even if they repeat. An empty table gives an empty result.
    """
    settings = settings or Settings()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = stored(source.mapInArrow(_scan, SCANNED), "secrets")
    symbols = source.select("text").mapInArrow(_symbols, "symbol string, n bigint")
    total = {r["symbol"]: r["n"] for r in symbols.groupBy("symbol").agg(F.sum("n").alias("n")).collect()}
    shares = {}
    for name, alphabet in ENCODINGS.items():
        n = np.array([total.get(c, 0) + 1.0 for c in alphabet])
        shares[name] = n / n.sum()
    tables = {name: likelier(total, name, shares[name], settings) for name in ENCODINGS}
    judge = _judge(shares, tables, settings)
    bins = (
        scanned.where(F.size("tokens") > 0)
        .select("tokens")
        .mapInArrow(_histogram(judge), "encoding string, length int, bin int, n bigint")
        .groupBy("encoding", "length", "bin")
        .agg(F.sum("n").alias("n"))
        .collect()  # encodings x classes of lengths x bins at most
    )
    counts: dict[tuple[str, int], dict[int, int]] = {}
    for r in bins:
        counts.setdefault((r["encoding"], r["length"]), {})[r["bin"]] = r["n"]
    return scanned.mapInArrow(_result(judge, cuts(counts, settings)), RESULT)
