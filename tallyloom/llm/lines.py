"""Removal of repeated passages of lines.

A rolling hash over the hashes of the last lines decides where chunks begin: at the least of every few neighbouring
values, so boundaries move with the text and depend on nothing but the lines beside them. Of equal chunks in the whole
table the first stays. Neighbouring chunks that repeat the same place of a text are one run; a run's bytes are compared with
those of that place, then it grows line by line to both sides while the lines agree, so that the ends of a passage, which no
whole chunk covers, go as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fresh, stored

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
# Parts to which the runs that repeat one place of a text are dealt.
_PARTS = 256


@dataclass(frozen=True)
class Chunking:
    """``window``: lines in the rolling hash. ``spread``: of so many neighbouring hashes the least begins a chunk.
    ``least_lines``: lines with a word that a chunk has at least. ``reach``: lines by which a run grows at most on either
    side. As they stand, every passage of three lines with a word holds a whole chunk wherever it stands; a passage of two
    does if its first line begins one at both places."""

    window: int = 2
    spread: int = 2
    least_lines: int = 2
    reach: int = 4


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little")


def _rolling(hashes: list[int], window: int) -> list[int]:
    """Hash of every ``window`` neighbours, or of all, if they are fewer; mixed, so that their order is random."""
    window = min(window, len(hashes))
    out_of_window, rolling, out = pow(_BASE, window, 1 << 64), 0, []
    for i, h in enumerate(hashes):
        rolling = (rolling * _BASE + h) & _MASK
        if i >= window:
            rolling = (rolling - hashes[i - window] * out_of_window) & _MASK
        if i >= window - 1:
            out.append((rolling ^ (rolling >> 29)) * 0xBF58476D1CE4E5B9 & _MASK)
    return out


def chunks(lines: list[bytes], chunking: Chunking) -> list[tuple[int, int]]:
    """Line ranges of the chunks, in order: from a line with a word to a line with a word. Chunks that would have too few
    such lines take the next ones along, so that neighbours may overlap."""
    worded = [i for i, x in enumerate(lines) if x.strip()]
    if len(worded) < chunking.least_lines:
        return []
    rolling = _rolling([line_hash(lines[i]) for i in worded], chunking.window)
    spread = min(chunking.spread, len(rolling))
    begins = sorted({min(range(i, i + spread), key=lambda k: (rolling[k], -k)) for i in range(len(rolling) - spread + 1)})
    out = []
    for begin, following in zip(begins, [*begins[1:], len(worded)], strict=True):
        end = max(min(following, begin + chunking.spread), begin + chunking.least_lines)
        if end <= len(worded):
            out.append((worded[begin], worded[end - 1] + 1))
    return out


def _chunk_rows(chunking: Chunking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, sig, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                lines = (text or "").encode().split(b"\n")
                for a, b in chunks(lines, chunking):
                    key = hashlib.blake2b(b"\n".join(lines[a:b]), digest_size=16).digest()
                    rows.append((doc, sig, a, b, key))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], types[k]) for k in range(5)], names=["doc", "sig", "a", "b", "key"]
            )

    return run, "doc bigint, sig bigint, a bigint, b bigint, key binary"


def runs(found: list[dict]) -> list[dict]:
    """Chunks (a, b) that repeat a text (of_doc, of_sig) from line of_a on, those that touch and repeat it in step as one."""
    out: list[dict] = []
    for r in sorted(found, key=lambda r: (r["of_doc"] is None, r["of_doc"], r["of_sig"], r["a"] - r["of_a"], r["a"])):
        last = out[-1] if out else None
        same = last and all(last[c] == r[c] for c in ("of_doc", "of_sig")) and last["a"] - last["of_a"] == r["a"] - r["of_a"]
        if same and r["a"] <= last["b"]:
            last["b"] = max(last["b"], r["b"])
        else:
            out.append(dict(r))
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each text, without its bytes."""
    names = ["a", "b", "of_doc", "of_sig", "of_a"]
    for batch in batches:
        for doc, sig, found in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            rows = runs(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(rows), pa.int64()) for x in (doc, sig)]
                + [pa.array([r[c] for r in rows], pa.int64()) for c in names],
                names=["doc", "sig", *names],
            )


_LINES = pa.list_(pa.large_binary())
PLACES = "doc bigint, sig bigint, a bigint, b bigint, of_doc bigint, of_sig bigint, of_a bigint"
BYTES = f"{PLACES}, parts array<bigint>, before array<binary>, body binary, after array<binary>"


def _bytes_rows(chunking: Chunking):
    """Bytes of line ranges, and the lines on either side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, sigs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, sig, text, found in zip(docs, sigs, batch.column(2), batch.column(3), strict=True):
                lines = text.as_py().encode().split(b"\n")
                spans = found.as_py()
                ends = [(r["a"], r["b"]) for r in spans]
                n = len(spans)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * n, pa.int64()), pa.array([sig] * n, pa.int64())]
                    + [pa.array([r[c] for r in spans], pa.int64()) for c in ("a", "b", "of_doc", "of_sig", "of_a")]
                    + [
                        pa.array([r["parts"] for r in spans], pa.list_(pa.int64())),
                        pa.array([lines[max(0, a - chunking.reach) : a] for a, _ in ends], _LINES),
                        pa.array([b"\n".join(lines[a:b]) for a, b in ends], pa.large_binary()),
                        pa.array([lines[b : b + chunking.reach] for _, b in ends], _LINES),
                    ],
                    names=["doc", "sig", "a", "b", "of_doc", "of_sig", "of_a", "parts", "before", "body", "after"],
                )

    return run


def agreeing(a: list[bytes], b: list[bytes]) -> int:
    """Leading lines in which both agree, up to the last that has a word."""
    n = 0
    for k, (x, y) in enumerate(zip(a, b, strict=False), 1):
        if x != y:
            break
        if x.strip():
            n = k
    return n


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs with the lines that agree on either side."""
    for batch in batches:
        a, b = [], []
        for r in batch.select(["a", "b", "before", "after", "of_before", "of_after"]).to_pylist():
            a.append(r["a"] - agreeing(r["before"][::-1], r["of_before"][::-1]))
            b.append(r["b"] + agreeing(r["after"], r["of_after"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("sig"), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            names=["doc", "sig", "a", "b"],
        )


def _without(made: list[str]):
    """The texts without their ranges; ``made`` names the columns that are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, removed = [], [], []
            for text, gone in zip(batch.column(0), batch.column(1), strict=True):
                value, found = text.as_py(), gone.as_py()
                lines = (value or "").encode().split(b"\n")
                total.append(0 if value is None else len(lines))
                if not found:
                    texts.append(value)
                    removed.append(0)
                    continue
                left, end = [], 0
                for r in sorted(found, key=lambda r: r["a"]):
                    left += lines[end : r["a"]]
                    end = max(end, r["b"])
                left += lines[end:]
                texts.append(b"\n".join(left).decode())
                removed.append(len(lines) - len(left))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                names=[*batch.schema.names[2:], *made],
            )

    return run


def repeated_ranges(docs: DataFrame, chunking: Chunking) -> DataFrame:
    """(doc, sig, ranges): the line ranges to remove from each text, known by its doc_id and the hash of the text.

    Only keys are sent to find the chunks that repeat. The bytes of a run are sent once, and those of the place it repeats
    once for each part of the runs that repeat it, so that no task has all copies of a passage. Hot keys are counted before
    the shuffle and split as skewed joins.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("sig"), F.col("text").cast("string")
    )
    run, schema = _chunk_rows(chunking)
    found = keyed.mapInArrow(run, schema)
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "sig", "a")
    firsts = (
        found.groupBy("key")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("found"))
        .where("found > 1")
        .select("key", "first")
    )
    again = found.join(stored(firsts, "line-keys"), "key").where(~place.eqNullSafe(F.col("first")))
    of = [F.col(f"first.{c}").alias(f"of_{c}") for c in ("doc", "sig", "a")]

    found = again.groupBy("doc", "sig").agg(F.collect_set(F.struct("a", "b", *of)).alias("found"))
    copies = stored(found.mapInArrow(_joined, PLACES), "line-runs")
    part = F.pmod(F.xxhash64("doc", "sig", "a"), F.lit(_PARTS)).alias("part")
    asked = copies.select(
        F.col("of_doc").alias("doc"), F.col("of_sig").alias("sig"), F.col("of_a").alias("a"),
        (F.col("of_a") + F.col("b") - F.col("a")).alias("b"), part,
    ).distinct()
    asked = asked.groupBy("doc", "sig", "a", "b").agg(F.collect_list("part").alias("parts"))
    none = [F.lit(None).cast("bigint").alias(c) for c in ("of_doc", "of_sig", "of_a")]
    spans = copies.select("*", F.array(part).alias("parts")).unionByName(asked.select("*", *none))
    # one pass over the texts, for the runs and for the places that they repeat
    spans = spans.groupBy(F.col("doc").alias("in_doc"), F.col("sig").alias("in_sig")).agg(
        F.collect_list(F.struct("a", "b", "of_doc", "of_sig", "of_a", "parts")).alias("found")
    )
    held = keyed.join(spans, F.col("doc").eqNullSafe(F.col("in_doc")) & (F.col("sig") == F.col("in_sig")))
    held = stored(held.select("doc", "sig", "text", "found").mapInArrow(_bytes_rows(chunking), BYTES), "line-bytes")
    copies = held.where("of_a IS NOT NULL").withColumn("part", F.col("parts")[0])
    texts = held.where("of_a IS NULL").dropDuplicates(["doc", "sig", "a", "b"])
    dealt = texts.select("doc", "sig", "a", "before", "body", "after", F.explode("parts").alias("part"))
    dealt = dealt.withColumnsRenamed({c: f"of_{c}" for c in dealt.columns})

    equal = F.expr("c.of_doc <=> o.of_doc AND c.of_sig = o.of_sig AND c.of_a = o.of_a AND c.part = o.of_part AND body = of_body")
    met = copies.alias("c").join(dealt.alias("o"), equal)
    met = met.select("doc", "sig", "c.a", "c.b", "before", "after", "of_before", "of_after")
    grown = met.mapInArrow(_grown, "doc bigint, sig bigint, a bigint, b bigint")
    return grown.groupBy("doc", "sig").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))


def remove_repeated(docs: DataFrame, chunking: Chunking | None = None) -> DataFrame:
    """``docs`` (doc_id, text and any others) with repeated passages cut out, plus n_lines and n_removed.

    Lines end at a line feed. First means smallest doc_id (null last), then hash of the text, then
    place. Rows with the same doc_id and text are one text: what stays in one stays in all. A line goes only for an
    equal one at an earlier place, so of every line that goes an equal one stays. Null texts stay null
    with 0 lines, an empty text is one line; single lines and lines without words are never removed on their own. Columns
    named n_lines or n_removed are replaced. An empty table gives an empty result.
    """
    chunking = chunking or Chunking()
    docs = docs.drop("n_lines", "n_removed")
    gone = repeated_ranges(docs, chunking)
    sig, doc, of, found, was = fresh(docs.columns, "sig", "doc", "of", "ranges", "was")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    marked = (
        docs.withColumn(sig, F.xxhash64("text"))
        .join(
            gone.select(F.col("doc").alias(doc), F.col("sig").alias(of), F.col("ranges").alias(found)),
            F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(sig) == F.col(of)),
            "left",
        )
        .select(F.col("text").cast("string").alias(was), F.col(found), *others)
    )
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    text, lines, removed = fresh(docs.columns, "text_left", "lines_had", "lines_gone")
    schema = ", ".join(x for x in (rest, f"{text} string, {lines} bigint, {removed} bigint") if x)
    return marked.mapInArrow(_without([text, lines, removed]), schema).select(
        *[F.col(text).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.col(lines).alias("n_lines"),
        F.col(removed).alias("n_removed"),
    )
