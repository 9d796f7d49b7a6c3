"""Nearest neighbours by inner product through a block matrix join.

Vectors are packed into tiles with an int8 form. The product of two int8 tiles gives every inner product up to a
bound; pairs whose upper bound reaches the k-th best lower bound are computed again in double precision, and
each query keeps its k best in order. Every query meets every candidate, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stored


@dataclass(frozen=True)
class Settings:
    """``k``: neighbours. ``tile``: vectors of a tile. ``stripe``: candidate tiles that a task holds, about."""

    k: int = 20
    tile: int = 1024
    stripe: int = 32


TILE = "tile bigint, dims int, ids binary, vectors binary, small binary, scale binary, norm binary, error binary"
_TILE = pa.schema(
    [("tile", pa.int64()), ("dims", pa.int32())]
    + [(c, pa.binary()) for c in ("ids", "vectors", "small", "scale", "norm", "error")]
)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 form of each row, its scale, and upper bounds of the norms of the form and of what it leaves out."""
    scale = np.abs(x).max(axis=1) / 127
    small = np.rint(x / scale[:, None])
    form = small * scale[:, None]
    grow = 1 + 1e-9
    return (
        small.astype(np.int8),
        scale,
        np.sqrt((form**2).sum(axis=1)) * grow,
        np.sqrt(((x - form) ** 2).sum(axis=1)) * grow + 1e-12 * np.abs(x).max(axis=1),
    )


def _pack(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            ids = batch.column(0).to_numpy()
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            length = np.diff(offsets)
            for dims in np.unique(length).tolist():
                rows = np.flatnonzero(length == dims)
                for at in range(0, len(rows), settings.tile):
                    part = rows[at : at + settings.tile]
                    x = values[offsets[part][:, None] + np.arange(dims)]
                    small, scale, norm, error = quantised(x)
                    columns = [ids[part], x, small, scale, norm, error]
                    yield pa.RecordBatch.from_pydict(
                        {"tile": [number], "dims": [dims]}
                        | {n: [c.tobytes()] for n, c in zip(_TILE.names[2:], columns, strict=True)},
                        schema=_TILE,
                    )
                    number += 1

    return run


class _Tile:
    def __init__(self, row: dict):
        self.number, self.dims = row["tile"], row["dims"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        shape = (len(self.ids), self.dims)
        self.vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(shape)
        exact = np.float32 if self.dims * 127 * 127 < 1 << 24 else np.float64
        self.small = np.frombuffer(row["small"], dtype=np.int8).reshape(shape).astype(exact)
        self.scale, self.norm, self.error = (
            np.frombuffer(row[c], dtype=np.float64) for c in ("scale", "norm", "error")
        )


class _Best:
    """The k best (score, id) of each query of a tile so far, best first; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(query)
        q = np.concatenate([np.repeat(touched, self.k), query])
        s = np.concatenate([self.score[touched].ravel(), score])
        i = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < self.k
        self.score[q[kept], rank[kept]] = s[kept]
        self.ids[q[kept], rank[kept]] = i[kept]


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first component to the last."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out += x[:, d] * y[:, d]
    return out


def meet(best: _Best, queries: _Tile, candidates: _Tile, rows: slice) -> None:
    """Add the candidates that can be among the k best of some queries."""
    k = best.k
    product = (queries.small[rows] @ candidates.small.T).astype(np.float64)
    product *= queries.scale[rows, None] * candidates.scale[None, :]
    # |<x, y> - <x', y'>| <= |x - x'| |y| + |x'| |y - y'| with |y| <= |y'| + |y - y'|
    slack = queries.error[rows, None] * (candidates.norm + candidates.error)[None, :]
    slack += queries.norm[rows, None] * candidates.error[None, :]
    own = queries.ids[rows, None] == candidates.ids[None, :]
    with np.errstate(invalid="ignore"):
        low, high = product - slack, product + slack
    low[~np.isfinite(low)], high[~np.isfinite(high)] = -np.inf, np.inf
    low[own] = high[own] = -np.inf
    least = best.score[rows, k - 1].copy()
    if low.shape[1] > k:
        least = np.maximum(least, np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k])
    q, c = np.nonzero((high >= least[:, None]) & ~own)
    if len(q):
        q = q + rows.start
        best.add(q, inner_products(queries.vectors[q], candidates.vectors[c]), candidates.ids[c])


FOUND = "tile bigint, place int, query_id bigint, vec_id bigint, score double"


def _search(settings: Settings):
    def run(key, left, right):
        tiles = [_Tile(r) for r in left.to_pylist()]
        best = [_Best(len(t.ids), settings.k) for t in tiles]
        for row in right.to_batches(max_chunksize=1):
            for r in row.to_pylist():
                candidates = _Tile(r)
                for t, b in zip(tiles, best, strict=True):
                    if t.dims == candidates.dims:
                        for at in range(0, len(t.ids), 128):
                            meet(b, t, candidates, slice(at, min(at + 128, len(t.ids))))
        columns: list[list] = [[], [], [], [], []]
        for t, b in zip(tiles, best, strict=True):
            q, r = np.nonzero(b.score > -np.inf)
            for out, values in zip(
                columns, (np.full(len(q), t.number), q, t.ids[q], b.ids[q, r], b.score[q, r]), strict=True
            ):
                out.append(values)
        kinds = [np.int64, np.int32, np.int64, np.int64, np.float64]
        names = ["tile", "place", "query_id", "vec_id", "score"]
        return pa.table(
            {n: pa.array((np.concatenate(c) if c else np.zeros(0)).astype(t)) for n, c, t in zip(names, columns, kinds, strict=True)}
        )

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows with an id and a vector that is neither null, empty nor zero and has only finite components."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(e, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & ~bad & some).select(
        F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")
    )


def nearest(vectors: DataFrame, is_query: Column, settings: Settings | None = None) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows of greatest inner product for each row that ``is_query`` picks.

    ``is_query`` is a condition on vec_id. All usable rows of the query's length are candidates but those with its
    own vec_id; a query without any has no rows. Ties go to the smaller vec_id. Each repeated query row has a result
    of its own. An empty table gives an empty result.
    """
    settings = settings or Settings()
    rows = usable(vectors)
    tiles = stored(rows.mapInArrow(_pack(settings), TILE), "tiles")
    asked = stored(rows.where(is_query).mapInArrow(_pack(settings), TILE), "query-tiles")
    groups = max(1, asked.count())
    stripes = max(1, -(-tiles.count() // settings.stripe))
    # a query tile goes to every stripe of candidates, and a candidate tile to every group of query tiles
    left = asked.withColumn("at", F.pmod(F.xxhash64("tile"), F.lit(groups))).withColumn(
        "stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stripes - 1).cast("long")))
    )
    right = tiles.withColumn("stripe", F.pmod(F.xxhash64("tile"), F.lit(stripes))).withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    )
    found = left.groupBy("at", "stripe").cogroup(right.groupBy("at", "stripe")).applyInArrow(_search(settings), FOUND)
    order = Window.partitionBy("query_id", "tile", "place").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= settings.k)
        .select("query_id", "rank", "vec_id", "score")
    )
