"""Nearest neighbours against brute force, and the bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm.nearest import Settings, inner_products, nearest, quantised
from tallyloom.llm.queries import QUERIES


def brute(rows, every, k):
    out = {}
    for q, x in rows:
        if q % every == 0:
            scores = [(-float(inner_products(np.array([x]), np.array([y]))[0]), v) for v, y in rows if v != q and len(y) == len(x)]
            out[q] = [(v, -s) for s, v in sorted(scores)[:k]]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(QUERIES["op3_nearest"](spark, sf_dir)) == brute(rows, 20, 20)


def test_ties_lengths_and_tiles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(90)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(200 + i, rng.normal(size=3).tolist()) for i in range(4)]
    rows += [(300, [1e200, -1e200, 0.0, 1.0, 0.0, 0.0]), (301, [1e-200] * 6)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    for settings in (Settings(k=7, tile=9, stripe=2), Settings(k=20)):
        assert found(nearest(frame, F.col("vec_id") % 5 == 0, settings)) == brute(rows, 5, settings.k)


def test_bounds():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 16)) ** 3, rng.normal(size=(60, 16))
    (a, s, n, e), (b, t, m, f) = quantised(x), quantised(y)
    close = (a.astype(float) @ b.T.astype(float)) * s[:, None] * t[None]
    assert (np.abs(close - x @ y.T) <= e[:, None] * (m + f)[None] + n[:, None] * f[None]).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (None, [9.0, 9.0]), (20, [1.0, 1.0]), (20, [1.0, 1.0]), (21, [1.0, 1.0]), (40, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns(
        {"tile": F.lit(1), "SCORE": F.lit("x")}
    )
    got = nearest(frame, F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(by) == [0, 20]
    assert sorted(by[0]) == [(1, 20, 3.0), (2, 20, 3.0), (3, 21, 3.0)]
    assert sorted(by[20]) == [(1, 0, 3.0)] * 2 + [(2, 21, 2.0)] * 2
    assert nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert pytest.approx(inner_products(np.ones((1, 3)), np.ones((1, 3)))[0]) == 3
