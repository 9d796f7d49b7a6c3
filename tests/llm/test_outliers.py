"""Counts against plain code, the estimate against numpy, and junk among clean texts."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm.outliers import Settings, chi2_cdf, chi2_quantile, counted, quality_rules, robust_distances
from tallyloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)
    )


def test_query_counts_equal_plain_code(spark, sf_dir, documents):
    rows = QUERIES["op5_quality_outliers"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        want = plain_counts(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [r for r in rows if not r.base_failed and labels.get(r.doc_id) is not None]
    good = [r for r in judged if labels[r.doc_id] == 1]
    bad = [r for r in judged if labels[r.doc_id] == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_native_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = counted(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow(?!Column)|Exchange", plan)


def test_estimate_resists_a_fifth_of_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.multivariate_normal([1.0, -2.0], [[4.0, 1.5], [1.5, 1.0]], 4000)
    bad = rng.normal([30.0, 20.0], 0.5, (1000, 2))
    rows = [("a", float(x), float(y)) for x, y in np.concatenate([good, bad])]
    rows += [("clean", float(x), float(y)) for x, y in good] + [("b", float(i % 5), 0.0) for i in range(60)]
    frame = spark.createDataFrame(rows, "group string, x0 double, x1 double")
    got = robust_distances(frame, 2, Settings(floors=(0.01, 0.01))).collect()
    near, far = (np.array([r.d2 for r in got if r.group == "a" and (r.x0 < 25) == side]) for side in (True, False))
    assert far.min() > chi2_quantile(0.999999, 2)
    assert (near < chi2_quantile(0.9999, 2)).mean() > 0.999
    centred = good - good.mean(axis=0)
    exact = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(np.cov(good.T)), centred)
    clean = np.array([r.d2 for r in got if r.group == "clean"])
    assert np.median(clean) == pytest.approx(np.median(exact), rel=0.1)
    assert 0.95 < (clean < chi2_quantile(0.975, 2)).mean() < 0.99


def plain_distances(x, settings):
    """The estimate of one group, step by step."""
    p, floors = x.shape[1], np.array(settings.floors)
    scale = settings.share / chi2_cdf(chi2_quantile(settings.share, p), p + 2)

    def median(v):
        return np.sort(v, axis=0)[-(-len(v) // 2) - 1]

    def factor(a):
        l = np.zeros((p, p))
        for j in range(p):
            for i in range(j, p):
                left = a[i, j] - l[i, :j] @ l[j, :j]
                l[i, j] = np.sqrt(max(left, floors[i] ** 2)) if i == j else left / l[j, j]
        return l

    def distances(centre, l):
        return (np.linalg.solve(l, (x - centre).T) ** 2).sum(axis=0)

    spread = np.maximum(median(np.abs(x - median(x))) * 1.4826, floors)
    found = []
    for centre, l in ((median(x), np.diag(spread)), (x.mean(axis=0), factor(np.cov(x.T, bias=True)))):
        least = None
        for _ in range(settings.steps):
            bins = np.floor(np.log2(distances(centre, l) + 1e-6) * settings.bins_per_doubling)
            cut = max(b for b in set(bins) if (bins < b).sum() < settings.share * len(x))
            kept = x[bins <= cut]
            centre, l = kept.mean(axis=0), factor(np.cov(kept.T, bias=True) * scale)
            det = 2 * np.log(np.diag(l)).sum()
            if least is not None and det >= least - 1e-9:
                break
            least = det
            found.append((det, centre, l))
    _, centre, l = min(found, key=lambda f: f[0])
    return distances(centre, l)


def test_distances_equal_plain_version(spark):
    rng = np.random.default_rng(8)
    groups = {}
    for g, share in (("a", 0.0), ("b", 0.1), ("c", 0.22)):
        good = rng.multivariate_normal([1.0, 0.0, 3.0], [[2, 0.8, 0], [0.8, 1, 0.3], [0, 0.3, 0.5]], 300)
        bad = rng.normal([9.0, -7.0, 6.0], 0.4, (int(300 * share), 3))
        groups[g] = np.concatenate([good, bad])
    rows = [(g, i, *map(float, v)) for g, x in groups.items() for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "group string, n int, x0 double, x1 double, x2 double")
    settings = Settings(floors=(0.05, 0.05, 0.05))
    got = robust_distances(frame, 3, settings).collect()
    for g, x in groups.items():
        d2 = np.array([r.d2 for r in sorted((r for r in got if r.group == g), key=lambda r: r.n)])
        assert d2 == pytest.approx(plain_distances(x, settings), rel=1e-6, abs=1e-9)
        assert (d2[300:] > chi2_quantile(settings.quantile, 3)).all()


def test_columns_of_any_name_stay(spark, docs):
    names = ["m0", "x0", "y0", "l0_0", "bin", "part_", "small_", "group", "d2", "n_lines", "cut", "rows_", "a.b"]
    text = " ".join(f"w{i}" for i in range(80))
    frame = docs(*[(i, f"{text} {i}", "en", "s") for i in range(60)]).withColumns({c: F.lit(f"own {c}") for c in names})
    got = quality_rules(frame).collect()
    assert len(got) == 60 and all(r[c] == f"own {c}" for r in got for c in names)


def test_chi_squared():
    assert chi2_quantile(0.95, 1) == pytest.approx(3.841459, abs=1e-5)
    assert chi2_quantile(0.975, 7) == pytest.approx(16.01276, abs=1e-4)
    assert chi2_cdf(0, 3) == 0


def test_junk_goes_and_odd_rows(spark, docs):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("tion", "the", "er", "an") for b in ("re", "on", "at", "ing", "s")]
    rows = []
    for i in range(240):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(60, 300)))
        if i % 12 == 0:
            text = " ".join(f"{w}&&&%%%" for w in text.split())
        rows.append((i, text, "en", ["a", "b", None][i % 3]))
    rows += [(900, None), (901, ""), (902, "\n \n"), (903, "w " * 200_000), (None, rows[1][1], None, None), (1, rows[1][1], "en", "b")]
    frame = docs(*rows).withColumns({"GROUP": F.lit(1), "kept": F.lit("x"), "words_": F.lit(2)})
    got = quality_rules(frame).collect()
    assert len(got) == len(rows)
    assert [(r.n_words, r.kept) for r in got if r.doc_id in (900, 901, 902)] == [(0, False)] * 3
    by = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id < 240}
    assert not any(by[i].kept for i in range(0, 240, 12) if not by[i].base_failed)
    assert all(by[i].kept for i in range(240) if i % 12 and not by[i].base_failed)
    assert [r.kept for r in got if r.doc_id is None] == [True]
    assert next(r for r in got if r.doc_id == 903).n_repeat_words == 200_000
    assert quality_rules(frame.limit(0)).count() == 0
