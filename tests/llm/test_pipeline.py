"""Every stage of the pipeline held against plain code on its own input."""

from collections import Counter

import corpus_pipeline
from tallyloom.llm import mixing, neardup, pieces
from .test_lines import brute as plain_lines
from .test_neardup import brute as plain_groups


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        rows.append(corpus_pipeline.stored(stage(spark, rows[-1], sf_dir), "test-" + name.split()[0]))
    assert len(corpus_pipeline.STAGES) == 5
    assert all(r.columns == columns for r in rows[:5])
    start, clean, cut, unique, mixed, encoded = rows

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean.collect()}
    assert sum(i in kept for i, t in labels.items() if t == 0) >= 0.97 * sum(t == 0 for t in labels.values())

    want = plain_lines([(r.doc_id, r.text) for r in clean.collect()])
    got = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    left = {d: t for d, (t, n) in want.items() if not n or (t or "").split()}
    assert {d: t for d, (t, _) in got.items()} == left
    assert all(n == len(t) for t, n in got.values())

    groups = plain_groups(left, neardup.Banding().shingle, neardup.Banding().percent)
    assert {r.doc_id for r in unique.collect()} == {d for d, g in groups.items() if g[2]}

    taken = {r.doc_id: r.taken for r in mixing.mix(mixing.sized(unique)).collect()}
    words = Counter()
    whole = {r.doc_id: r.text for r in unique.collect()}
    for r in mixed.collect():
        assert whole[r.doc_id].startswith(r.text)
        words[r.doc_id] += len(r.text.split())
    assert words == {d: n for d, n in taken.items() if n}

    v = pieces.load()
    texts = Counter((r.doc_id, r.text) for r in mixed.collect())
    back = Counter((r.doc_id, r.decoded) for r in pieces.decode(encoded, v).collect())
    assert back == texts


def test_odd_rows_and_empty_table(spark, docs, tmp_path):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "x y z " * 30), (4, "x y z " * 30), (4, "x y z " * 30), (5, "a\nb\nc\nd\ne")]
    docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (None, 0)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {1, 2, 4, 5, None}
    docs(*rows).limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
