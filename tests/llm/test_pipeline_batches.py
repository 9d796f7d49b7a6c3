"""Rows go to Python workers by portions, and the portions change no result."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def default_batches(spark):
    before = spark.conf.get(SETTING)
    yield before
    spark.conf.set(SETTING, before)


def test_a_batch_is_a_portion_of_a_split(spark, docs, default_batches, monkeypatch):
    frame = docs(*[(d, f"{d} " + "some words of a text " * 2500) for d in range(200)]).coalesce(1)
    seen = []

    def encode(rows, *_, **__):
        def sizes(batches):
            for batch in batches:
                yield batch.select([0]).rename_columns(["n"]).slice(0, 1)

        seen.append(rows.mapInArrow(sizes, "n bigint").count())
        return rows.withColumns({"ids": F.array(), "exact": F.lit(True)})

    monkeypatch.setattr(corpus_pipeline.pieces, "encode", encode)
    corpus_pipeline.encode_pieces(spark, frame, "")
    assert seen[0] >= 4


def test_portions_change_nothing(spark, docs, tmp_path, default_batches, monkeypatch):
    line = "line {} of the passage that is in several texts\n"
    passage = "".join(line.format(k) for k in range(6))
    rows = [(d, f"text {d} begins\n" + " ".join(f"w{d * k % 97}" for k in range(80)) + "\n", "en", "ab"[d % 2]) for d in range(40)]
    rows += [(100 + d, r[1] + passage, "en", "a") for d, r in enumerate(rows[:20])] + [(200, None), (201, ""), (None, "x y z " * 30)]
    docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(d % 7 == 0)) for d in range(40)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {}
    for size in ("1k", "64m"):
        monkeypatch.setattr(corpus_pipeline, "BATCH_BYTES", size)
        got[size] = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))
        assert spark.conf.get(SETTING) in (size, f"{1024 if size == '1k' else 64 << 20}b")
    assert got["1k"] == got["64m"]
    assert got["1k"]
