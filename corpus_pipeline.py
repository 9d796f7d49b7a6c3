"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

Toxic documents go, repeated line chunks are cut, one document of each near-duplicate group stays, sources are mixed to
target weights, and the texts are encoded to pieces and decoded again. Every stage but the last returns the columns of
``documents``. Null texts and ids, repeated rows and an empty table pass as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import lines, mixing, neardup, pieces, toxicity
from tallyloom.llm.common import WORD, fresh, stored, table


# Bytes of rows that go to a Python worker at once. With Spark's 64 MB a task's whole split is one batch, which the executor and the worker
# hold several times over, outside the heap; what that leaves in their allocators is still there in later stages.
BATCH_BYTES = "2m"


def _in_portions(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage whose rows go to Python by ``BATCH_BYTES``. The setting stays with the session, as the stage's frame is computed later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


def _apart(docs: DataFrame, names: list[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stage over documents whose columns of these names are called otherwise meanwhile."""
    clash = [c for c in docs.columns if c.lower() in names]
    renamed = dict(zip(clash, fresh([*docs.columns, *names], *clash), strict=True))
    return stage(docs.withColumnsRenamed(renamed)).withColumnsRenamed({b: a for a, b in renamed.items()})


@_in_portions
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score stays below one half."""
    model = toxicity.train(toxicity.training_rows(docs), table(spark, sf_dir, "labels"))

    def stage(docs: DataFrame) -> DataFrame:
        return toxicity.score(docs, model, docs.columns).where("score < 0.5").select(*docs.columns)

    return _apart(docs, ["score"], stage)


@_in_portions
def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated line chunks; documents that consist of nothing else go."""
    cut = lines.remove_repeated(docs)
    left = cut.where((F.col("n_removed") == 0) | F.regexp_like("text", F.lit(WORD)))
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, n_chars).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


@_in_portions
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle similarity 0.8 or more, and one of rows that repeat id and text."""
    return neardup.unique_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last block of a shard may cut one."""
    return _apart(docs, ["size", "source_size", "target", "taken", "part"], mixing.mixed_documents)


@_in_portions
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the piece ids, and whether decoding them gives the text again."""
    return pieces.encode(docs, pieces.load(), prove=True).select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_pieces"), "ids", "exact"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# A trained classifier and best-path encoding have no SQL form; tests hold each stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}-{name.split()[0].lower()}")
    return docs
