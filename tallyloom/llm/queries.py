"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    katz, lines, mixing, nearest, neardup, outliers, owners, pieces, secrets, spelling, substrings, survival, toxicity,
)
from tallyloom.llm.common import stored, table
from tallyloom.llm.oracle import ORACLES  # noqa: F401


def op1_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz(table(spark, sf_dir, "documents"), katz.Settings(order=3, tables=False)).scores


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.sized(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    mixed = mixing.mix(stored(sizes, "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return outliers.quality_rules(docs).drop("lang", "source")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.remove_repeated(docs)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Banding(shingle=3, percent=85, halves=12))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding them gives the text again."""
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces.load(), prove=True)
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "exact")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(table(spark, sf_dir, "documents"), with_text=False)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survival.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return owners.owners(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spellings(spelling.vocabulary(table(spark, sf_dir, "documents"), every=97))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz_score": op1_katz_score,
    "op2_mix_sources": op2_mix_sources,
    "op3_nearest": op3_nearest,
    "op4_toxicity": op4_toxicity,
    "op5_quality_outliers": op5_quality_outliers,
    "op6_line_dedup": op6_line_dedup,
    "op7_secrets": op7_secrets,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
