"""Insert-or-replace by key: the last row of a key wins, rows of other keys stay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``, which must rank the rows of a key totally.

    Spark limits each key to one row before the shuffle as well as after it (WindowGroupLimit),
    so a key with very many versions moves one row per input partition.
    """
    newest_first = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") == 1).drop("_rank")
    )


def replaced(existing: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose key the batch does not have."""
    return existing.join(batch.select(*key).distinct(), list(key), "left_anti").select(*existing.columns)


def upsert_latest_by_key(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Replace rows of ``existing`` by the last row of each key in ``batch``.

    ``existing`` holds one row per key. Only the distinct keys of the batch meet it: Spark's size
    check broadcasts them for a small batch, and the existing rows are then not shuffled at all.
    """
    latest = latest_by_key(batch, key, order)
    return replaced(existing, batch, key).unionByName(latest.select(*existing.columns))
