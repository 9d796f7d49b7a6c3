"""Numbers for the rows of an ordered result, without sending them through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

# Rows within a partition, as Spark numbers them: the low 33 bits.
_WITHIN = (1 << 33) - 1


def numbered(frame: DataFrame, name: str = "position") -> DataFrame:
    """``frame`` with the place of each row, from 1, in the order in which the frame delivers its rows.

    A sorted frame is a sequence of ranges, one a partition. Rows are written once with their partition and their
    place in it; the sizes of the partitions, one row each, are summed from the first on; and each row adds the sum before
    its own partition. A column of that name is replaced.
    """
    kept = frame.drop(name)
    part, at = _free(kept.columns, "part"), _free(kept.columns, "at")
    placed = stored(
        kept.select(
            "*",
            F.spark_partition_id().alias(part),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)).alias(at),
        ),
        "ordered-rows",
    )
    sizes = placed.groupBy(F.col(part).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    # one value with an entry a partition
    start_of = starts.agg(F.map_from_entries(F.collect_list(F.struct("p", "start")))).scalar()
    return placed.select(
        *[F.col(f"`{c}`") for c in kept.columns], (F.element_at(start_of, F.col(part)) + F.col(at) + 1).alias(name)
    )


def _free(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"
