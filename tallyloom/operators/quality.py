"""Checks of the declared constraints, which Spark does not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.schemas import TABLES


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table; Parquet counts come from file footers."""
    return _stack(
        [
            frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, frame in tables.items()
        ]
    )


def foreign_key_orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, label: str
) -> DataFrame:
    """Rows whose reference is absent from the parent, and rows with no reference at all.

    Child rows are counted per key before the join, so a key that holds a third of them arrives
    as one row per input partition, and the anti-join reuses the aggregate's partitioning.
    """
    counted = child.groupBy(F.col(column).alias("fk")).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(parent_column).alias("fk"))
    missing = counted.join(keys, "fk", "left_anti")
    zero = F.lit(0).cast("bigint")
    return missing.agg(
        F.coalesce(F.sum(F.when(F.col("fk").isNotNull(), F.col("n"))), zero).alias("orphan_rows"),
        F.coalesce(F.sum(F.when(F.col("fk").isNull(), F.col("n"))), zero).alias("null_rows"),
    ).select(F.lit(label).alias("reference"), "orphan_rows", "null_rows")


def fk_orphan_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared reference."""
    return _stack(
        [
            foreign_key_orphans(
                tables[table.name],
                key.column,
                tables[key.parent],
                key.parent_column,
                f"{table.name}.{key.column} -> {key.parent}.{key.parent_column}",
            )
            for table in TABLES.values()
            for key in table.foreign_keys
        ]
    )


def _absent(frame: DataFrame, column: str) -> Column:
    """NULL, or NaN where the type has it."""
    value = F.col(column)
    if isinstance(frame.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def key_and_null_audit(name: str, frame: DataFrame, key: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Violations of a key and of required columns, in one pass over the table."""
    keyed = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    checks = {("unique", ", ".join(key)): F.count_if(keyed) - F.count_distinct(*key)}
    for column in required:
        checks["not null", column] = F.count_if(_absent(frame, column))
    found = frame.agg(
        F.array(
            *[
                F.struct(
                    F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), count.alias("violations")
                )
                for (check, column), count in checks.items()
            ]
        ).alias("found")
    )
    return found.select(F.lit(name).alias("table_name"), F.inline("found"))


def key_null_audit(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Audit every table given. ``keys`` replaces the declared key of a table."""
    keys = keys or {}
    return _stack(
        [
            key_and_null_audit(
                name,
                frame,
                keys.get(name, [TABLES[name].key]),
                [c for c in TABLES[name].required if c in frame.columns],
            )
            for name, frame in tables.items()
        ]
    )
