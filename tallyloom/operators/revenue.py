"""Order totals and the monthly revenue series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.dates import month_labels, month_start
from tallyloom.functions.money import double_parts, exact_product_sum


def item_totals(items: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``SUM(quantity * price)`` per order that has items, exact.

    The partial sum before the shuffle reduces an order of any size to one row per input
    partition, so one dominant order does not load one task. Prices in double or float count as their decimal text says.
    """
    kind = items.schema["price"].dataType
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return items.groupBy("order_id", *by).agg(F.sum(F.col("quantity") * F.col("price")).alias("order_total"))
    price = F.col("price") if isinstance(kind, T.DoubleType) else F.col("price").cast("string").cast("double")
    units, rest = double_parts(price)
    parts = items.select("order_id", *by, F.col("quantity").alias("_times"), units.alias("_units"), rest.alias("_rest"))
    total = exact_product_sum(F.col("_units"), F.col("_rest"), F.col("_times"))
    return parts.groupBy("order_id", *by).agg(total.alias("order_total"))


def order_totals(orders: DataFrame, items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Total of every order, zero where it has no items. Both join sides are unique by order."""
    total = F.coalesce("order_total", F.lit(0).cast("decimal(1,0)"))
    return (
        orders.select("order_id", *keep)
        .join(item_totals(items), "order_id", "left")
        .select("order_id", *keep, total.alias("order_total"))
    )


def monthly_revenue(
    orders: DataFrame,
    items: DataFrame,
    by: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """One row per calendar month present: ``total_revenue`` and ``order_count``.

    Items collapse to one row per order before the join, which then meets unique keys on both
    sides, and the count of distinct orders becomes a plain count (``order_id`` is the key of
    ``orders``). ``by`` splits the series on columns of either table; ``where`` filters orders.
    Every order counts, whatever its status.
    """
    if where is not None:
        orders = orders.where(where)
    item_by = [c for c in by if c in items.columns]
    order_by = [c for c in by if c not in item_by]
    dated = orders.select("order_id", month_start(F.col("order_date")).alias("month_start"), *order_by)
    return (
        dated.join(item_totals(items, item_by), "order_id")
        .groupBy(*by, "month_start")
        .agg(
            F.sum("order_total").alias("total_revenue"),
            F.count(F.lit(1)).alias("order_count"),
        )
    )


def monthly_revenue_report(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The series with its month labels, revenue unrounded, in calendar order."""
    return monthly.orderBy(*by, "month_start").select(
        *by,
        *month_labels(F.col("month_start")),
        F.col("total_revenue").cast("double").alias("total_revenue"),
        "order_count",
    )
