"""Payments against order totals, and unmatched rows on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.revenue import order_totals

# Labels and tolerance. A difference of exactly the tolerance is a mismatch.
MATCH = "MATCH"
MISMATCH = "MISMATCH"
TOLERANCE = "0.01"

# Parts a hot order's payments are spread over.
SPREAD = 1024
# Parts the payments of an unknown order are spread over.
ORPHAN_SPREAD = 32


def unpaid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders no payment refers to.

    Payment keys are made distinct first: the map-side step folds an order with very many
    payments to one row per input partition.
    """
    return orders.join(payments.select("order_id").distinct(), "order_id", "left_anti")


def orphan_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments whose order does not exist or is not named.

    Payments fold to one row per order id. The ids that are no order's, usually few, are repeated for each of
    ORPHAN_SPREAD parts and then pick their payments, so that the payments of one id fall to that many
    tasks. Payments that name no order need no join and stay where they are.
    """
    named = payments.where(F.col("order_id").isNotNull())
    ids = named.select("order_id").distinct().join(orders.select("order_id"), "order_id", "left_anti")
    parts = F.explode(F.sequence(F.lit(0), F.lit(ORPHAN_SPREAD - 1)))
    spread = named.withColumn("part", F.pmod(F.hash("payment_id"), F.lit(ORPHAN_SPREAD)))
    found = spread.join(ids.withColumn("part", parts), ["order_id", "part"], "left_semi").select(*payments.columns)
    return found.unionByName(payments.where(F.col("order_id").isNull()))


def _difference() -> Column:
    return F.abs(F.col("order_total") - F.col("payment_amount"))


def _spread() -> Column:
    """Which of the SPREAD parts of its order a payment amount belongs to."""
    return F.pmod(F.hash("payment_amount"), F.lit(SPREAD))


def reconciled(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order and distinct payment amount, one row per unpaid order; exact decimals.

    Items are summed per order before payments join, so an order with several payments keeps its
    true total. Equal payments of an order fold into one row; payments of unknown amount are one more amount, a mismatch.

    Payments fold to their least and greatest amount per order; where the two agree, as for nearly
    all orders, the row is finished. Orders with several amounts may have a large share of all
    payments: these are joined on the order and one of SPREAD parts, and the order row is
    repeated only for parts that occur, at most SPREAD times.
    """
    keep = ["order_date", "status"]
    amounts = payments.select("order_id", F.col("amount").alias("payment_amount"))
    ends = amounts.groupBy("order_id").agg(
        F.min("payment_amount").alias("least"),
        F.max("payment_amount").alias("most"),
        F.bool_or(F.col("payment_amount").isNull()).alias("unknown"),
    )
    several = (F.col("least") < F.col("most")) | (F.col("unknown") & F.col("least").isNotNull())
    totals = order_totals(orders, items, keep).join(ends, "order_id", "left")
    settled = totals.where(several.isNull() | ~several).select(
        "order_id", *keep, "order_total", F.col("least").alias("payment_amount")
    )
    # Payments are the left side, which AQE can split.
    mixed = amounts.join(ends.where(several).select("order_id"), "order_id", "left_semi")
    mixed = mixed.withColumn("part", _spread()).distinct()
    sides = totals.where(several).select("order_id", *keep, "order_total")
    sides = sides.join(mixed.select("order_id", "part").distinct(), "order_id")
    spread = sides.join(mixed, ["order_id", "part"]).select("order_id", *keep, "order_total", "payment_amount")
    matched = _difference() < F.lit(TOLERANCE).cast("decimal(3,2)")
    return settled.unionByName(spread).select(
        "order_id",
        *keep,
        "order_total",
        "payment_amount",
        F.when(matched, MATCH).otherwise(MISMATCH).alias("status_check"),
        _difference().alias("difference"),
    )


def _report(rows: DataFrame) -> DataFrame:
    return rows.select(
        "order_id",
        "order_date",
        "status",
        F.col("order_total").cast("double").alias("order_total"),
        F.col("payment_amount").cast("double").alias("payment_amount"),
        "status_check",
        F.col("difference").cast("double").alias("difference"),
    )


def payment_reconciliation(
    orders: DataFrame, items: DataFrame, payments: DataFrame, ordered: bool = False
) -> DataFrame:
    """The reconciliation report.

    ``ordered`` adds the range shuffle that a sorted listing needs. The amount is part of the order
    so that the rows of one order may fall into several ranges.
    """
    rows = _report(reconciled(orders, items, payments))
    return rows.orderBy("order_id", "payment_amount") if ordered else rows


def mismatches(rows: DataFrame) -> DataFrame:
    """Mismatching rows of the report, for display: an absent total or amount shows as zero."""
    return rows.where(F.col("status_check") == MISMATCH).select(
        "order_id",
        F.coalesce("order_total", F.lit(0.0)).alias("order_total"),
        F.coalesce("payment_amount", F.lit(0.0)).alias("payment_amount"),
        "difference",
    )


def payment_mismatches(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    return mismatches(payment_reconciliation(orders, items, payments))


def outcome_counts(rows: DataFrame) -> DataFrame:
    """Row counts by outcome with percentages at one place, NULL for no rows."""
    matched = F.col("status_check") == MATCH
    counts = rows.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(matched).alias("matching"),
        F.count_if(~matched).alias("mismatching"),
    )

    def share(name: str) -> Column:
        ratio = F.col(name).cast("double") / F.nullif("total_orders", F.lit(0).cast("bigint")) * 100
        return F.round(ratio, 1)

    return counts.select(
        "*",
        share("matching").alias("matching_percent"),
        share("mismatching").alias("mismatching_percent"),
    )


def reconciliation_summary(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    return outcome_counts(reconciled(orders, items, payments))


def orders_without_payments(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Unpaid orders with their totals."""
    unpaid = order_totals(unpaid_orders(orders, payments), items)
    return unpaid.select("order_id", F.col("order_total").cast("double").alias("order_total"))


def payments_without_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return orphan_payments(orders, payments).select(
        "payment_id", "order_id", F.col("amount").cast("double").alias("amount")
    )


def unmatched_counts(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """How many rows each side leaves unmatched.

    Payments are counted per order first, so one full join of unique keys answers both sides.
    """
    paid = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("paid"))
    known = orders.select("order_id", F.lit(True).alias("known"))
    counts = known.join(paid, "order_id", "full").agg(
        F.count_if(F.col("paid").isNull()).alias("unpaid"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("paid"))), F.lit(0).cast("bigint")).alias("orphans"),
    )

    def side(name: str, count: str) -> Column:
        return F.struct(F.lit(name).alias("side"), F.col(count).alias("unmatched"))

    return counts.select(
        F.inline(F.array(side("orders without payments", "unpaid"), side("payments without orders", "orphans")))
    )
