"""Reconciliation on hand-written payments, and a hot order against brute force."""

from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import reconcile, report

ORDERS = [(n, "2020-01-05", "shipped") for n in range(1, 9)]
ITEMS = [
    (1, 1, 2, "10.00"),
    (2, 1, 1, "10.00"),
    (3, 1, 1, "10.00"),
    (4, 1, 1, "10.00"),
    (5, 1, 1, "5.00"),
    (5, 2, 3, "1.00"),
    (6, 1, 1, "10.00"),
]
PAYMENTS = [
    (1, "20.00"),  # exact
    (2, "10.01"),  # one cent over: a mismatch
    (3, "10.00"),
    (3, "10.00"),  # posted twice
    (4, "10.00"),
    (4, "2.50"),  # and a different one
    (7, "5.00"),  # order 7 has no items
    (99, "1.00"),  # no such order
    (99, "2.00"),
]


def reconciled(sales, payments=PAYMENTS):
    found = rows(reconcile.payment_reconciliation(*sales(ORDERS, ITEMS, payments), ordered=True))
    return {(r["order_id"], r["payment_amount"]): r for r in found}


def test_rows_are_order_and_distinct_amount(sales):
    found = reconciled(sales)
    assert list(found) == sorted(found, key=lambda k: k[0])
    assert set(found) == {
        (1, 20.0), (2, 10.01), (3, 10.0), (4, 10.0), (4, 2.5), (5, None), (6, None), (7, 5.0), (8, None),
    }


def test_outcomes(sales):
    found = reconciled(sales)
    outcome = {key: (r["order_total"], r["status_check"], r["difference"]) for key, r in found.items()}
    assert outcome[(1, 20.0)] == (20.0, "MATCH", 0.0)
    assert outcome[(2, 10.01)] == (10.0, "MISMATCH", 0.01)
    # Equal payments do not inflate the order total.
    assert outcome[(3, 10.0)] == (10.0, "MATCH", 0.0)
    assert outcome[(4, 2.5)] == (10.0, "MISMATCH", 7.5)
    assert outcome[(5, None)] == (8.0, "MISMATCH", None)
    assert outcome[(7, 5.0)] == (0.0, "MISMATCH", 5.0)
    assert outcome[(8, None)] == (0.0, "MISMATCH", None)


def test_difference_below_the_tolerance_matches(sales):
    orders, items, payments = sales([(1, "2020-01-05", "x")], [(1, 1, 1, "10.00")], [(1, "10.00")])
    close = payments.withColumn("amount", F.lit("10.009").cast("decimal(18,3)"))
    assert rows(reconcile.payment_reconciliation(orders, items, close))[0]["status_check"] == "MATCH"


def test_payments_of_unknown_amount_are_one_more_amount(sales):
    orders, items, payments = sales(
        [(n, "2020-01-05", "x") for n in (1, 2, 3)],
        [(n, 1, 1, "5.00") for n in (1, 2, 3)],
        [(1, "5.00"), (1, "9.99"), (2, "9.99"), (3, "5.00"), (3, "4.00"), (3, "9.99"), (3, "9.99")],
    )
    payments = payments.withColumn("amount", F.when(F.col("amount") != 9.99, F.col("amount")))
    found = rows(reconcile.payment_reconciliation(orders, items, payments))
    assert sorted(((r["order_id"], r["payment_amount"] or 0, r["status_check"], r["difference"]) for r in found), key=str) == [
        (1, 0, "MISMATCH", None), (1, 5.0, "MATCH", 0.0), (2, 0, "MISMATCH", None),
        (3, 0, "MISMATCH", None), (3, 4.0, "MISMATCH", 1.0), (3, 5.0, "MATCH", 0.0),
    ]


def test_summary_adds_up(sales):
    counts = rows(reconcile.reconciliation_summary(*sales(ORDERS, ITEMS, PAYMENTS)))[0]
    assert counts == {
        "total_orders": 9,
        "matching": 3,
        "mismatching": 6,
        "matching_percent": 33.3,
        "mismatching_percent": 66.7,
    }


def test_summary_of_nothing(sales):
    orders, items, payments = sales(ORDERS, ITEMS, PAYMENTS)
    counts = reconcile.reconciliation_summary(orders.where("false"), items, payments)
    assert rows(counts)[0]["matching_percent"] is None
    assert [r["line"] for r in rows(report.formatted_reconciliation_summary(counts))] == [
        "Total Orders: 0",
        "Matching: 0 (N/A)",
        "Mismatching: 0 (N/A)",
    ]


def test_mismatches_show_zero_for_the_absent(sales):
    found = rows(reconcile.payment_mismatches(*sales(ORDERS, ITEMS, PAYMENTS)))
    shown = {r["order_id"]: (r["order_total"], r["payment_amount"], r["difference"]) for r in found}
    assert shown[5] == (8.0, 0.0, None)
    assert len(found) == 6


def test_unmatched_rows_of_both_sides(sales):
    orders, items, payments = sales(ORDERS, ITEMS, PAYMENTS)
    unpaid = rows(reconcile.orders_without_payments(orders, items, payments))
    assert {r["order_id"]: r["order_total"] for r in unpaid} == {5: 8.0, 6: 10.0, 8: 0.0}
    orphans = rows(reconcile.payments_without_orders(orders, payments))
    assert {(r["order_id"], r["amount"]) for r in orphans} == {(99, 1.0), (99, 2.0)}
    counts = {r["side"]: r["unmatched"] for r in rows(reconcile.unmatched_counts(orders, payments))}
    assert counts == {"orders without payments": 3, "payments without orders": 2}


def test_printed_lines(sales):
    found = reconcile.payment_reconciliation(*sales(ORDERS, ITEMS, PAYMENTS))
    lines = {r["order_id"]: r["line"] for r in rows(report.formatted_reconciliation(found))}
    assert lines[1] == f"{1:<10} ${20.0:<14.2f} ${20.0:<14.2f} {'MATCH':<10} ${0.0:<11.2f}"
    assert lines[5] == f"{5:<10} ${8.0:<14.2f} ${0.0:<14.2f} {'MISMATCH':<10} {'N/A':<12}"


def test_hot_order_against_brute_force(spark):
    """A third of all items and payments belong to order 0; all its amounts differ."""
    count = 30_000
    owner = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("bigint")
    base = spark.range(count)
    orders = spark.range(600).select(
        F.col("id").alias("order_id"), F.lit("2020-01-01").cast("date").alias("order_date"), F.lit("x").alias("status")
    )
    items = base.select(
        owner.alias("order_id"), (F.col("id") % 7).cast("int").alias("quantity"),
        F.lit("1.25").cast("decimal(12,2)").alias("price"),
    )
    payments = base.select(
        F.col("id").alias("payment_id"), owner.alias("order_id"), (F.col("id") / 4).cast("decimal(18,2)").alias("amount")
    )
    totals, amounts = {n: Decimal(0) for n in range(600)}, {n: set() for n in range(600)}
    for n in range(count):
        order = 0 if n % 3 == 0 else n % 500
        totals[order] += n % 7 * Decimal("1.25")
        amounts[order].add((Decimal(n) / 4).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP"))
    expected = {
        (order, amount, "MATCH" if amount is not None and abs(totals[order] - amount) < Decimal("0.01") else "MISMATCH")
        for order in totals
        for amount in (amounts[order] or {None})
    }
    result = rows(reconcile.reconciled(orders, items, payments))
    found = [(r["order_id"], r["payment_amount"], r["status_check"]) for r in result]
    assert len(found) == len(set(found))
    assert set(found) == expected


def test_only_orders_with_several_amounts_are_spread(spark, sales):
    """Rows of one amount come from the folded payments alone."""
    plan = reconcile.reconciled(*sales(ORDERS, ITEMS, PAYMENTS))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan
    settled, spread = plan.split("\n:- ")[1:][0], plan[plan.index("LeftSemi") :]
    assert "(least" in settled and "(least" in spread
