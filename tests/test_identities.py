"""Relations that hold for any data, on random series and on the given tables."""

import datetime
import os
import random
from decimal import Context, Decimal
from fractions import Fraction

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.functions.dates import parse_date
from tallyloom.functions.money import exact_sum, round2
from tallyloom.operators import forecast, positions, reconcile, summary, trend
from tallyloom.operators.revenue import item_totals, monthly_revenue, order_totals
from tallyloom.plans import testbed

SF_DIR = "/root/testdata/sf0.001"

amounts = st.decimals(min_value=0, max_value=10**9, places=2)
months = st.integers(min_value=0, max_value=60)


def cents(value):
    return Decimal(value).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")


@given(st.dictionaries(months, amounts, min_size=2, max_size=12))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_series_identities(series, drawn):
    ordered = sorted(drawn.items())
    monthly = series(*[(f"{2015 + m // 12}-{m % 12 + 1:02d}", str(v), 1) for m, v in ordered])
    values = [v for _, v in ordered]
    steps = [b - a for a, b in zip(values, values[1:])]

    # The running mean of the changes telescopes to revenue over position.
    for position, row in enumerate(rows(trend.monthly_trend_detail(monthly)), 1):
        mean_change = row["forecast_next_month"] - row["monthly_revenue"]
        assert mean_change == pytest.approx(float(values[position - 1] / position), abs=0.006)

    # The mean step is the slope between the end points.
    growth = {r["avg_monthly_growth"] for r in rows(trend.monthly_trend_alt(monthly))}
    slope = rows(summary.trend_endpoint_slope(monthly))[0]["overall_slope"]
    assert growth == {slope}
    assert slope == pytest.approx(float(sum(steps) / len(steps)), abs=0.006)

    # Leaving out the first month removes exactly its revenue.
    whole, later = rows(summary.monthly_summary(monthly))[0], rows(summary.monthly_change_summary(monthly))[0]
    assert cents(whole["total_revenue"]) - cents(later["total_revenue"]) == cents(values[0])
    assert later["total_months"] == len(values) - 1

    # Forecasts from the greatest month step by the mean growth.
    ahead = [r["forecasted_revenue"] for r in rows(forecast.forecast_from_max(monthly))]
    assert ahead[0] == pytest.approx(float(max(values) + sum(steps) / len(steps)), abs=0.006)


def test_rounding_is_half_away_from_zero(spark):
    texts = ["1.005", "18165.005", "-2.345", "0.125", "-0.125", "2.675", "1e9", "0", "0.0049999996", "0.0050000004"]
    frame = spark.createDataFrame([(float(t),) for t in texts], "v double")
    assert [r[0] for r in frame.select(round2(F.col("v"))).collect()] == [cents(t) for t in texts]


def test_exact_sum_equals_plain_integers(spark):
    draw = random.Random(3)
    values = [draw.choice([-1, 1]) * draw.getrandbits(draw.randint(1, 62)) for _ in range(500)]
    values += [0, 2**62, -(2**62), 2**20, 2**20 - 1, -1]
    frame = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, v bigint")
    found = {r.k: r.s for r in frame.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
    assert found == {k: sum(v for i, v in enumerate(values) if i % 3 == k) for k in range(3)}
    # More than one bigint holds.
    many = spark.range(64).select(F.lit(2**62).alias("v")).agg(exact_sum(F.col("v")))
    assert many.first()[0] == 2**68


def test_double_prices_sum_like_decimals(spark):
    draw = random.Random(4)
    data = [(n % 50, draw.randint(1, 9), round(draw.uniform(0.01, 99999.99), 2)) for n in range(2000)]
    items = spark.createDataFrame(data, "order_id int, quantity int, price double")
    exact = items.withColumn("price", F.col("price").cast("decimal(12,2)"))
    assert sorted(map(tuple, item_totals(items).collect())) == sorted(map(tuple, item_totals(exact).collect()))
    finer = spark.createDataFrame([(1, 1000, 0.333), (1, 1, 0.1), (2, 1, None)], "order_id int, quantity int, price double")
    assert sorted(map(tuple, item_totals(finer).collect())) == [(1, Decimal("333.1")), (2, None)]
    unknown = spark.createDataFrame([(1, 2, float("nan"))], "order_id int, quantity int, price double")
    with pytest.raises(PySparkException, match="price: not a number"):
        item_totals(unknown).collect()


def exact_totals(frame):
    """By whole millionths where a price is one, else by its decimal text to the 18th place."""
    found = {}
    for order, quantity, price, text in frame.select("*", F.col("price").cast("string")).collect():
        millionths = round(price * 1e6)
        whole = millionths / 1e6 == price and abs(millionths) < 2**53
        placed = Decimal(text).quantize(Decimal(10) ** -18, rounding="ROUND_HALF_UP", context=Context(prec=60))
        value = Fraction(millionths, 10**6) if whole else Fraction(placed)
        found[order] = found.get(order, Fraction(0)) + quantity * value
    return found


def test_double_prices_of_any_size_sum_exactly(spark):
    draw = random.Random(6)
    data = []
    for n in range(4000):
        size = draw.choice([-19, -15, -9, -7, -3, -2, 0, 2, 5, 8, 9])
        price = draw.choice([draw.uniform(-9, 9), round(draw.uniform(0, 9), 2), draw.randint(-9, 9)]) * 10.0**size
        data.append((n % 40, draw.randint(1, 99), float(price)))
    data += [(50, 10**9, 1e-7), (51, 3, 0.1), (51, 7, 0.1), (52, 1, 1e11), (52, 1, 1e-12), (52, 1, -1e11), (53, 5, 0.30000000000000004)]
    frame = spark.createDataFrame(data, "order_id int, quantity int, price double")
    want = exact_totals(frame)
    totals = [dict(map(tuple, item_totals(frame.repartition(n)).collect())) for n in (1, 7)]
    assert totals[0] == totals[1]
    for order, total in totals[0].items():
        assert abs(Fraction(total) - want[order]) <= Fraction(1, 2 * 10**12), order
    assert (totals[0][50], totals[0][51], totals[0][52]) == (100, 1, Decimal("1E-12"))
    monthly = [
        monthly_revenue(
            spark.createDataFrame([(o, datetime.date(2020, 1 + o % 3, 1)) for o in range(60)], "order_id int, order_date date"),
            frame.repartition(n),
        ).orderBy("month_start").collect()
        for n in (1, 5)
    ]
    assert monthly[0] == monthly[1]


@pytest.mark.parametrize(("price", "match"), [(float("inf"), "too large"), (1e13, "too large")])
def test_prices_that_cannot_be_summed_exactly_fail(spark, price, match):
    frame = spark.createDataFrame([(1, 2, price)], "order_id int, quantity int, price double")
    with pytest.raises(PySparkException, match=match):
        item_totals(frame).collect()


def test_float_prices_count_as_their_text(spark):
    frame = spark.createDataFrame([(1, 3, 0.1), (1, 1, 19.99), (2, 1, None)], "order_id int, quantity int, price float")
    assert sorted(map(tuple, item_totals(frame).collect())) == [(1, Decimal("20.29")), (2, None)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_numbered_rows_follow_the_order_of_the_frame(spark, partitions):
    draw = random.Random(7)
    data = [(draw.randint(0, 300), n) for n in range(2000)]
    frame = spark.createDataFrame(data, "k int, n int").withColumns({c: F.lit(0) for c in ("_part", "at", "p", "position")})
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = positions.numbered(frame.orderBy("k", "n")).select("position", "k", "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted(map(tuple, found)) == [(p, *row) for p, row in enumerate(sorted(data), 1)]
    assert positions.numbered(frame.limit(0)).count() == 0


def test_dates_equal_a_plain_parser(spark):
    """Random near-dates against the standard library."""

    def plain(text):
        for layout in ("%m/%d/%Y", "%Y-%m-%d"):
            try:
                return datetime.datetime.strptime(text, layout).date()
            except ValueError:
                pass
        return None

    draw = random.Random(5)
    texts = ["", "/", "1//2020", "0/1/2020", "1/0/2020", "2020-00-10", "0000-01-01", "01/02/0000", "1/2/2020 ", " 1/2/2020"]
    for _ in range(3000):
        day, month = str(draw.randint(0, 33)), str(draw.randint(0, 14))
        year = str(draw.choice([1, 19, 1900, 1999, 2000, 2020, 2021, 9999, 12020]))
        pad = draw.choice([0, 2])
        parts = [month.zfill(pad), day.zfill(pad), year] if draw.random() < 0.5 else [year, month.zfill(pad), day.zfill(pad)]
        texts.append(draw.choice(["/", "-", "/", "-", "."]).join(parts))
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_date(F.col("t")).alias("d"))
    assert {r.t: r.d for r in frame.collect()} == {t: plain(t) for t in texts}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_totals_add_up_on_the_given_tables(spark):
    orders, items = testbed.orders(spark, SF_DIR), testbed.order_items(spark, SF_DIR)
    payments = testbed.payments(spark, SF_DIR)
    monthly = monthly_revenue(orders, items)
    per_order = order_totals(orders, items)
    assert monthly.agg(F.sum("total_revenue")).first()[0] == per_order.agg(F.sum("order_total")).first()[0]
    counts = rows(reconcile.reconciliation_summary(orders, items, payments))[0]
    assert counts["matching"] + counts["mismatching"] == counts["total_orders"]
    unpaid = reconcile.unpaid_orders(orders, payments).count()
    paid = reconcile.reconciled(orders, items, payments).where("payment_amount IS NOT NULL")
    assert unpaid + paid.select("order_id").distinct().count() == orders.count()


def test_rounded_and_unrounded_means_differ_where_reports_differ(spark):
    """The endpoint slope averages rounded revenues, the range slope unrounded ones."""
    data = [(datetime.date(2020, m, 1), Decimal("0.004"), 1) for m in (1, 2, 3)]
    data += [(datetime.date(2020, m, 1), Decimal("0.026"), 1) for m in (4, 5)]
    monthly = spark.createDataFrame(data, "month_start date, total_revenue decimal(38,4), order_count bigint")
    # Rounded: (0 + 0 + 0 + 0.03 + 0.03) / 5 = 0.012; unrounded: 0.064 / 5 = 0.0128.
    assert rows(summary.trend_endpoint_slope(monthly))[0]["overall_slope"] == 0.01
    moved = rows(summary.avg_nonzero_change(monthly))[0]["avg_monthly_change"]
    # Rounded changes: 0.00, 0, 0, 0.02, 0; the first month's 0.004 counts as zero.
    assert moved == 0.02
