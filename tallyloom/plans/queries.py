"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over whole tables.

Money leaves as double and dates as ISO text, so that other engines compare like with like.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import jobs
from tallyloom.functions.dates import iso_date
from tallyloom.operators import forecast, generate, positions, quality, reconcile, report, summary, trend, upsert
from tallyloom.operators.revenue import monthly_revenue, monthly_revenue_report, order_totals
from tallyloom.plans import testbed
from tallyloom.schemas import TABLES
from tallyloom.session import scratch_path
from tallyloom.sources import csv_files, warehouse

Query = Callable[[SparkSession, str], DataFrame]


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_revenue(testbed.orders(spark, sf_dir), testbed.order_items(spark, sf_dir))


def _on_months(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_monthly(spark, sf_dir))


def _on_sales(operator: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(
        testbed.orders(spark, sf_dir), testbed.order_items(spark, sf_dir), testbed.payments(spark, sf_dir)
    )


def _portable(frame: DataFrame) -> DataFrame:
    """Decimals as double, dates as ISO text."""

    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return iso_date(F.col(field.name)).alias(field.name)
        return F.col(field.name)

    return frame.select(*[column(f) for f in frame.schema.fields])


# --- sources and sinks ---


def _through_csv(name: str, source: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Write a whole table as CSV files to the shared folder, then read it back typed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "csv", uuid.uuid4().hex, f"{name}.csv")
        csv_files.write_table(source(spark, sf_dir), name, path)
        return _portable(csv_files.read_table(spark, name, path))

    return query


def _items_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items under the declared schema; the id is made of order and line number."""
    lines = testbed.given(spark, sf_dir, "lineitem")
    return lines.select(
        (F.col("l_orderkey") * 1_000_000 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.rint("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )


def _dates_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text with the date in every accepted layout, by status."""
    date = F.col("o_orderdate").cast("date")
    return testbed.given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", F.date_format(date, "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(date, "yyyy-MM-dd"))
        .otherwise(F.date_format(date, "M/d/yyyy"))
        .alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def ingest_orders_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = csv_files.typed_strict(_dates_as_text(spark, sf_dir), TABLES["orders"])
    return _portable(typed)


def ingest_orders_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows set aside when ids and dates of some kinds of orders are damaged."""
    return csv_files.split_quarantine(_damaged_orders(spark, sf_dir), TABLES["orders"])[1]


def _damaged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _dates_as_text(spark, sf_dir)
    low = F.col("priority") == "5-LOW"
    return raw.withColumns(
        {
            "order_id": F.when(low & (F.col("status") == "P"), "n/a").otherwise(F.col("order_id")),
            "customer_id": F.when(low & (F.col("status") == "P"), F.lit(None)).otherwise(F.col("customer_id")),
            "order_date": F.when(low & (F.col("status") == "F"), "13/40/2020").otherwise(F.col("order_date")),
        }
    )


def upsert_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilled lines first, then open lines over them, keyed by order and line number."""
    lines = testbed.given(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate"] + [c for c in lines.columns if c not in [*key, "l_shipdate"]]
    shipped = upsert.latest_by_key(lines.where(F.col("l_linestatus") == "F"), key, order)
    merged = upsert.upsert_latest_by_key(shipped, lines.where(F.col("l_linestatus") != "F"), key, order)
    return merged.select(
        *key, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus",
        iso_date(F.col("l_shipdate")).alias("l_shipdate"),
    )


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_row_counts(testbed.tables(spark, sf_dir))


# --- audits ---


def fk_orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fk_orphan_counts(testbed.tables(spark, sf_dir))


def key_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_null_audit(
        testbed.tables(spark, sf_dir), keys={"order_items": ["order_id", "line_number"]}
    )


# --- reconciliation ---


def all_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portable(order_totals(testbed.orders(spark, sf_dir), testbed.order_items(spark, sf_dir)))


def payment_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reconcile.payment_reconciliation(
        testbed.orders(spark, sf_dir),
        testbed.order_items(spark, sf_dir),
        testbed.payments(spark, sf_dir),
        ordered=True,
    )
    return _portable(rows)


def payment_reconciliation_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each row stands in the sorted report."""
    rows = payment_reconciliation(spark, sf_dir)
    return positions.numbered(rows).select("position", "order_id", "payment_amount", "status_check")


def monthly_trend_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each month stands in the detailed report."""
    rows = trend.monthly_trend_detail(_monthly(spark, sf_dir))
    return positions.numbered(rows).select("position", "month", "monthly_revenue")


def reconciliation_unknown_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation when the extra payments of open urgent orders have no amount."""
    payments = testbed.payments(spark, sf_dir)
    extra = (F.col("payment_method") == testbed.METHOD_OF_PRIORITY["1-URGENT"]) & (F.col("payment_id") % 2 == 1)
    payments = payments.withColumn("amount", F.when(~extra, F.col("amount")))
    orders, items = testbed.orders(spark, sf_dir), testbed.order_items(spark, sf_dir)
    return _portable(reconcile.payment_reconciliation(orders, items, payments))


def formatted_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _on_sales(reconcile.payment_reconciliation)(spark, sf_dir)
    return report.formatted_reconciliation(rows)


def formatted_reconciliation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.formatted_reconciliation_summary(_on_sales(reconcile.reconciliation_summary)(spark, sf_dir))


def payments_without_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.payments_without_orders(testbed.orders(spark, sf_dir), testbed.payments(spark, sf_dir))


def unmatched_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.unmatched_counts(testbed.orders(spark, sf_dir), testbed.payments(spark, sf_dir))


# --- generator: one made row per row of the given table ---


def _keys(spark: SparkSession, sf_dir: str, name: str, column: str) -> DataFrame:
    return testbed.given(spark, sf_dir, name).select((F.col(column) + 1).alias("id"))


def _rows(spark: SparkSession, sf_dir: str, name: str) -> Column:
    return testbed.given(spark, sf_dir, name).agg(F.count(F.lit(1))).scalar()


def made_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_customers(_keys(spark, sf_dir, "customer", "c_custkey"))


def made_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_products(_keys(spark, sf_dir, "part", "p_partkey"))


def made_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _keys(spark, sf_dir, "orders", "o_orderkey")
    return generate.gen_orders(keys, _rows(spark, sf_dir, "customer"))


def made_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_order_items(
        made_orders(spark, sf_dir), made_products(spark, sf_dir), _rows(spark, sf_dir, "part")
    )


def made_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_payments(made_orders(spark, sf_dir), made_items(spark, sf_dir))


def _made(source: Query) -> Query:
    return lambda spark, sf_dir: _portable(source(spark, sf_dir))


def gen_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by the generator job for the row counts of the given tables and two to four items an order."""
    counts = {name: testbed.given(spark, sf_dir, name).count() for name in ("customer", "part", "orders")}
    out = scratch_path(spark, "csv", uuid.uuid4().hex)
    rows = jobs.generate_csv(spark, out, counts["customer"], counts["part"], counts["orders"], least_items=2, most_items=4)
    return spark.createDataFrame(list(rows.items()), "table_name string, row_count bigint")


def ingest_payments_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as raw text with the date in both layouts, typed."""
    paid = testbed.payments(spark, sf_dir)
    layout = F.when(F.col("payment_id") % 2 == 0, F.date_format("payment_date", "M/d/yyyy"))
    raw = paid.withColumn("payment_date", layout.otherwise(iso_date(F.col("payment_date"))))
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in TABLES["payments"].schema.names])
    return _portable(csv_files.typed_strict(raw, TABLES["payments"]))


# --- files with bad rows ---


def _dirty_products(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Lines of a product file with quoted breaks, surplus and missing fields, and too many places, by key."""
    part = testbed.given(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    broken = F.concat(F.lit('"'), F.col("p_name"), F.lit('\nsecond ""line"""'))
    kind = F.col("p_partkey") % 10
    name = F.when(kind == 1, broken).otherwise(F.concat(F.lit('"'), F.col("p_name"), F.lit('"')))
    price = F.when(kind == 4, F.concat(price, F.lit("0000001"))).when(kind == 5, F.concat(price, F.lit("9"))).otherwise(price)
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), name, F.col("p_type"), price)
    line = F.when(kind == 2, F.concat(line, F.lit(",surplus"))).when(
        kind == 3, F.concat_ws(",", F.col("p_partkey").cast("string"), name, F.col("p_type"))
    ).otherwise(line)
    header = ",".join(TABLES["products"].schema.names)
    part.select(F.struct(line.alias(header)).alias("row")).select("row.*").write.csv(
        path, header=True, quote="\u0000", emptyValue="", sep="\u0001"
    )


def _read_dirty(bad_rows: bool, multi_line: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "csv", uuid.uuid4().hex, "products.csv")
        _dirty_products(spark, sf_dir, path)
        raw = csv_files.read_raw(spark, TABLES["products"], path, multi_line)
        good, bad = csv_files.split_quarantine(raw, TABLES["products"])
        return bad.select("product_id", "reason") if bad_rows else _portable(good)

    return query


def ingest_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of order files: all orders, then two later versions of the urgent ones; the table as read back."""
    root = scratch_path(spark, "warehouse", uuid.uuid4().hex)
    given = testbed.orders(spark, sf_dir)
    urgent = testbed.given(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    urgent = given.join(urgent.select(F.col("o_orderkey").alias("order_id")), "order_id", "left_semi")
    csv_files.write_table(given, "orders", f"{root}/first/orders.csv")
    versions = urgent.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    versions = versions.withColumn("status", F.concat("status", F.lit("-"), F.col("version").cast("string")))
    csv_files.write_table(versions.orderBy("version", "order_id"), "orders", f"{root}/second/orders.csv")
    for batch in ("first", "second"):
        jobs.ingest(spark, f"{root}/{batch}", f"{root}/tables", names=["orders"])
    return _portable(warehouse.read(spark, f"{root}/tables", "orders"))


def ingest_load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the rows of two loads of orders: all of them, some damaged; then two versions of the urgent ones
    and new orders in place of the high ones."""
    root = scratch_path(spark, "warehouse", uuid.uuid4().hex)
    header = TABLES["orders"].schema.names
    damaged = _damaged_orders(spark, sf_dir).select(*header)
    damaged.write.csv(f"{root}/first/orders.csv", header=True)
    good = _dates_as_text(spark, sf_dir)
    later = good.where("priority = '1-URGENT'").select(*header)
    later = later.withColumn("status", F.explode(F.array(F.lit("one"), F.lit("two"))))
    fresh = good.where("priority = '2-HIGH'").select(*header).withColumn("order_id", F.concat(F.lit("-9"), "order_id"))
    later.unionByName(fresh).write.csv(f"{root}/second/orders.csv", header=True)
    jobs.ingest(spark, f"{root}/first", f"{root}/tables", quarantine=True, names=["orders"])
    jobs.ingest(spark, f"{root}/second", f"{root}/tables", names=["orders"], buckets=64)
    return warehouse.load_counts(spark, f"{root}/tables")


def monthly_net_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly series on discounted prices, which have parts of a cent.

    Cents times hundredths end at the fourth place; what the product in double has beyond is not part of the price.
    """
    lines = testbed.given(spark, sf_dir, "lineitem")
    items = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.rint("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("price"),
    )
    return monthly_revenue_report(monthly_revenue(testbed.orders(spark, sf_dir), items))


QUERIES: dict[str, Query] = {
    "monthly_trend_detail": _on_months(trend.monthly_trend_detail),
    "monthly_trend_alt": _on_months(trend.monthly_trend_alt),
    "monthly_trend_calendar": _on_months(trend.monthly_trend_calendar),
    "monthly_revenue": _on_months(monthly_revenue_report),
    "monthly_net_revenue": monthly_net_revenue,
    "monthly_with_previous": _on_months(trend.monthly_with_previous),
    "monthly_moving_avg": _on_months(trend.monthly_moving_avg),
    "monthly_summary": _on_months(summary.monthly_summary),
    "monthly_change_summary": _on_months(summary.monthly_change_summary),
    "trend_range_slope": _on_months(summary.trend_range_slope),
    "trend_endpoint_slope": _on_months(summary.trend_endpoint_slope),
    "avg_nonzero_change": _on_months(summary.avg_nonzero_change),
    "trend_line_ols": _on_months(trend.trend_line_ols),
    "forecast_from_max": _on_months(forecast.forecast_from_max),
    "forecast_from_last": _on_months(forecast.forecast_from_last),
    "forecast_series_dated": _on_months(forecast.forecast_series_dated),
    "chart_series": _on_months(report.chart_series),
    "formatted_trend": _on_months(lambda m: report.formatted_trend(trend.monthly_trend_detail(m))),
    "formatted_trend_calendar": _on_months(
        lambda m: report.formatted_trend_calendar(trend.monthly_trend_calendar(m))
    ),
    "formatted_summary": _on_months(lambda m: report.formatted_summary(summary.monthly_change_summary(m))),
    "formatted_slope": _on_months(lambda m: report.formatted_slope(summary.trend_endpoint_slope(m))),
    "formatted_forecast": _on_months(lambda m: report.formatted_forecast(forecast.forecast_from_max(m))),
    "formatted_forecast_last": _on_months(lambda m: report.formatted_forecast(forecast.forecast_from_last(m))),
    "formatted_range_slope": _on_months(lambda m: report.formatted_slope(summary.trend_range_slope(m))),
    "formatted_summary_nonzero": _on_months(
        lambda m: report.formatted_summary(
            summary.monthly_summary(m).withColumn("avg_monthly_change", summary.avg_nonzero_change(m).scalar())
        )
    ),
    "formatted_mismatches": lambda spark, sf_dir: report.formatted_mismatches(
        _on_sales(reconcile.payment_mismatches)(spark, sf_dir)
    ),
    "formatted_unpaid": lambda spark, sf_dir: report.formatted_unpaid(
        _on_sales(reconcile.orders_without_payments)(spark, sf_dir)
    ),
    "formatted_orphans": lambda spark, sf_dir: report.formatted_orphans(payments_without_orders(spark, sf_dir)),
    "order_totals": all_order_totals,
    "payment_reconciliation": payment_reconciliation,
    "payment_reconciliation_positions": payment_reconciliation_positions,
    "monthly_trend_positions": monthly_trend_positions,
    "reconciliation_unknown_amounts": reconciliation_unknown_amounts,
    "payment_mismatches": _on_sales(reconcile.payment_mismatches),
    "reconciliation_summary": _on_sales(reconcile.reconciliation_summary),
    "orders_without_payments": _on_sales(reconcile.orders_without_payments),
    "payments_without_orders": payments_without_orders,
    "unmatched_counts": unmatched_counts,
    "formatted_reconciliation": formatted_reconciliation,
    "formatted_reconciliation_summary": formatted_reconciliation_summary,
    "read_customers": _through_csv("customers", testbed.customers),
    "read_products": _through_csv("products", testbed.products),
    "read_orders": _through_csv("orders", testbed.orders),
    "read_order_items": _through_csv("order_items", _items_with_id),
    "read_payments": _through_csv("payments", testbed.payments),
    "ingest_orders_dates": ingest_orders_dates,
    "ingest_payments_dates": ingest_payments_dates,
    "ingest_orders_quarantine": ingest_orders_quarantine,
    "ingest_upsert_orders": ingest_upsert_orders,
    "ingest_load_counters": ingest_load_counters,
    "read_dirty_good": _read_dirty(bad_rows=False, multi_line=True),
    "read_dirty_good_split": _read_dirty(bad_rows=False, multi_line=False),
    "read_dirty_quarantine": _read_dirty(bad_rows=True, multi_line=True),
    "read_dirty_quarantine_split": _read_dirty(bad_rows=True, multi_line=False),
    "upsert_latest_by_key": upsert_latest_by_key,
    "table_row_counts": table_row_counts,
    "fk_orphan_counts": fk_orphan_counts,
    "key_null_audit": key_null_audit,
    "gen_customers": _made(made_customers),
    "gen_products": _made(made_products),
    "gen_orders": _made(made_orders),
    "gen_order_items": _made(made_items),
    "gen_payments": _made(made_payments),
    "gen_volumes": gen_volumes,
}
