"""The four jobs: generate, ingest, check payments, report sales.

Each writes its results in full below an output folder; nothing passes through the driver but
row counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import forecast, generate, quality, reconcile, report, summary, trend, upsert
from tallyloom.operators.revenue import monthly_revenue
from tallyloom.schemas import TABLES
from tallyloom.sources import csv_files, warehouse


def _counted(frame: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a second scan."""
    seen = Observation(name)
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def generate_csv(
    spark: SparkSession,
    out: str,
    customers: int = 100,
    products: int = 50,
    orders: int = 200,
    least_items: int = 1,
    most_items: int = 5,
) -> dict[str, int]:
    """Write the five tables as CSV folders below ``out``; returns rows written per table."""
    made_orders = generate.gen_orders(generate.key_range(spark, orders), customers)
    made_products = generate.gen_products(generate.key_range(spark, products))
    frames = {
        "customers": lambda: generate.gen_customers(generate.key_range(spark, customers)),
        "products": lambda: made_products,
        "orders": lambda: made_orders,
        "order_items": lambda: generate.gen_order_items(made_orders, made_products, products, least_items, most_items),
        # from the items as written, so that they are made once
        "payments": lambda: generate.gen_payments(
            made_orders, csv_files.read_order_items(spark, f"{out}/order_items.csv")
        ),
    }
    rows = {}
    for name, frame in frames.items():
        counted, seen = _counted(frame(), name)
        csv_files.write_table(counted, name, f"{out}/{name}.csv")
        rows[name] = seen.get["rows"]
    return rows


def ingest(
    spark: SparkSession,
    csv_root: str,
    root: str,
    quarantine: bool = False,
    multi_line: bool | None = None,
    names: Sequence[str] = tuple(TABLES),
    buckets: int | None = None,
) -> dict[str, int]:
    """Load ``<csv_root>/<table>.csv`` into the warehouse; returns rows accepted per table.

    Rows replace earlier rows of the same key, the later row of a file wins, and rows absent from
    the files stay. All tables become visible together. Without ``quarantine`` a bad row fails
    the load; with it, bad rows are written to ``<root>/quarantine/<id of the load>/<table>``. What became of the rows
    is listed with the load (``warehouse.load_counts``).

    Files are parsed once, into a staging folder. Of a table only the key buckets that a batch touches are read and
    written. ``buckets`` is their number for new tables, 16 by default; a greater one than a table has deals that table anew, in this
    load only, so that later batches touch less of it.
    """
    before = warehouse.loads(spark, root)
    load = before[-1]["load"] + 1 if before else 1
    load_id = f"load={load}-{uuid.uuid4().hex}"
    parts, counts = [], []
    for name in names:
        written, counted = _ingest_table(spark, csv_root, root, name, load_id, before, quarantine, multi_line, buckets)
        parts += written
        counts.append(counted)
    warehouse.record_load(spark, root, load, load_id, parts, counts)
    return {c.table: c.rows_read - c.rows_refused for c in counts}


def _ingest_table(
    spark: SparkSession,
    csv_root: str,
    root: str,
    name: str,
    load_id: str,
    before: Sequence[Row],
    quarantine: bool,
    multi_line: bool | None,
    buckets: int | None,
) -> tuple[list[tuple[str, int, int]], warehouse.Counts]:
    """Write the buckets of one table: (table, bucket, number of buckets) of each, and what became of the rows."""
    table, position = TABLES[name], csv_files.POSITION
    had = warehouse.buckets_of(before, name)
    number = max(had or buckets or warehouse.BUCKETS, buckets or 0)
    raw = csv_files.read_raw(spark, table, f"{csv_root}/{name}.csv", multi_line)
    counted, read = _counted(raw, f"{name} read")
    counted.write.parquet(f"{root}/staging/{load_id}/{name}")
    staged = spark.read.schema(raw.schema).parquet(f"{root}/staging/{load_id}/{name}")
    refused = 0
    if quarantine:
        batch, bad = csv_files.split_quarantine(staged, table, position)
        bad, seen = _counted(bad.drop(*position), f"{name} refused")
        bad.write.json(f"{root}/quarantine/{load_id}/{name}")
        refused = seen.get["rows"]
    else:
        batch = csv_files.typed_strict(staged, table, position)
    accepted = read.get["rows"] - refused
    latest, seen = _counted(upsert.latest_by_key(batch, [table.key], position).drop(*position), f"{name} latest")
    touched = _buckets_in(batch, table.key, number)
    existing = None
    if had is not None:
        # of a table dealt anew every bucket is read and written
        existing = warehouse.read(spark, root, name, only=touched if number == had else None)
        if number != had:
            touched |= _buckets_in(existing, table.key, number)
    new = replaced = 0
    if touched:
        merged = latest
        if existing is not None:
            merged = upsert.replaced(existing, batch, [table.key]).unionByName(latest.select(*existing.columns))
        warehouse.write_buckets(merged, root, name, load_id, number)
        written = spark.read.schema(table.schema).parquet(warehouse.load_path(root, name, load_id)).count()
        # of no rows there is nothing to observe
        new = seen.get["rows"] if accepted else 0
        replaced = (0 if existing is None else existing.count()) - (written - new)
    kept = warehouse.rows_of(before, name) - replaced
    counts = warehouse.Counts(name, read.get["rows"], refused, accepted - new, replaced, new - replaced, kept)
    return [(name, bucket, number) for bucket in sorted(touched)], counts


def _buckets_in(frame: DataFrame, key: str, buckets: int) -> set[int]:
    return {r[0] for r in frame.select(warehouse.bucket_of(key, buckets)).distinct().collect()}


def _save(frame: DataFrame, out: str, name: str) -> None:
    frame.write.mode("overwrite").csv(f"{out}/{name}", header=True)


def check_payments(spark: SparkSession, root: str, out: str) -> None:
    """Write the reconciliation, its counters and the unmatched rows of both sides."""
    tables = warehouse.read_all(spark, root)
    orders, items, payments = tables["orders"], tables["order_items"], tables["payments"]
    # The rows feed three reports, so they are computed and stored once.
    rows_path = f"{out}/reconciliation"
    rows = reconcile.payment_reconciliation(orders, items, payments, ordered=True)
    rows.write.mode("overwrite").parquet(rows_path)
    stored = spark.read.schema(rows.schema).parquet(rows_path)
    _save(report.formatted_reconciliation(stored), out, "reconciliation_lines")
    _save(reconcile.mismatches(stored), out, "mismatches")
    counts = reconcile.outcome_counts(stored)
    _save(report.formatted_reconciliation_summary(counts), out, "reconciliation_summary")
    _save(reconcile.orders_without_payments(orders, items, payments), out, "orders_without_payments")
    _save(reconcile.payments_without_orders(orders, payments), out, "payments_without_orders")
    _save(reconcile.unmatched_counts(orders, payments), out, "unmatched_counts")


def audit(spark: SparkSession, root: str, out: str) -> None:
    """Write row counts, reference orphans, and key and null violations."""
    tables = warehouse.read_all(spark, root)
    _save(quality.table_row_counts(tables), out, "table_row_counts")
    _save(quality.fk_orphan_counts(tables), out, "fk_orphan_counts")
    _save(quality.key_null_audit(tables), out, "key_null_audit")


def report_sales(spark: SparkSession, root: str, out: str) -> None:
    """Write every monthly report, each computed from one stored monthly series."""
    tables = warehouse.read_all(spark, root)
    series = monthly_revenue(tables["orders"], tables["order_items"])
    path = f"{out}/monthly_revenue"
    series.write.mode("overwrite").parquet(path)
    monthly = spark.read.schema(series.schema).parquet(path)
    detail = trend.monthly_trend_detail(monthly)
    reports = {
        "monthly_trend_detail": detail,
        "monthly_trend_alt": trend.monthly_trend_alt(monthly),
        "monthly_trend_calendar": trend.monthly_trend_calendar(monthly),
        "monthly_summary": summary.monthly_summary(monthly),
        "monthly_change_summary": summary.monthly_change_summary(monthly),
        "trend_range_slope": summary.trend_range_slope(monthly),
        "trend_endpoint_slope": summary.trend_endpoint_slope(monthly),
        "trend_line_ols": trend.trend_line_ols(monthly),
        "forecast_from_max": forecast.forecast_from_max(monthly),
        "forecast_from_last": forecast.forecast_from_last(monthly),
        "forecast_series_dated": forecast.forecast_series_dated(monthly),
        "chart_series": report.chart_series(monthly),
        "trend_lines": report.formatted_trend(detail),
    }
    for name, frame in reports.items():
        _save(frame.coalesce(1), out, name)
