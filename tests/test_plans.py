"""Plans that must hold at any size: what is scanned, shuffled, joined and windowed."""

import os
import re

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from tallyloom.plans.queries import QUERIES
from tallyloom.operators import reconcile, upsert
from tallyloom.operators.revenue import item_totals, monthly_revenue
from tallyloom.plans import testbed
from tallyloom.sources import warehouse

SF_DIR = os.environ.get("TEST_PLAN_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_join_and_no_python(spark, no_broadcast, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "Python", "Pandas", "MapIn"):
        assert operator not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_windows_without_a_key_stand_on_month_rows(spark, name):
    """One-task exchanges carry only aggregated rows."""
    lines = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().splitlines()
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[at + 1] or "Project" in lines[at + 1] and "HashAggregate" in lines[at + 2]


def test_monthly_scan_reads_three_item_columns(spark, no_broadcast):
    plan = final_plan(QUERIES["monthly_trend_detail"](spark, SF_DIR))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>?)", plan)
    assert sorted(scans) == [
        "struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>",
        "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>",
    ]


def test_monthly_items_are_summed_before_the_shuffle(spark, no_broadcast):
    plan = final_plan(QUERIES["monthly_revenue"](spark, SF_DIR))
    below_join = plan[plan.index("SortMergeJoin") :]
    assert below_join.count("Exchange hashpartitioning(order_id") == 2
    assert "partial_sum" in below_join
    assert "partial_count(distinct" not in plan


def test_filters_reach_the_scan(spark, no_broadcast):
    orders = testbed.given(spark, SF_DIR, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"), "o_orderstatus"
    )
    recent = monthly_revenue(orders, testbed.order_items(spark, SF_DIR), where=F.col("o_orderstatus") == "F")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in final_plan(recent)


def test_items_are_scanned_once_in_reconciliation(spark, no_broadcast):
    plan = final_plan(QUERIES["reconciliation_summary"](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
    assert "ReusedExchange" in plan


def test_chart_series_computes_the_months_once(spark, no_broadcast):
    plan = final_plan(QUERIES["chart_series"](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1


def test_calendar_report_has_no_self_join(spark, no_broadcast):
    plan = final_plan(QUERIES["monthly_trend_calendar"](spark, SF_DIR))
    assert plan.count("SortMergeJoin") == 1


def test_latest_by_key_limits_each_key_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    plan = upsert.latest_by_key(frame, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in plan[shuffle:]


def test_small_batch_does_not_shuffle_the_existing_rows(spark, tmp_path):
    for name, rows in (("existing", 1000), ("batch", 5)):
        spark.range(rows).select("id", F.col("id").alias("v")).write.parquet(str(tmp_path / name))
    existing, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("existing", "batch"))
    plan = final_plan(upsert.upsert_latest_by_key(existing, batch, ["id"], ["v"]))
    assert "BroadcastHashJoin" in plan
    # The file scan of the existing rows lies below the join with no shuffle between.
    kept = plan[plan.index("BroadcastHashJoin") : plan.index("BroadcastExchange")]
    assert "FileScan parquet [id" in kept and "Exchange hashpartitioning" not in kept


def test_hot_orphan_key_is_spread(spark, no_broadcast):
    """A third of the payments name one unknown order and a sixth none; no task gets a large part of them."""
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        payments = spark.range(0, 90_000, 1, 6).select(
            F.col("id").alias("payment_id"),
            F.when(F.col("id") % 3 == 0, -7).when(F.col("id") % 6 != 1, F.col("id") % 20_000).alias("order_id"),
            F.col("id").cast("decimal(18,2)").alias("amount"),
        )
        orders = spark.range(0, 20_000, 1, 6).select(F.col("id").alias("order_id"))
        found = reconcile.payments_without_orders(orders, payments)
        counts = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == 45_000
        assert max(counts) <= 0.15 * 45_000
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_bucketed_tables_total_and_join_in_place(spark, no_broadcast):
    orders = testbed.orders(spark, SF_DIR)
    items = testbed.order_items(spark, SF_DIR)
    warehouse.save_bucketed(orders, "bucketed_orders", "order_id", 4)
    warehouse.save_bucketed(items, "bucketed_items", "order_id", 4)
    try:
        o, i = spark.table("bucketed_orders"), spark.table("bucketed_items")
        assert "Exchange" not in final_plan(o.join(item_totals(i), "order_id", "left"))
        assert monthly_revenue(o, i).count() == monthly_revenue(orders, items).count()
    finally:
        spark.sql("DROP TABLE bucketed_orders")
        spark.sql("DROP TABLE bucketed_items")
