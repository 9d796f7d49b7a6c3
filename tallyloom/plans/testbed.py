"""The given Parquet tables in the shape of the five sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.operators.generate import PAYMENT_METHODS
from tallyloom.operators.revenue import order_totals

# Payment method by order priority.
METHOD_OF_PRIORITY = dict(
    zip(["2-HIGH", "1-URGENT", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], PAYMENT_METHODS, strict=True)
)


# Schemas of files already read, so that a footer is read once per file and not once per query.
_SCHEMAS: dict[str, T.StructType] = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation as country. The given table has no contact columns."""
    nation = given(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return (
        given(spark, sf_dir, "customer")
        .join(nation, "c_nationkey", "left")
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_name",
            "concat('customer', c_custkey, '@example.com') AS email",
            "concat('+1-555-', c_custkey) AS phone_number",
            "c_mktsegment AS city",
            "n_name AS country",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "CAST(p_retailprice AS decimal(12,2)) AS price",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS date) AS order_date",
        "o_orderstatus AS status",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items, priced in double. They have no item id, only a line number that repeats in an order."""
    return given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "l_linenumber AS line_number",
        "CAST(rint(l_quantity) AS int) AS quantity",
        "l_extendedprice AS price",
    )


# What an order's payments add to its total, one payment per element.
PAID_MORE = """
CAST(CASE
  WHEN status = 'P' AND priority = '5-LOW' THEN array()
  WHEN status = 'F' AND priority = '4-NOT SPECIFIED' THEN array('5.00')
  WHEN status = 'P' AND priority = '3-MEDIUM' THEN array('0.01')
  WHEN status = 'O' AND priority = '1-URGENT' THEN array('0.00', '25.00')
  WHEN status = 'O' AND priority = '2-HIGH' THEN array('0.00', '0.00')
  ELSE array('0.00') END AS array<decimal(18,2)>)"""


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments that follow from every order's total, status and priority; none are given.

    Pending low orders are not paid. Fulfilled low orders are paid under an order id that does
    not exist. Fulfilled orders of unspecified priority pay 5.00 too much. Open urgent orders pay
    an extra 25.00 apart, open high ones pay twice. All others pay their total, pending medium ones
    one cent more.
    """
    placed = given(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "CAST(o_orderdate AS date) AS order_date",
        "o_orderstatus AS status",
        "o_orderpriority AS priority",
    )
    priced = order_totals(placed, order_items(spark, sf_dir), ["order_date", "status", "priority"])
    paid = priced.selectExpr("*", f"posexplode({PAID_MORE}) AS (part, more)")
    methods = ", ".join(f"'{priority}', '{method}'" for priority, method in METHOD_OF_PRIORITY.items())
    return paid.selectExpr(
        "order_id * 2 + part AS payment_id",
        "CAST(if(status = 'O' AND priority = '1-URGENT' AND part = 1, more, round(order_total, 2) + more) "
        "AS decimal(18,2)) AS amount",
        "if(status = 'F' AND priority = '5-LOW', -1 - order_id, order_id) AS order_id",
        f"map({methods})[priority] AS payment_method",
        "date_add(order_date, 3) AS payment_date",
    )


def customers_without_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers for the audits, which look at no country and so need no join."""
    return given(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS customer_name",
        "concat('customer', c_custkey, '@example.com') AS email",
        "c_mktsegment AS city",
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers_without_country(spark, sf_dir),
        "products": products(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
        "payments": payments(spark, sf_dir),
    }
