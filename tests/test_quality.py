"""Audits of references, keys and required columns."""

from conftest import rows

from tallyloom.operators import quality


def tables(spark):
    return {
        "customers": spark.createDataFrame(
            [(1, "Ann", "a@x", None, None, None), (1, None, "b@x", None, None, None)],
            "customer_id bigint, customer_name string, email string, phone_number string, city string, country string",
        ),
        "products": spark.createDataFrame(
            [(1, "lamp", "Toys", 2.5), (2, "desk", "Toys", float("nan"))],
            "product_id bigint, product_name string, category string, price double",
        ),
        "orders": spark.sql(
            "SELECT * FROM VALUES (1L, 1L, DATE'2020-01-01', 'x'), (2L, 9L, DATE'2020-01-01', 'x'), "
            "(3L, NULL, NULL, 'x') AS t(order_id, customer_id, order_date, status)"
        ),
        "order_items": spark.sql(
            "SELECT * FROM VALUES (1L, 1L, 1L, 1, 1.00), (2L, 8L, 1L, 1, 1.00), (3L, 1L, 7L, 1, 1.00), "
            "(4L, 8L, 7L, 1, 1.00) AS t(item_id, order_id, product_id, quantity, price)"
        ),
        "payments": spark.sql(
            "SELECT * FROM VALUES (1L, 1.00, 1L, 'Card', DATE'2020-01-01'), (1L, 1.00, 5L, 'Card', DATE'2020-01-01'), "
            "(NULL, 1.00, 1L, 'Card', DATE'2020-01-01') AS t(payment_id, amount, order_id, payment_method, payment_date)"
        ),
    }


def test_orphans_and_null_references(spark):
    found = {r["reference"]: (r["orphan_rows"], r["null_rows"]) for r in rows(quality.fk_orphan_counts(tables(spark)))}
    assert found == {
        "orders.customer_id -> customers.customer_id": (1, 1),
        "order_items.order_id -> orders.order_id": (2, 0),
        "order_items.product_id -> products.product_id": (2, 0),
        "payments.order_id -> orders.order_id": (1, 0),
    }


def test_no_orphans_counts_zero(spark):
    given = tables(spark)
    found = quality.foreign_key_orphans(given["orders"].where("order_id = 1"), "customer_id", given["customers"], "customer_id", "r")
    assert rows(found) == [{"reference": "r", "orphan_rows": 0, "null_rows": 0}]


def test_keys_and_required_columns(spark):
    found = {
        (r["table_name"], r["check_name"], r["column_name"]): r["violations"]
        for r in rows(quality.key_null_audit(tables(spark)))
    }
    assert found[("customers", "unique", "customer_id")] == 1
    assert found[("customers", "not null", "customer_name")] == 1
    assert found[("products", "not null", "price")] == 1  # NaN
    assert found[("orders", "not null", "order_date")] == 1
    assert found[("payments", "unique", "payment_id")] == 1
    assert found[("payments", "not null", "payment_id")] == 1
    assert found[("order_items", "unique", "item_id")] == 0


def test_compound_key(spark):
    items = tables(spark)["order_items"]
    found = rows(quality.key_and_null_audit("order_items", items, ["order_id", "quantity"], []))
    assert found == [
        {"table_name": "order_items", "check_name": "unique", "column_name": "order_id, quantity", "violations": 2}
    ]


def test_row_counts(spark):
    counts = {r["table_name"]: r["row_count"] for r in rows(quality.table_row_counts(tables(spark)))}
    assert counts == {"customers": 2, "products": 2, "orders": 3, "order_items": 4, "payments": 3}
