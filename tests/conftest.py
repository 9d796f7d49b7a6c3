import datetime
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tallyloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tallyloom tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Monthly frame from (YYYY-MM, revenue text, order count) rows."""

    def build(*rows):
        data = [
            (datetime.date(int(m[:4]), int(m[5:]), 1), Decimal(revenue), count) for m, revenue, count in rows
        ]
        return spark.createDataFrame(data, "month_start date, total_revenue decimal(38,2), order_count bigint")

    return build


@pytest.fixture
def sales(spark):
    """(orders, items, payments) frames from short tuples."""

    def build(orders, items, payments=()):
        order_rows = [(o, 1, datetime.date.fromisoformat(d), s) for o, d, s in orders]
        item_rows = [(n, o, p, q, Decimal(price)) for n, (o, p, q, price) in enumerate(items, 1)]
        payment_rows = [
            (n, Decimal(a), o, "Card", datetime.date(2020, 1, 1)) for n, (o, a) in enumerate(payments, 1)
        ]
        return (
            spark.createDataFrame(order_rows, "order_id bigint, customer_id bigint, order_date date, status string"),
            spark.createDataFrame(
                item_rows, "item_id bigint, order_id bigint, product_id bigint, quantity int, price decimal(12,2)"
            ),
            spark.createDataFrame(
                payment_rows,
                "payment_id bigint, amount decimal(18,2), order_id bigint, payment_method string, payment_date date",
            ),
        )

    return build


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def final_plan(frame) -> str:
    """The plan AQE ended with, without the initial one."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
