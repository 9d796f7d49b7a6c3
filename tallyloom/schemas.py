"""The five tables: types, keys and references.

Spark enforces neither keys nor references, so they are declared here and checked by
``operators.quality``. ``nullable=False`` marks a required column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: str
    foreign_keys: tuple[ForeignKey, ...] = ()
    # column name -> header text, where the two differ
    headers: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    def header(self, column: str) -> str:
        return self.headers.get(column, column)


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, not required) for name, kind, required in columns])


# Six places hold what price lists carry; text with more is refused on load.
PRICE = T.DecimalType(18, 6)
AMOUNT = T.DecimalType(24, 6)

CUSTOMERS = Table(
    "customers",
    _schema(
        ("customer_id", T.LongType(), True),
        ("customer_name", T.StringType(), True),
        ("email", T.StringType(), True),
        ("phone_number", T.StringType(), False),
        ("city", T.StringType(), False),
        ("country", T.StringType(), False),
    ),
    key="customer_id",
    headers={"phone_number": "phone number"},
)

PRODUCTS = Table(
    "products",
    _schema(
        ("product_id", T.LongType(), True),
        ("product_name", T.StringType(), True),
        ("category", T.StringType(), False),
        ("price", PRICE, True),
    ),
    key="product_id",
)

ORDERS = Table(
    "orders",
    _schema(
        ("order_id", T.LongType(), True),
        ("customer_id", T.LongType(), True),
        ("order_date", T.DateType(), True),
        ("status", T.StringType(), False),
    ),
    key="order_id",
    foreign_keys=(ForeignKey("customer_id", "customers", "customer_id"),),
)

ORDER_ITEMS = Table(
    "order_items",
    _schema(
        ("item_id", T.LongType(), True),
        ("order_id", T.LongType(), True),
        ("product_id", T.LongType(), True),
        ("quantity", T.IntegerType(), True),
        ("price", PRICE, True),
    ),
    key="item_id",
    foreign_keys=(
        ForeignKey("order_id", "orders", "order_id"),
        ForeignKey("product_id", "products", "product_id"),
    ),
)

PAYMENTS = Table(
    "payments",
    _schema(
        ("payment_id", T.LongType(), True),
        ("amount", AMOUNT, True),
        ("order_id", T.LongType(), True),
        ("payment_method", T.StringType(), False),
        ("payment_date", T.DateType(), True),
    ),
    key="payment_id",
    foreign_keys=(ForeignKey("order_id", "orders", "order_id"),),
)

TABLES: dict[str, Table] = {t.name: t for t in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)}
