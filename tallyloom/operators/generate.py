"""Synthetic tables. Every value is a function of its key, so a lost task repeats exactly.

Each operator takes a frame of keys, one row per row to make; ``key_range`` gives 1..n. Counts of
other tables may be integers or scalar subqueries.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.mix import pick, pick_int, pick_wide, wide
from tallyloom.operators.revenue import item_totals
from tallyloom.schemas import AMOUNT, PRICE

# Domains and ranges of the generated tables.
CATEGORIES = ["Electronics", "Clothing", "Books", "Home & Kitchen", "Sports", "Toys", "Beauty", "Food"]
PAYMENT_METHODS = ["UPI", "Card", "Wallet", "Net Banking", "Cash on Delivery"]
ORDER_STATUSES = ["pending", "processing", "shipped", "delivered", "cancelled"]
START_DATE = datetime.date(2006, 1, 1)
END_DATE = datetime.date(2007, 12, 31)
PRICE_CENTS = (1_000, 100_000)
QUANTITY = (1, 5)
ITEMS_PER_ORDER = (1, 5)
PRICE_FACTOR_BASIS_POINTS = (9_000, 11_000)
DAYS_TO_PAYMENT = (0, 7)
DEFAULT_PAYMENT_CENTS = (5_000, 50_000)

# Word lists for texts, which carry no meaning.
FIRST_NAMES = ["Ada", "Boris", "Chen", "Dalia", "Emil", "Farah", "Goran", "Hana", "Ivo", "Jaya", "Kofi", "Lena"]
LAST_NAMES = ["Abara", "Berg", "Costa", "Dimov", "Eriksen", "Fischer", "Gupta", "Haddad", "Ito", "Jansen", "Khan"]
CITIES = ["Lisbon", "Osaka", "Nairobi", "Quito", "Tallinn", "Hanoi", "Bergen", "Accra", "Lima", "Tunis", "Perth"]
COUNTRIES = ["Portugal", "Japan", "Kenya", "Ecuador", "Estonia", "Vietnam", "Norway", "Ghana", "Peru", "Tunisia"]
ADJECTIVES = ["Compact", "Durable", "Foldable", "Modular", "Portable", "Quiet", "Robust", "Slim", "Smart"]
NOUNS = ["lamp", "charger", "backpack", "kettle", "racket", "puzzle", "notebook", "speaker", "scarf", "blender"]

# Primes above any product count: a step of one of them visits distinct products.
STEPS = [1_000_000_000_039, 1_000_000_000_061, 1_000_000_000_063, 1_000_000_000_091]


def key_range(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def _money(cents: Column, kind: T.DecimalType = PRICE) -> Column:
    return (cents.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def gen_customers(keys: DataFrame) -> DataFrame:
    key = F.col("id")
    first, last = pick(key, 11, FIRST_NAMES), pick(key, 12, LAST_NAMES)
    return keys.select(
        key.alias("customer_id"),
        F.concat_ws(" ", first, last).alias("customer_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(pick_int(key, 13, 0, 9_999_999).cast("string"), 7, "0")).alias(
            "phone_number"
        ),
        pick(key, 14, CITIES).alias("city"),
        pick(key, 15, COUNTRIES).alias("country"),
    )


def gen_products(keys: DataFrame) -> DataFrame:
    """Prices are uniform over 10.00..1000.00."""
    key = F.col("id")
    return keys.select(
        key.alias("product_id"),
        F.concat_ws(" ", pick(key, 21, ADJECTIVES), pick(key, 22, NOUNS)).alias("product_name"),
        pick(key, 23, CATEGORIES).alias("category"),
        _money(pick_int(key, 24, *PRICE_CENTS)).alias("price"),
    )


def gen_orders(
    keys: DataFrame,
    customers: int | Column,
    start: datetime.date = START_DATE,
    end: datetime.date = END_DATE,
) -> DataFrame:
    """``customers`` is the number of customers, whose ids run 1..customers."""
    key = F.col("id")
    offset = pick_int(key, 32, 0, (end - start).days).cast("int")
    return keys.select(
        key.alias("order_id"),
        pick_wide(key, 31, 1, customers).alias("customer_id"),
        F.date_add(F.lit(start), offset).alias("order_date"),
        pick(key, 33, ORDER_STATUSES).alias("status"),
    )


def gen_order_items(
    orders: DataFrame,
    products: DataFrame,
    product_count: int | Column,
    least: int = ITEMS_PER_ORDER[0],
    most: int = ITEMS_PER_ORDER[1],
) -> DataFrame:
    """Distinct products per order, unit price within ten percent of the product's price.

    Products of an order start at a mixed position and step by a prime, modulo the product count,
    so they differ without comparing them. ``item_id`` is unique by construction.
    """
    order = F.col("order_id")
    count = F.lit(product_count).cast("bigint") if isinstance(product_count, int) else product_count
    drawn = orders.select("order_id", count.alias("n")).select(
        "order_id",
        "n",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(pick_int(order, 41, least, most), F.col("n")))).alias(
            "slot"
        ),
    )
    steps = F.array(*[F.lit(s).cast("bigint") for s in STEPS])
    step = F.element_at(steps, pick_int(order, 43, 1, len(STEPS)).cast("int"))
    item = order * most + F.col("slot") - most
    placed = drawn.select(
        item.alias("item_id"),
        "order_id",
        ((wide(order, 42) + F.col("slot") * step) % F.col("n") + 1).alias("product_id"),
    )
    key = F.col("item_id")
    list_cents = F.round(F.col("price") * 100, 0).cast("bigint")
    cents = F.floor((list_cents * pick_int(key, 45, *PRICE_FACTOR_BASIS_POINTS) + 5_000) / 10_000)
    return placed.join(products.select("product_id", "price"), "product_id").select(
        "item_id",
        "order_id",
        "product_id",
        pick_int(key, 44, *QUANTITY).cast("int").alias("quantity"),
        _money(cents).alias("price"),
    )


def gen_payments(orders: DataFrame, items: DataFrame, end: datetime.date = END_DATE) -> DataFrame:
    """One payment per order, up to seven days later but within the range.

    An order without items pays a uniform 50.00..500.00.
    """
    order = F.col("order_id")
    default = _money(pick_int(order, 51, *DEFAULT_PAYMENT_CENTS), AMOUNT)
    paid_on = F.date_add("order_date", pick_int(order, 52, *DAYS_TO_PAYMENT).cast("int"))
    total = F.round("order_total", 2).cast(AMOUNT)
    return (
        orders.select("order_id", "order_date")
        .join(item_totals(items), "order_id", "left")
        .select(
            order.alias("payment_id"),
            F.coalesce(total, default).alias("amount"),
            "order_id",
            pick(order, 53, PAYMENT_METHODS).alias("payment_method"),
            F.least(paid_on, F.lit(end)).alias("payment_date"),
        )
    )
