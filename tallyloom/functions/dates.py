"""Date parsing and month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts, tried in this order. Day and month may be
# unpadded; the year has four digits and is not zero.
DATE_LAYOUTS = (
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}$"),
    ("yyyy-M-d", r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"),
)


def parse_date(text: Column) -> Column:
    """Month/day/year, else ISO, else NULL."""
    return F.coalesce(
        *[F.when(text.rlike(shape), F.try_to_date(text, layout)) for layout, shape in DATE_LAYOUTS]
    )


def slash_date(date: Column) -> Column:
    """The ``MM/DD/YYYY`` text that the CSV files carry."""
    return F.date_format(date, "MM/dd/yyyy")


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def month_labels(start: Column) -> list[Column]:
    """``month`` (YYYY-MM), ``year`` and ``month_num`` as text."""
    return [
        F.date_format(start, "yyyy-MM").alias("month"),
        F.date_format(start, "yyyy").alias("year"),
        F.date_format(start, "MM").alias("month_num"),
    ]
