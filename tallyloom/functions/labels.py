"""Labels and colours derived from the sign of a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts and colours.
GROWING = "↑ Growing"
DECLINING = "↓ Declining"
STABLE = "→ Stable"
UNKNOWN = "N/A"
UP = "↑"
DOWN = "↓"
LEVEL = "→"
POSITIVE_TREND = "Positive Trend (Growing)"
NEGATIVE_TREND = "Negative Trend (Declining)"
STABLE_TREND = "Stable"
GREEN = "#28a745"
RED = "#dc3545"
GREY = "#6c757d"


def by_sign(value: Column, positive: str, negative: str, other: str) -> Column:
    return F.when(value > 0, positive).when(value < 0, negative).otherwise(other)


def trend_label(change: Column) -> Column:
    """Four-way label; an unknown change is N/A."""
    return (
        F.when(change > 0, GROWING)
        .when(change < 0, DECLINING)
        .when(change == 0, STABLE)
        .otherwise(UNKNOWN)
    )


def trend_label_or_stable(change: Column) -> Column:
    return by_sign(change, GROWING, DECLINING, STABLE)


def trend_arrow(change: Column) -> Column:
    return by_sign(change, UP, DOWN, LEVEL)


def series_direction(slope: Column) -> Column:
    return by_sign(slope, POSITIVE_TREND, NEGATIVE_TREND, STABLE_TREND)


def sign_colour(value: Column) -> Column:
    return by_sign(value, GREEN, RED, GREY)
