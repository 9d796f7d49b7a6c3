"""One-row statistics of the monthly series (one row per ``by`` group)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import labels
from tallyloom.functions.money import mean, percent_of, reported
from tallyloom.operators.trend import calendar_changes, revenue, rounded_revenue, with_previous


def _revenue_statistics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_months"),
        reported(F.sum(revenue())).alias("total_revenue"),
        reported(mean(F.sum(revenue()), F.count(revenue()))).alias("avg_monthly_revenue"),
        reported(F.min(revenue())).alias("min_monthly_revenue"),
        reported(F.max(revenue())).alias("max_monthly_revenue"),
    ]


def monthly_summary(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, sum, mean, least and greatest over all months."""
    return monthly.groupBy(*by).agg(*_revenue_statistics())


def monthly_change_summary(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same over months that have a predecessor, with mean change and mean percent.

    The first month is excluded from every statistic.
    """
    previous = F.col("previous_revenue")
    compared = with_previous(monthly, by).where(previous.isNotNull())
    change = revenue() - previous
    return compared.groupBy(*by).agg(
        *_revenue_statistics(),
        reported(mean(F.sum(change), F.count(change))).alias("avg_monthly_change"),
        reported(F.avg(percent_of(change, previous))).alias("avg_percent_change"),
    )


def trend_range_slope(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(greatest - least) over the month steps: never negative, NULL for a single month.

    Positions run 1..n, so their span is the count less one.
    """
    stats = monthly.groupBy(*by).agg(
        mean(F.max(revenue()) - F.min(revenue()), F.count(F.lit(1)) - 1).alias("slope"),
        reported(mean(F.sum(revenue()), F.count(revenue()))).alias("avg_monthly_revenue"),
    )
    return stats.select(
        *by,
        reported(F.col("slope")).alias("overall_slope"),
        "avg_monthly_revenue",
        labels.series_direction(F.col("slope")).alias("trend_direction"),
    )


def trend_endpoint_slope(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(last - first) over the month steps on rounded revenue; zero for a single month."""
    shown = rounded_revenue()
    rise = F.max_by(shown, "month_start") - F.min_by(shown, "month_start")
    stats = monthly.groupBy(*by).agg(
        F.count(F.lit(1)).alias("months"),
        F.coalesce(mean(rise, F.count(F.lit(1)) - 1), F.lit(0.0)).alias("slope"),
        reported(mean(F.sum(shown), F.count(F.lit(1)))).alias("avg_monthly_revenue"),
    )
    return stats.where(F.col("months") > 0).select(
        *by,
        reported(F.col("slope")).alias("overall_slope"),
        "avg_monthly_revenue",
        labels.series_direction(F.col("slope")).alias("trend_direction"),
    )


def nonzero_mean(change: Column) -> Column:
    """Aggregate: mean of the changes that are not zero, 0 where there is none."""
    moved = F.when(change != 0, change)
    return F.coalesce(mean(F.sum(moved), F.count(moved)), F.lit(0.0))


def avg_nonzero_change(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean non-zero calendar change of rounded revenue; the first month counts in full."""
    changes = calendar_changes(monthly, by)
    return changes.groupBy(*by).agg(
        reported(nonzero_mean(F.round("change", 2))).alias("avg_monthly_change")
    )
