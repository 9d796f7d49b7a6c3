"""Straight-line forecasts of the next months.

One aggregate row is expanded by ``explode(sequence(...))``, so the series is computed once for
any horizon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import iso_date
from tallyloom.functions.money import mean, reported
from tallyloom.operators.summary import nonzero_mean
from tallyloom.operators.trend import calendar_changes, revenue, rounded_revenue

# Fixed value: label of a forecast row, before its number.
PERIOD_LABEL = "Forecast Month "


def _steps(frame: DataFrame, first: int, horizon: int) -> DataFrame:
    return frame.withColumn("step", F.explode(F.sequence(F.lit(first), F.lit(horizon))))


def _period() -> Column:
    return F.concat(F.lit(PERIOD_LABEL), F.col("step").cast("string")).alias("forecast_period")


def forecast_from_max(monthly: DataFrame, by: Sequence[str] = (), horizon: int = 3) -> DataFrame:
    """Greatest month plus k times the mean step between months present.

    The steps add up to last minus first, so no window is needed.
    """
    rise = F.max_by(revenue(), "month_start") - F.min_by(revenue(), "month_start")
    base = monthly.groupBy(*by).agg(
        F.max(revenue()).cast("double").alias("start"),
        mean(rise, F.count(F.lit(1)) - 1).alias("growth"),
    )
    return _steps(base, 1, horizon).select(
        *by, _period(), reported(F.col("start") + F.col("growth") * F.col("step")).alias("forecasted_revenue")
    )


def last_and_growth(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Last month, its rounded revenue, and the mean non-zero calendar change."""
    return (
        calendar_changes(monthly, by)
        .groupBy(*by)
        .agg(
            F.max("month_start").alias("last_start"),
            F.coalesce(F.max_by(rounded_revenue(), "month_start").cast("double"), F.lit(0.0)).alias("start"),
            nonzero_mean(F.round("change", 2)).alias("growth"),
        )
    )


def projected() -> Column:
    """Last revenue plus ``step`` times the mean change."""
    return F.col("start") + F.col("growth") * F.col("step")


def forecast_from_last(monthly: DataFrame, by: Sequence[str] = (), horizon: int = 3) -> DataFrame:
    """Last month plus k times the mean non-zero calendar change."""
    return _steps(last_and_growth(monthly, by), 1, horizon).select(
        *by, _period(), reported(projected()).alias("forecasted_revenue")
    )


def forecast_series_dated(monthly: DataFrame, by: Sequence[str] = (), horizon: int = 3) -> DataFrame:
    """The last actual month followed by the forecasts, each on the first of its month."""
    points = _steps(last_and_growth(monthly, by), 0, horizon).where(F.col("last_start").isNotNull())
    return points.select(
        *by,
        iso_date(F.add_months("last_start", F.col("step"))).alias("month_date"),
        F.when(F.col("step") == 0, "actual").otherwise("forecast").alias("kind"),
        reported(projected()).alias("revenue"),
    )
