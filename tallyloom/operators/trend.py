"""Reports over the monthly revenue series.

Each takes the frame ``monthly_revenue`` returns and the same ``by`` columns. With ``by=()`` the
windows have no partition key and run in one task: the input is one row per calendar month, at
most twelve a year, never fact rows. ``previous`` has two meanings that are kept apart: the
previous month *present* in the series, and the previous *calendar* month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyloom.functions import labels
from tallyloom.functions.dates import month_labels
from tallyloom.functions.money import mean, percent_of, reported, round2


def _series(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy("month_start")


def _whole(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by)


def _ordered(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    return frame.orderBy(*by, "month_start")


def revenue() -> Column:
    return F.col("total_revenue")


def rounded_revenue() -> Column:
    """Revenue at the two places the reports show, still exact."""
    return round2(revenue())


def zero() -> Column:
    return F.lit(0).cast("decimal(1,0)")


def with_previous(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add revenue and label of the previous month present, NULL for the first month."""
    series = _series(by)
    return monthly.select(
        "*",
        F.lag("total_revenue").over(series).alias("previous_revenue"),
        F.lag("month_start").over(series).alias("previous_start"),
    )


def monthly_with_previous(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _ordered(with_previous(monthly, by), by).select(
        *by,
        *month_labels(F.col("month_start")),
        revenue().cast("double").alias("total_revenue"),
        "order_count",
        F.col("previous_revenue").cast("double").alias("previous_month_revenue"),
        F.date_format("previous_start", "yyyy-MM").alias("previous_month"),
    )


def monthly_moving_avg(monthly: DataFrame, by: Sequence[str] = (), months: int = 3) -> DataFrame:
    """Mean of the current and the preceding rows of the series, ``months`` in all."""
    frame = _series(by).rowsBetween(-(months - 1), 0)
    smoothed = mean(F.sum(revenue()).over(frame), F.count(revenue()).over(frame))
    return _ordered(monthly.select("*", smoothed.alias("smoothed")), by).select(
        *by,
        F.date_format("month_start", "yyyy-MM").alias("month"),
        reported(revenue()).alias("monthly_revenue"),
        reported(F.col("smoothed")).alias("moving_avg"),
    )


def monthly_trend_detail(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The detailed trend report: change, percent, label, next-month forecast, running slope.

    The first month's change is its whole revenue. The mean change is rounded before the
    forecast adds it.
    """
    series = _series(by)
    running = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous, change = F.col("previous_revenue"), F.col("change")
    changes = with_previous(monthly, by).withColumn("change", revenue() - F.coalesce(previous, zero()))
    placed = changes.select(
        "*",
        round2(mean(F.sum(change).over(running), F.count(change).over(running))).alias("mean_change"),
        F.first("total_revenue").over(running).alias("first_revenue"),
        F.row_number().over(series).alias("position"),
    )
    steps = F.nullif(F.col("position") - 1, F.lit(0))
    slope = (revenue() - F.col("first_revenue")).cast("double") / steps
    return _ordered(placed, by).select(
        *by,
        *month_labels(F.col("month_start")),
        reported(revenue()).alias("monthly_revenue"),
        "order_count",
        reported(F.coalesce(previous, zero())).alias("previous_month_revenue"),
        reported(F.coalesce(change, zero())).alias("revenue_change"),
        F.coalesce(reported(percent_of(revenue() - previous, previous)), F.lit(0.0)).alias("percent_change"),
        labels.trend_label(change).alias("trend"),
        reported(revenue() + F.coalesce("mean_change", zero())).alias("forecast_next_month"),
        reported(slope).alias("estimated_slope"),
    )


def monthly_trend_alt(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The alternative report: smoothing over three months and one growth rate for the series."""
    last_three = _series(by).rowsBetween(-2, 0)
    whole = _whole(by)
    previous, growth = F.col("previous_revenue"), F.col("growth")
    stepped = with_previous(monthly, by).withColumn("step", revenue() - previous)
    measured = stepped.select(
        "*",
        round2(mean(F.sum(revenue()).over(last_three), F.count(revenue()).over(last_three))).alias("smoothed"),
        round2(mean(F.sum("step").over(whole), F.count("step").over(whole))).alias("growth"),
    )
    change = revenue() - F.coalesce(previous, zero())
    return _ordered(measured, by).select(
        *by,
        F.date_format("month_start", "yyyy-MM").alias("month"),
        reported(revenue()).alias("monthly_revenue"),
        reported(F.coalesce(previous, zero())).alias("previous_month"),
        reported(change).alias("change_from_prev"),
        F.col("smoothed").cast("double").alias("moving_avg_3mo"),
        growth.cast("double").alias("avg_monthly_growth"),
        reported(revenue() + growth).alias("forecast_next_month"),
        labels.trend_arrow(change).alias("trend"),
    )


def calendar_changes(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Compare with the previous *calendar* month; a gap compares with zero.

    Months are unique and ordered, so the calendar predecessor, where present, is the row just
    before: one window does what a self-join on year and month would.
    """
    follows = F.col("previous_start") == F.add_months("month_start", -1)
    changes = with_previous(monthly, by).withColumn(
        "previous_revenue", F.when(follows, F.col("previous_revenue"))
    )
    return changes.withColumn("change", revenue() - F.coalesce("previous_revenue", zero()))


def _calendar_percent() -> Column:
    previous = F.col("previous_revenue")
    return F.coalesce(reported(percent_of(revenue() - previous, previous)), F.lit(0.0))


def monthly_trend_calendar(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _ordered(calendar_changes(monthly, by), by).select(
        *by,
        F.date_format("month_start", "yyyy-MM").alias("month"),
        reported(revenue()).alias("monthly_revenue"),
        "order_count",
        reported(F.coalesce("previous_revenue", zero())).alias("previous_month_revenue"),
        reported(F.col("change")).alias("revenue_change"),
        _calendar_percent().alias("percent_change"),
        labels.trend_label_or_stable(F.col("change")).alias("trend"),
    )


def trend_line(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the least-squares line through rounded revenue at x = 0, 1, 2, ...

    The sums are exact decimals and only the last division is in double, so the line does not
    depend on the order in which rows are added.
    """
    whole = _whole(by)
    x, y, n = F.col("x"), F.col("y"), F.col("months")
    points = monthly.select(
        "*", (F.row_number().over(_series(by)) - 1).cast("bigint").alias("x"), rounded_revenue().alias("y")
    )
    sums = points.select(
        "*",
        F.count(y).over(whole).alias("months"),
        F.sum(x).over(whole).alias("sum_x"),
        F.sum(x * x).over(whole).alias("sum_xx"),
        F.sum(y).over(whole).alias("sum_y"),
        F.sum(x * y).over(whole).alias("sum_xy"),
    )
    rise = n * F.col("sum_xy") - F.col("sum_x") * F.col("sum_y")
    run = n * F.col("sum_xx") - F.col("sum_x") * F.col("sum_x")
    slope = F.col("slope")
    return (
        sums.withColumn("slope", mean(rise, run))
        .withColumn("intercept", (F.col("sum_y").cast("double") - slope * F.col("sum_x")) / n)
        .withColumn("fitted", F.col("intercept") + slope * x)
    )


def trend_line_ols(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and fitted value per month; nothing for a single month."""
    fitted = trend_line(monthly, by).where(F.col("months") > 1)
    return _ordered(fitted, by).select(
        *by,
        F.date_format("month_start", "yyyy-MM").alias("month"),
        F.col("y").cast("double").alias("monthly_revenue"),
        F.round(F.col("slope").cast("decimal(38,6)"), 4).cast("double").alias("slope"),
        F.round(F.col("intercept").cast("decimal(38,6)"), 4).cast("double").alias("intercept"),
        reported(F.col("fitted")).alias("trend_line"),
    )
