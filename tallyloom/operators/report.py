"""Reports as printed lines, and the data behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import labels
from tallyloom.functions.dates import iso_date
from tallyloom.functions.money import percent_of, reported, round2
from tallyloom.functions.text import dollars, left, percent
from tallyloom.operators.forecast import last_and_growth, projected
from tallyloom.operators.trend import calendar_changes, revenue, rounded_revenue, trend_line

# Colours and series names of the charts, labels and column widths of printed lines.
REVENUE_COLOUR = "#2E86AB"
AVERAGE_COLOUR = "r"
CHANGE_COLOUR = "blue"
LINE_COLOUR = "orange"
FORECAST_COLOUR = labels.GREEN
REVENUE_SERIES = "Monthly Revenue"
AVERAGE_SERIES = "Average"
CHANGE_SERIES = "Revenue Change"
MEAN_CHANGE_SERIES = "Avg Change"
HISTORY_SERIES = "Historical Revenue"
LINE_SERIES = "Trend Line"
FORECAST_SERIES = "Forecast (Next 3 Months)"
PERCENT_SERIES = "Percentage Change"
SUMMARY_LABELS = {
    "total_months": "Total Months Analyzed",
    "total_revenue": "Total Revenue",
    "avg_monthly_revenue": "Average Monthly Revenue",
    "min_monthly_revenue": "Minimum Monthly Revenue",
    "max_monthly_revenue": "Maximum Monthly Revenue",
    "avg_monthly_change": "Average Monthly Change",
    "avg_percent_change": "Average % Change",
}
SLOPE_LABEL = "Overall Slope (Trend)"
SLOPE_UNIT = " per month"
DIRECTION_LABEL = "Trend Direction"
COUNTER_LABELS = {"total_orders": "Total Orders", "matching": "Matching", "mismatching": "Mismatching"}
WIDTHS = {
    "month": 10,
    "monthly_revenue": 14,
    "order_count": 8,
    "previous_month_revenue": 11,
    "revenue_change": 11,
    "percent_change": 9,
    "trend": 12,
    "forecast_next_month": 11,
    "forecast_period": 20,
    "forecasted_revenue": 19,
    "order_id": 10,
    "order_total": 14,
    "payment_amount": 14,
    "status_check": 10,
    "difference": 11,
    "payment_id": 12,
    "amount": 14,
}
UNPAID_LABEL = "Total orders without payments"
ORPHAN_LABEL = "Total orphan payments"


def _text(name: str) -> Column:
    return left(F.col(name).cast("string"), WIDTHS[name])


def _money(name: str, grouped: bool = False) -> Column:
    return dollars(F.col(name), WIDTHS[name], grouped)


def _trend_columns() -> list[Column]:
    return [
        _text("month"),
        _money("monthly_revenue"),
        _text("order_count"),
        _money("previous_month_revenue"),
        _money("revenue_change"),
        percent(F.col("percent_change"), WIDTHS["percent_change"]),
        _text("trend"),
    ]


def formatted_trend(detail: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One fixed-width line per month of the detailed report."""
    line = F.concat_ws(" ", *_trend_columns(), _money("forecast_next_month"))
    return detail.select(*by, "month", line.alias("line"))


def formatted_trend_calendar(calendar: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same without the forecast, for the calendar report."""
    return calendar.select(*by, "month", F.concat_ws(" ", *_trend_columns()).alias("line"))


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label + ": "), value)


def _lines(row: DataFrame, lines: list[Column], by: Sequence[str] = ()) -> DataFrame:
    """Several numbered lines from a frame of one row, or one row for each of ``by``."""
    return row.select(*by, F.posexplode(F.array(*lines)).alias("line_number", "line"))


def formatted_summary(summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lines of a monthly summary, with the change statistics where the frame has them."""

    def shown(name: str) -> Column:
        if name == "total_months":
            return F.col(name).cast("string")
        if name == "avg_percent_change":
            return percent(F.col(name))
        return dollars(F.col(name), grouped=True)

    present = {name: label for name, label in SUMMARY_LABELS.items() if name in summary.columns}
    return _lines(summary, [_labelled(label, shown(name)) for name, label in present.items()], by)


def formatted_slope(slope: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lines of either slope operator."""
    mean_label = SUMMARY_LABELS["avg_monthly_revenue"]
    return _lines(
        slope,
        [
            F.concat(_labelled(SLOPE_LABEL, dollars(F.col("overall_slope"), grouped=True)), F.lit(SLOPE_UNIT)),
            _labelled(mean_label, dollars(F.col("avg_monthly_revenue"), grouped=True)),
            _labelled(DIRECTION_LABEL, F.col("trend_direction")),
        ],
        by,
    )


def formatted_forecast(forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    line = F.concat_ws(" ", _text("forecast_period"), _money("forecasted_revenue", grouped=True))
    return forecast.select(*by, "forecast_period", line.alias("line"))


def formatted_mismatches(mismatches: DataFrame) -> DataFrame:
    """One fixed-width line per mismatch; an unpaid order has no difference to show."""
    line = F.concat_ws(" ", _text("order_id"), _money("order_total"), _money("payment_amount"), _money("difference"))
    return mismatches.select("order_id", line.alias("line"))


def _counted(rows: DataFrame, line: Column, label: str) -> DataFrame:
    """A line for each row and one with their number; ``kind`` tells them apart."""
    total = rows.agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.lit("row").alias("kind"), line.alias("line")).unionByName(
        total.select(F.lit("total").alias("kind"), _labelled(label, F.col("n").cast("string")).alias("line"))
    )


def formatted_unpaid(unpaid: DataFrame) -> DataFrame:
    """Lines of the orders without payments, and their number."""
    return _counted(unpaid, F.concat_ws(" ", _text("order_id"), _money("order_total")), UNPAID_LABEL)


def formatted_orphans(orphans: DataFrame) -> DataFrame:
    """Lines of the payments without orders, and their number."""
    return _counted(orphans, F.concat_ws(" ", _text("payment_id"), _text("order_id"), _money("amount")), ORPHAN_LABEL)


def formatted_reconciliation(reconciliation: DataFrame) -> DataFrame:
    """One fixed-width line per reconciled row; an unpaid order has no difference to show."""
    zero = F.lit(0.0)
    shown = reconciliation.select(
        "order_id",
        F.coalesce("order_total", zero).alias("order_total"),
        F.coalesce("payment_amount", zero).alias("payment_amount"),
        "status_check",
        "difference",
    )
    line = F.concat_ws(
        " ",
        _text("order_id"),
        _money("order_total"),
        _money("payment_amount"),
        _text("status_check"),
        _money("difference"),
    )
    return shown.select("order_id", line.alias("line"))


def formatted_reconciliation_summary(summary: DataFrame) -> DataFrame:
    """The three counter lines of a reconciliation."""

    def shown(name: str) -> Column:
        count = F.col(name).cast("string")
        if f"{name}_percent" not in summary.columns:
            return count
        return F.concat(count, F.lit(" ("), percent(F.col(f"{name}_percent"), places=1), F.lit(")"))

    return _lines(summary, [_labelled(label, shown(name)) for name, label in COUNTER_LABELS.items()])


def _point(panel: int, series: str, date: Column, value: Column, colour: Column | str) -> Column:
    return F.struct(
        F.lit(panel).alias("panel"),
        F.lit(series).alias("series"),
        iso_date(date).alias("month_date"),
        reported(value).alias("value"),
        (F.lit(colour) if isinstance(colour, str) else colour).alias("colour"),
    )


def chart_series(monthly: DataFrame, horizon: int = 3) -> DataFrame:
    """Points of the four charts in long form.

    1 revenue and its mean; 2 change coloured by sign and the mean change; 3 revenue, fitted line
    and forecast; 4 percent change coloured by sign.
    """
    whole = Window.partitionBy()
    changes = trend_line(calendar_changes(monthly)).withColumn(
        "change_percent",
        F.coalesce(round2(percent_of(revenue() - F.col("previous_revenue"), F.col("previous_revenue"))), F.lit(0)),
    )
    change = F.round("change", 2)
    moved = F.when(change != 0, change)
    annotated = changes.select(
        "*",
        (F.sum(rounded_revenue()).over(whole).cast("double") / F.col("months")).alias("mean_revenue"),
        F.coalesce(
            F.sum(moved).over(whole).cast("double") / F.nullif(F.count(moved).over(whole), F.lit(0).cast("bigint")),
            F.lit(0.0),
        ).alias("mean_change"),
    )
    at = F.col("month_start")
    fitted = F.when(F.col("months") > 1, F.col("fitted"))
    history = annotated.select(
        F.inline(
            F.array(
                _point(1, REVENUE_SERIES, at, revenue(), REVENUE_COLOUR),
                _point(1, AVERAGE_SERIES, at, F.col("mean_revenue"), AVERAGE_COLOUR),
                _point(2, CHANGE_SERIES, at, change, labels.sign_colour(change)),
                _point(2, MEAN_CHANGE_SERIES, at, F.col("mean_change"), CHANGE_COLOUR),
                _point(3, HISTORY_SERIES, at, revenue(), REVENUE_COLOUR),
                _point(3, LINE_SERIES, at, fitted, LINE_COLOUR),
                _point(4, PERCENT_SERIES, at, F.col("change_percent"), labels.sign_colour(F.col("change_percent"))),
            )
        )
    ).where(F.col("value").isNotNull())
    ahead = (
        last_and_growth(monthly)
        .where(F.col("last_start").isNotNull())
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(horizon))))
        .select(
            F.inline(
                F.array(
                    _point(3, FORECAST_SERIES, F.add_months("last_start", F.col("step")), projected(), FORECAST_COLOUR)
                )
            )
        )
    )
    return history.unionByName(ahead)
