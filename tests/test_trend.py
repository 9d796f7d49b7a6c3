"""Monthly reports on hand-written series."""

import pytest
from conftest import rows

from tallyloom.operators import forecast, report, summary, trend
from tallyloom.operators.revenue import monthly_revenue

# Revenue and order count of 24 months, with the values below derived by exact decimals.
MONTHS_2006 = (
    "16975.69 3|36330.01 6|51747.02 11|41104.26 8|54216.05 10|42416.20 10|"
    "71157.26 11|22471.96 9|42395.54 6|65613.56 12|27783.90 4|15255.14 4"
)
MONTHS_2007 = (
    "23285.07 6|37970.75 8|46636.38 8|42732.20 7|47800.04 11|56969.80 10|"
    "55740.03 13|62893.61 11|27456.47 7|52834.42 11|23199.91 6|42152.47 8"
)


def two_years():
    found = []
    for year, text in (("2006", MONTHS_2006), ("2007", MONTHS_2007)):
        for month, entry in enumerate(text.split("|"), 1):
            revenue, count = entry.split()
            found.append((f"{year}-{month:02d}", revenue, int(count)))
    return found


GAPPED = [("2020-01", "100.00", 1), ("2020-03", "150.00", 1), ("2020-12", "90.00", 2), ("2021-01", "120.00", 1)]
DECLINING = [("2020-01", "300.00", 1), ("2020-02", "200.00", 1), ("2020-03", "50.00", 1)]


def test_detail_of_two_years(series):
    report_rows = rows(trend.monthly_trend_detail(series(*two_years())))
    assert [r["month"] for r in report_rows[:2]] == ["2006-01", "2006-02"]
    first, second, third = report_rows[:3]
    assert (first["revenue_change"], first["percent_change"], first["estimated_slope"]) == (16975.69, 0.0, None)
    assert (second["revenue_change"], second["percent_change"]) == (19354.32, 114.01)
    # The running mean change is exactly 18165.005 and rounds away from zero before it is added.
    assert second["forecast_next_month"] == 54495.02
    assert third["estimated_slope"] == 17385.67
    assert second["trend"] == "↑ Growing"
    assert report_rows[3]["trend"] == "↓ Declining"
    assert (second["year"], second["month_num"]) == ("2006", "02")


def test_summaries_of_two_years(series):
    monthly = series(*two_years())
    whole = rows(summary.monthly_summary(monthly))[0]
    assert whole == {
        "total_months": 24,
        "total_revenue": 1007137.74,
        "avg_monthly_revenue": 41964.07,
        "min_monthly_revenue": 15255.14,
        "max_monthly_revenue": 71157.26,
    }
    compared = rows(summary.monthly_change_summary(monthly))[0]
    assert compared == {
        "total_months": 23,
        "total_revenue": 990162.05,
        "avg_monthly_revenue": 43050.52,
        "min_monthly_revenue": 15255.14,
        "max_monthly_revenue": 71157.26,
        "avg_monthly_change": 1094.64,
        "avg_percent_change": 18.24,
    }


def test_slopes_and_line_of_two_years(series):
    monthly = series(*two_years())
    ranged = rows(summary.trend_range_slope(monthly))[0]
    assert (ranged["overall_slope"], ranged["trend_direction"]) == (2430.53, "Positive Trend (Growing)")
    ends = rows(summary.trend_endpoint_slope(monthly))[0]
    assert (ends["overall_slope"], ends["avg_monthly_revenue"]) == (1094.64, 41964.07)
    line = rows(trend.trend_line_ols(monthly))
    assert line[0]["slope"] == pytest.approx(179.698722, abs=1e-4)
    assert line[0]["intercept"] == pytest.approx(39897.5372, abs=1e-4)
    assert line[23]["trend_line"] == pytest.approx(39897.5372 + 23 * 179.698722, abs=0.01)


def test_line_equals_spark_regression(spark, series):
    monthly = series(*GAPPED)
    line = rows(trend.trend_line_ols(monthly))[0]
    points = spark.createDataFrame([(float(i), float(r)) for i, (_, r, _) in enumerate(GAPPED)], "x double, y double")
    slope, intercept = points.selectExpr("regr_slope(y, x)", "regr_intercept(y, x)").first()
    assert line["slope"] == pytest.approx(slope, abs=1e-4)
    assert line["intercept"] == pytest.approx(intercept, abs=1e-4)


def test_forecasts_of_two_years(series):
    monthly = series(*two_years())
    best = rows(forecast.forecast_from_max(monthly))
    assert [(r["forecast_period"], r["forecasted_revenue"]) for r in best] == [
        ("Forecast Month 1", 72251.90),
        ("Forecast Month 2", 73346.55),
        ("Forecast Month 3", 74441.19),
    ]
    assert rows(summary.avg_nonzero_change(monthly)) == [{"avg_monthly_change": 1756.35}]
    last = rows(forecast.forecast_from_last(monthly))
    assert [r["forecasted_revenue"] for r in last] == [43908.82, 45665.18, 47421.53]
    dated = rows(forecast.forecast_series_dated(monthly))
    assert [(r["month_date"], r["kind"]) for r in dated] == [
        ("2007-12-01", "actual"),
        ("2008-01-01", "forecast"),
        ("2008-02-01", "forecast"),
        ("2008-03-01", "forecast"),
    ]
    assert dated[0]["revenue"] == 42152.47


def test_moving_average_and_alternative(series):
    monthly = series(*two_years())
    smoothed = rows(trend.monthly_moving_avg(monthly))
    assert [r["moving_avg"] for r in smoothed[:3]] == [16975.69, 26652.85, 35017.57]
    alternative = rows(trend.monthly_trend_alt(monthly))
    assert {r["avg_monthly_growth"] for r in alternative} == {1094.64}
    assert alternative[0]["change_from_prev"] == 16975.69
    assert alternative[0]["forecast_next_month"] == 18070.33
    assert [r["trend"] for r in alternative[:4]] == ["↑", "↑", "↑", "↓"]


def test_previous_present_and_previous_calendar_month_differ_at_gaps(series):
    monthly = series(*GAPPED)
    present = rows(trend.monthly_with_previous(monthly))
    assert [r["previous_month"] for r in present] == [None, "2020-01", "2020-03", "2020-12"]
    calendar = rows(trend.monthly_trend_calendar(monthly))
    # Only January follows directly on the month before it.
    assert [r["previous_month_revenue"] for r in calendar] == [0.0, 0.0, 0.0, 90.0]
    assert [r["percent_change"] for r in calendar] == [0.0, 0.0, 0.0, 33.33]
    assert [r["revenue_change"] for r in calendar] == [100.0, 150.0, 90.0, 30.0]


def test_both_meanings_agree_without_gaps(series):
    monthly = series(*two_years())
    detail, calendar = rows(trend.monthly_trend_detail(monthly)), rows(trend.monthly_trend_calendar(monthly))
    for column in ("month", "monthly_revenue", "previous_month_revenue", "revenue_change", "percent_change", "trend"):
        assert [r[column] for r in detail] == [r[column] for r in calendar]


def test_stable_months(series):
    monthly = series(("2020-01", "10.00", 1), ("2020-02", "10.00", 1))
    assert [r["trend"] for r in rows(trend.monthly_trend_detail(monthly))] == ["↑ Growing", "→ Stable"]
    assert [r["trend"] for r in rows(trend.monthly_trend_alt(monthly))] == ["↑", "→"]
    assert rows(summary.avg_nonzero_change(monthly)) == [{"avg_monthly_change": 10.0}]


def test_percent_of_a_zero_month(series):
    monthly = series(("2020-01", "0.00", 1), ("2020-02", "5.00", 1))
    assert [r["percent_change"] for r in rows(trend.monthly_trend_detail(monthly))] == [0.0, 0.0]
    assert rows(summary.monthly_change_summary(monthly))[0]["avg_percent_change"] is None


def test_falling_series_has_a_positive_range_slope(series):
    monthly = series(*DECLINING)
    assert rows(summary.trend_range_slope(monthly))[0]["overall_slope"] == 125.0
    ends = rows(summary.trend_endpoint_slope(monthly))[0]
    assert (ends["overall_slope"], ends["trend_direction"]) == (-125.0, "Negative Trend (Declining)")
    assert rows(trend.trend_line_ols(monthly))[0]["slope"] == -125.0


def test_unknown_revenue_is_labelled(series, spark):
    monthly = series(("2020-01", "5.00", 1)).selectExpr(
        "month_start", "CAST(NULL AS decimal(38,2)) AS total_revenue", "order_count"
    )
    assert rows(trend.monthly_trend_detail(monthly))[0]["trend"] == "N/A"


def test_single_month(series):
    monthly = series(("2020-05", "42.00", 1))
    assert rows(summary.trend_range_slope(monthly))[0] == {
        "overall_slope": None,
        "avg_monthly_revenue": 42.0,
        "trend_direction": "Stable",
    }
    assert rows(summary.trend_endpoint_slope(monthly))[0]["overall_slope"] == 0.0
    assert rows(trend.trend_line_ols(monthly)) == []
    assert rows(trend.monthly_trend_alt(monthly))[0]["forecast_next_month"] is None
    assert [r["forecasted_revenue"] for r in rows(forecast.forecast_from_max(monthly))] == [None] * 3
    assert [r["forecasted_revenue"] for r in rows(forecast.forecast_from_last(monthly))] == [84.0, 126.0, 168.0]
    assert rows(summary.monthly_change_summary(monthly))[0]["total_months"] == 0
    assert "Trend Line" not in {r["series"] for r in rows(report.chart_series(monthly))}


def test_no_months(series, spark):
    monthly = series(("2020-05", "42.00", 1)).where("false")
    assert rows(trend.monthly_trend_detail(monthly)) == []
    assert rows(summary.monthly_summary(monthly))[0]["total_months"] == 0
    assert rows(summary.trend_endpoint_slope(monthly)) == []
    assert rows(summary.avg_nonzero_change(monthly)) == [{"avg_monthly_change": 0.0}]
    assert [r["forecasted_revenue"] for r in rows(forecast.forecast_from_last(monthly))] == [0.0] * 3
    assert rows(forecast.forecast_series_dated(monthly)) == []
    assert rows(report.chart_series(monthly)) == []


@pytest.mark.parametrize(
    ("last", "expected"),
    [
        ("2020-10", ["2020-11-01", "2020-12-01", "2021-01-01"]),
        ("2020-11", ["2020-12-01", "2021-01-01", "2021-02-01"]),
        ("2020-12", ["2021-01-01", "2021-02-01", "2021-03-01"]),
    ],
)
def test_forecast_dates_cross_the_year(series, last, expected):
    dated = rows(forecast.forecast_series_dated(series((last, "1.00", 1))))
    assert [r["month_date"] for r in dated if r["kind"] == "forecast"] == expected


def test_horizon_is_free(series):
    assert len(rows(forecast.forecast_from_max(series(*DECLINING), horizon=12))) == 12


def test_monthly_revenue_joins_counts_and_filters(sales):
    orders, items, _ = sales(
        [
            (1, "2020-01-05", "delivered"),
            (2, "2020-01-31", "cancelled"),
            (3, "2020-02-01", "pending"),
            (4, "2020-02-02", "pending"),
        ],
        [(1, 1, 2, "10.00"), (1, 2, 1, "0.50"), (2, 1, 1, "4.25"), (3, 1, 3, "1.00"), (9, 1, 9, "9.00")],
    )
    found = {r["month_start"].isoformat(): r for r in rows(monthly_revenue(orders, items))}
    assert float(found["2020-01-01"]["total_revenue"]) == 24.75
    assert found["2020-01-01"]["order_count"] == 2
    assert found["2020-02-01"]["order_count"] == 1
    kept = rows(monthly_revenue(orders, items, where=orders["status"] != "cancelled"))
    assert sorted(float(r["total_revenue"]) for r in kept) == [3.0, 20.5]


def test_series_by_columns_of_either_table(sales):
    orders, items, _ = sales(
        [(1, "2020-01-05", "a"), (2, "2020-01-06", "b"), (3, "2020-02-06", "a")],
        [(1, 7, 1, "1.00"), (1, 8, 1, "2.00"), (2, 7, 1, "4.00"), (3, 7, 2, "8.00")],
    )
    monthly = monthly_revenue(orders, items, by=["status", "product_id"])
    found = {
        (r["status"], r["product_id"], r["month_start"].month): (float(r["total_revenue"]), r["order_count"])
        for r in rows(monthly)
    }
    assert found == {("a", 7, 1): (1.0, 1), ("a", 8, 1): (2.0, 1), ("b", 7, 1): (4.0, 1), ("a", 7, 2): (16.0, 1)}
    detail = rows(trend.monthly_trend_detail(monthly, ["status", "product_id"]))
    changes = {(r["status"], r["product_id"], r["month"]): r["revenue_change"] for r in detail}
    assert changes[("a", 7, "2020-02")] == 15.0
    assert changes[("b", 7, "2020-01")] == 4.0
    slopes = rows(summary.trend_endpoint_slope(monthly, ["status", "product_id"]))
    assert {(r["status"], r["product_id"]): r["overall_slope"] for r in slopes}[("a", 7)] == 15.0
    assert len(rows(forecast.forecast_from_last(monthly, ["status", "product_id"]))) == 9


def test_chart_points(series):
    points = rows(report.chart_series(series(*DECLINING)))
    colours = {(r["series"], r["month_date"]): r["colour"] for r in points}
    assert colours[("Revenue Change", "2020-01-01")] == "#28a745"
    assert colours[("Revenue Change", "2020-02-01")] == "#dc3545"
    assert colours[("Percentage Change", "2020-01-01")] == "#6c757d"
    values = {(r["panel"], r["series"], r["month_date"]): r["value"] for r in points}
    assert values[(1, "Average", "2020-02-01")] == 183.33
    assert values[(2, "Avg Change", "2020-02-01")] == 16.67
    assert values[(3, "Forecast (Next 3 Months)", "2020-03-01")] == 50.0
    assert values[(3, "Forecast (Next 3 Months)", "2020-06-01")] == 100.0


def test_printed_lines(series):
    monthly = series(*two_years())
    line = rows(report.formatted_trend(trend.monthly_trend_detail(monthly)))[1]["line"]
    expected = (
        f"{'2006-02':<10} ${36330.01:<14.2f} {6:<8} ${16975.69:<11.2f} ${19354.32:<11.2f} "
        f"{114.01:<9.2f}% {'↑ Growing':<12} ${54495.02:<11.2f}"
    )
    assert line == expected
    lines = [r["line"] for r in rows(report.formatted_summary(summary.monthly_change_summary(monthly)))]
    assert lines[1] == f"Total Revenue: ${990162.05:,.2f}"
    assert lines[6] == "Average % Change: 18.24%"
    ahead = rows(report.formatted_forecast(forecast.forecast_from_max(monthly)))[0]["line"]
    assert ahead == f"{'Forecast Month 1':<20} ${72251.90:<19,.2f}"
    slope = [r["line"] for r in rows(report.formatted_slope(summary.trend_range_slope(monthly)))]
    assert slope == [
        "Overall Slope (Trend): $2,430.53 per month",
        "Average Monthly Revenue: $41,964.07",
        "Trend Direction: Positive Trend (Growing)",
    ]
    single = series(("2020-05", "42.00", 1))
    assert rows(report.formatted_forecast(forecast.forecast_from_max(single)))[0]["line"].split()[-1] == "N/A"
