"""The registered queries as SQL for a second engine, over the same given tables.

They follow the plain shape of each report (raw joins, counts of distinct orders, a self-join on
year and month, outer joins with IS NULL), so they check the rewrites the operators make.
"""

from __future__ import annotations

from tallyloom.functions import labels
from tallyloom.functions.mix import MODULUS, WIDE
from tallyloom.operators import generate as g
from tallyloom.operators import report
from tallyloom.plans.testbed import METHOD_OF_PRIORITY

# --- the given tables as sales tables ---

SALES = """
s_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS status, o_orderpriority AS priority
  FROM orders),
s_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(15,2)) AS price
  FROM lineitem)"""

_METHOD = "CASE priority " + " ".join(f"WHEN '{p}' THEN '{m}'" for p, m in METHOD_OF_PRIORITY.items()) + " END"

PAYMENTS = f"""
s_priced AS (
  SELECT o.order_id, o.order_date, o.status, o.priority,
         CAST(ROUND(COALESCE(SUM(i.quantity * i.price), 0), 2) AS DECIMAL(18,2)) AS total
  FROM s_orders o LEFT JOIN s_items i ON i.order_id = o.order_id
  GROUP BY ALL),
s_parts AS (
  SELECT order_id, order_date, status, priority, 0 AS part,
         CASE WHEN status = 'F' AND priority = '4-NOT SPECIFIED' THEN total + 5.00
              WHEN status = 'P' AND priority = '3-MEDIUM' THEN total + 0.01
              ELSE total END AS amount
  FROM s_priced WHERE NOT (status = 'P' AND priority = '5-LOW')
  UNION ALL
  SELECT order_id, order_date, status, priority, 1, 25.00
  FROM s_priced WHERE status = 'O' AND priority = '1-URGENT'
  UNION ALL
  SELECT order_id, order_date, status, priority, 1, total
  FROM s_priced WHERE status = 'O' AND priority = '2-HIGH'),
s_payments AS (
  SELECT order_id * 2 + part AS payment_id, amount,
         CASE WHEN status = 'F' AND priority = '5-LOW' THEN -1 - order_id ELSE order_id END AS order_id,
         {_METHOD} AS payment_method, CAST(order_date + INTERVAL 3 DAY AS DATE) AS payment_date
  FROM s_parts)"""

MONTHLY = """
monthly AS (
  SELECT CAST(date_trunc('month', o.order_date) AS DATE) AS month_start,
         SUM(i.quantity * i.price) AS revenue, COUNT(DISTINCT o.order_id) AS order_count
  FROM s_orders o JOIN s_items i ON i.order_id = o.order_id
  GROUP BY 1),
lagged AS (
  SELECT *, strftime(month_start, '%Y-%m') AS month, strftime(month_start, '%Y') AS year,
         strftime(month_start, '%m') AS month_num,
         LAG(revenue) OVER (ORDER BY month_start) AS prev,
         LAG(month_start) OVER (ORDER BY month_start) AS prev_start,
         ROW_NUMBER() OVER (ORDER BY month_start) AS rn
  FROM monthly)"""

# Previous calendar month by self-join.
CALENDAR = """
calendar AS (
  SELECT c.*, p.revenue AS cal_prev, c.revenue - COALESCE(p.revenue, 0) AS cal_change
  FROM lagged c LEFT JOIN monthly p
    ON (year(p.month_start) = year(c.month_start) AND month(p.month_start) = month(c.month_start) - 1)
    OR (year(p.month_start) = year(c.month_start) - 1
        AND month(c.month_start) = 1 AND month(p.month_start) = 12))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _round(expression: str, places: int = 2) -> str:
    # nine places tell a tie from its neighbours among doubles
    return f"ROUND(CAST({expression} AS DECIMAL(38,9)), {places})"


def _report(expression: str, places: int = 2) -> str:
    return f"CAST({_round(expression, places)} AS DOUBLE)"


def _double(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _sign(value: str, positive: str, negative: str, other: str) -> str:
    return f"CASE WHEN {value} > 0 THEN '{positive}' WHEN {value} < 0 THEN '{negative}' ELSE '{other}' END"


def _trend4(value: str) -> str:
    return (
        f"CASE WHEN {value} > 0 THEN '{labels.GROWING}' WHEN {value} < 0 THEN '{labels.DECLINING}' "
        f"WHEN {value} = 0 THEN '{labels.STABLE}' ELSE '{labels.UNKNOWN}' END"
    )


def _percent(change: str, base: str) -> str:
    return f"CASE WHEN {base} > 0 THEN CAST({change} AS DOUBLE) / CAST({base} AS DOUBLE) * 100 END"


_DIRECTION = (labels.POSITIVE_TREND, labels.NEGATIVE_TREND, labels.STABLE_TREND)

# --- monthly reports ---

MONTHLY_REVENUE = f"""{_with(SALES, MONTHLY)}
SELECT month, year, month_num, CAST(revenue AS DOUBLE) AS total_revenue, order_count FROM lagged"""

MONTHLY_TREND_POSITIONS = f"""{_with(SALES, MONTHLY)}
SELECT ROW_NUMBER() OVER (ORDER BY month_start) AS position, month, {_report('revenue')} AS monthly_revenue FROM lagged"""

MONTHLY_WITH_PREVIOUS = f"""{_with(SALES, MONTHLY)}
SELECT month, year, month_num, CAST(revenue AS DOUBLE) AS total_revenue, order_count,
       CAST(prev AS DOUBLE) AS previous_month_revenue, strftime(prev_start, '%Y-%m') AS previous_month
FROM lagged"""

MOVING = "CAST(SUM(revenue) OVER w3 AS DOUBLE) / COUNT(revenue) OVER w3"

MONTHLY_MOVING_AVG = f"""{_with(SALES, MONTHLY)}
SELECT month, {_report('revenue')} AS monthly_revenue, {_report(MOVING)} AS moving_avg
FROM lagged
WINDOW w3 AS (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

DETAIL = f"""
changes AS (SELECT *, revenue - COALESCE(prev, 0) AS change FROM lagged),
means AS (
  SELECT *, {_round('CAST(SUM(change) OVER up AS DOUBLE) / COUNT(change) OVER up')} AS mean_change,
         FIRST_VALUE(revenue) OVER up AS first_revenue
  FROM changes
  WINDOW up AS (ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
detail AS (
  SELECT month, year, month_num, {_report('revenue')} AS monthly_revenue, order_count,
         {_report('COALESCE(prev, 0)')} AS previous_month_revenue,
         {_report('COALESCE(change, 0)')} AS revenue_change,
         COALESCE({_report(_percent('revenue - prev', 'prev'))}, 0) AS percent_change,
         {_trend4('change')} AS trend,
         {_report('revenue + COALESCE(mean_change, 0)')} AS forecast_next_month,
         {_report('CAST(revenue - first_revenue AS DOUBLE) / NULLIF(rn - 1, 0)')} AS estimated_slope
  FROM means)"""

MONTHLY_TREND_DETAIL = f"{_with(SALES, MONTHLY, DETAIL)}\nSELECT * FROM detail"

MONTHLY_TREND_ALT = f"""{_with(SALES, MONTHLY)},
steps AS (SELECT *, revenue - prev AS step FROM lagged),
measured AS (
  SELECT *, {_round(MOVING)} AS smoothed,
         {_round('CAST(SUM(step) OVER () AS DOUBLE) / NULLIF(COUNT(step) OVER (), 0)')} AS growth
  FROM steps
  WINDOW w3 AS (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT month, {_report('revenue')} AS monthly_revenue, {_report('COALESCE(prev, 0)')} AS previous_month,
       {_report('revenue - COALESCE(prev, 0)')} AS change_from_prev,
       CAST(smoothed AS DOUBLE) AS moving_avg_3mo, CAST(growth AS DOUBLE) AS avg_monthly_growth,
       {_report('revenue + growth')} AS forecast_next_month,
       {_sign('revenue - COALESCE(prev, 0)', labels.UP, labels.DOWN, labels.LEVEL)} AS trend
FROM measured"""

CALENDAR_REPORT = f"""
calendar_report AS (
  SELECT month, {_report('revenue')} AS monthly_revenue, order_count,
         {_report('COALESCE(cal_prev, 0)')} AS previous_month_revenue,
         {_report('cal_change')} AS revenue_change,
         COALESCE({_report(_percent('revenue - cal_prev', 'cal_prev'))}, 0) AS percent_change,
         {_sign('cal_change', labels.GROWING, labels.DECLINING, labels.STABLE)} AS trend
  FROM calendar)"""

MONTHLY_TREND_CALENDAR = f"{_with(SALES, MONTHLY, CALENDAR, CALENDAR_REPORT)}\nSELECT * FROM calendar_report"

STATISTICS = f"""COUNT(*) AS total_months, {_report('SUM(revenue)')} AS total_revenue,
       {_report('CAST(SUM(revenue) AS DOUBLE) / NULLIF(COUNT(*), 0)')} AS avg_monthly_revenue,
       {_report('MIN(revenue)')} AS min_monthly_revenue, {_report('MAX(revenue)')} AS max_monthly_revenue"""

MONTHLY_SUMMARY = f"{_with(SALES, MONTHLY)}\nSELECT {STATISTICS} FROM monthly"

CHANGE_SUMMARY = f"""
change_summary AS (
  SELECT {STATISTICS},
         {_report('CAST(SUM(revenue - prev) AS DOUBLE) / NULLIF(COUNT(*), 0)')} AS avg_monthly_change,
         {_report(f"AVG({_percent('revenue - prev', 'prev')})")} AS avg_percent_change
  FROM lagged WHERE prev IS NOT NULL)"""

MONTHLY_CHANGE_SUMMARY = f"{_with(SALES, MONTHLY, CHANGE_SUMMARY)}\nSELECT * FROM change_summary"

RANGE_SLOPE = "CAST(MAX(revenue) - MIN(revenue) AS DOUBLE) / NULLIF(MAX(rn) - MIN(rn), 0)"

TREND_RANGE_SLOPE = f"""{_with(SALES, MONTHLY)}
SELECT {_report(RANGE_SLOPE)} AS overall_slope,
       {_report('CAST(SUM(revenue) AS DOUBLE) / NULLIF(COUNT(*), 0)')} AS avg_monthly_revenue,
       {_sign(RANGE_SLOPE, *_DIRECTION)} AS trend_direction
FROM lagged"""

ENDPOINT = f"""
shown AS (SELECT month_start, rn, {_round('revenue')} AS revenue FROM lagged),
ends AS (
  SELECT COALESCE(CAST(MAX(CASE WHEN rn = n THEN revenue END) - MAX(CASE WHEN rn = 1 THEN revenue END) AS DOUBLE)
                  / NULLIF(MAX(n) - 1, 0), 0) AS slope,
         CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS mean_revenue
  FROM (SELECT *, COUNT(*) OVER () AS n FROM shown) HAVING COUNT(*) > 0),
endpoint AS (
  SELECT {_report('slope')} AS overall_slope, {_report('mean_revenue')} AS avg_monthly_revenue,
         {_sign('slope', *_DIRECTION)} AS trend_direction
  FROM ends)"""

TREND_ENDPOINT_SLOPE = f"{_with(SALES, MONTHLY, ENDPOINT)}\nSELECT * FROM endpoint"

NONZERO = """COALESCE(CAST(SUM(CASE WHEN ROUND(cal_change, 2) <> 0 THEN ROUND(cal_change, 2) END) AS DOUBLE)
         / NULLIF(COUNT(CASE WHEN ROUND(cal_change, 2) <> 0 THEN 1 END), 0), 0)"""

AVG_NONZERO_CHANGE = f"""{_with(SALES, MONTHLY, CALENDAR)}
SELECT {_report(NONZERO)} AS avg_monthly_change FROM calendar"""

FITTED = f"""
points AS (SELECT month_start, month, rn - 1 AS x, {_round('revenue')} AS y FROM lagged),
sums AS (
  SELECT COUNT(*) AS n, SUM(x) AS sx, SUM(x * x) AS sxx, SUM(y) AS sy, SUM(CAST(x AS DECIMAL(10,0)) * y) AS sxy
  FROM points),
sloped AS (
  SELECT *, CAST(CAST(n AS DECIMAL(10,0)) * sxy - CAST(sx AS DECIMAL(10,0)) * sy AS DOUBLE)
            / NULLIF(n * sxx - sx * sx, 0) AS slope
  FROM sums),
line AS (SELECT n, slope, (CAST(sy AS DOUBLE) - slope * sx) / n AS intercept FROM sloped)"""

TREND_LINE_OLS = f"""{_with(SALES, MONTHLY, FITTED)}
SELECT month, CAST(y AS DOUBLE) AS monthly_revenue, {_report('slope', 4)} AS slope, {_report('intercept', 4)} AS intercept,
       {_report('intercept + slope * x')} AS trend_line
FROM points, line WHERE n > 1"""

# --- forecasts ---

FROM_MAX = f"""
growth AS (
  SELECT CAST(MAX(revenue) AS DOUBLE) AS start,
         CAST(SUM(revenue - prev) AS DOUBLE) / NULLIF(COUNT(prev), 0) AS growth
  FROM lagged),
forecast AS (
  SELECT 'Forecast Month ' || k AS forecast_period, {_report('start + growth * k')} AS forecasted_revenue
  FROM growth, range(1, 4) AS ks(k))"""

FORECAST_FROM_MAX = f"{_with(SALES, MONTHLY, FROM_MAX)}\nSELECT * FROM forecast"

LAST = f"""
last_month AS (
  SELECT MAX(month_start) AS last_start, {NONZERO} AS growth,
         COALESCE(CAST(arg_max({_round('revenue')}, month_start) AS DOUBLE), 0) AS start
  FROM calendar)"""

FORECAST_FROM_LAST = f"""{_with(SALES, MONTHLY, CALENDAR, LAST)}
SELECT 'Forecast Month ' || k AS forecast_period, {_report('start + growth * k')} AS forecasted_revenue
FROM last_month, range(1, 4) AS ks(k)"""

FORECAST_SERIES_DATED = f"""{_with(SALES, MONTHLY, CALENDAR, LAST)}
SELECT strftime(last_start + to_months(CAST(k AS INTEGER)), '%Y-%m-%d') AS month_date,
       CASE WHEN k = 0 THEN 'actual' ELSE 'forecast' END AS kind, {_report('start + growth * k')} AS revenue
FROM last_month, range(0, 4) AS ks(k)"""


def _colour(value: str) -> str:
    return _sign(value, labels.GREEN, labels.RED, labels.GREY)


_CAL_PERCENT = f"COALESCE({_report(_percent('revenue - cal_prev', 'cal_prev'))}, 0)"

CHART_SERIES = f"""{_with(SALES, MONTHLY, CALENDAR, LAST, FITTED)},
history AS (
  SELECT strftime(c.month_start, '%Y-%m-%d') AS month_date, {_report('revenue')} AS revenue,
         {_report('cal_change')} AS change, {_CAL_PERCENT} AS percent,
         {_report(f"CAST(SUM({_round('revenue')}) OVER () AS DOUBLE) / COUNT(*) OVER ()")} AS mean_revenue,
         {_report('growth')} AS mean_change, {_report('intercept + slope * x')} AS fitted, n
  FROM calendar c JOIN points p ON p.month_start = c.month_start, line, last_month)
SELECT 1 AS panel, 'Monthly Revenue' AS series, month_date, revenue AS value, '{report.REVENUE_COLOUR}' AS colour
FROM history
UNION ALL SELECT 1, 'Average', month_date, mean_revenue, '{report.AVERAGE_COLOUR}' FROM history
UNION ALL SELECT 2, 'Revenue Change', month_date, change, {_colour('change')} FROM history
UNION ALL SELECT 2, 'Avg Change', month_date, mean_change, '{report.CHANGE_COLOUR}' FROM history
UNION ALL SELECT 3, 'Historical Revenue', month_date, revenue, '{report.REVENUE_COLOUR}' FROM history
UNION ALL SELECT 3, 'Trend Line', month_date, fitted, '{report.LINE_COLOUR}' FROM history WHERE n > 1
UNION ALL SELECT 4, 'Percentage Change', month_date, percent, {_colour('percent')} FROM history
UNION ALL
SELECT 3, '{report.FORECAST_SERIES}', strftime(last_start + to_months(CAST(k AS INTEGER)), '%Y-%m-%d'),
       {_report('start + growth * k')}, '{report.FORECAST_COLOUR}'
FROM last_month, range(0, 4) AS ks(k)"""

# --- printed lines ---

_TREND_TEXT = "printf('%-10s $%-14.2f %-8s $%-11.2f $%-11.2f %-9.2f%% ', month, monthly_revenue, " \
    "CAST(order_count AS VARCHAR), previous_month_revenue, revenue_change, percent_change) || rpad(trend, 12, ' ')"

FORMATTED_TREND = f"""{_with(SALES, MONTHLY, DETAIL)}
SELECT month, {_TREND_TEXT} || printf(' $%-11.2f', forecast_next_month) AS line FROM detail"""

FORMATTED_TREND_CALENDAR = f"""{_with(SALES, MONTHLY, CALENDAR, CALENDAR_REPORT)}
SELECT month, {_TREND_TEXT} AS line FROM calendar_report"""

FORMATTED_SUMMARY = f"""{_with(SALES, MONTHLY, CHANGE_SUMMARY)}
SELECT CAST(i AS INTEGER) AS line_number, CASE i
         WHEN 0 THEN 'Total Months Analyzed: ' || total_months
         WHEN 1 THEN printf('Total Revenue: $%,.2f', total_revenue)
         WHEN 2 THEN printf('Average Monthly Revenue: $%,.2f', avg_monthly_revenue)
         WHEN 3 THEN printf('Minimum Monthly Revenue: $%,.2f', min_monthly_revenue)
         WHEN 4 THEN printf('Maximum Monthly Revenue: $%,.2f', max_monthly_revenue)
         WHEN 5 THEN printf('Average Monthly Change: $%,.2f', avg_monthly_change)
         ELSE printf('Average %% Change: %.2f%%', avg_percent_change) END AS line
FROM change_summary, range(0, 7) AS lines(i)"""

FORMATTED_SLOPE = f"""{_with(SALES, MONTHLY, ENDPOINT)}
SELECT CAST(i AS INTEGER) AS line_number, CASE i
         WHEN 0 THEN printf('Overall Slope (Trend): $%,.2f per month', overall_slope)
         WHEN 1 THEN printf('Average Monthly Revenue: $%,.2f', avg_monthly_revenue)
         ELSE 'Trend Direction: ' || trend_direction END AS line
FROM endpoint, range(0, 3) AS lines(i)"""

FORMATTED_FORECAST = f"""{_with(SALES, MONTHLY, FROM_MAX)}
SELECT forecast_period, printf('%-20s $', forecast_period) ||
       rpad(printf('%,.2f', forecasted_revenue), 19, ' ') AS line
FROM forecast"""

# --- reconciliation ---

ORDER_TOTALS = f"""{_with(SALES)}
SELECT o.order_id, CAST(COALESCE(SUM(i.quantity * i.price), 0) AS DOUBLE) AS order_total
FROM s_orders o LEFT JOIN s_items i ON i.order_id = o.order_id GROUP BY o.order_id"""

RECONCILED = """
totals AS (
  SELECT o.order_id, o.order_date, o.status, COALESCE(SUM(i.quantity * i.price), 0) AS order_total
  FROM s_orders o LEFT JOIN s_items i ON i.order_id = o.order_id GROUP BY ALL),
reconciled AS (
  SELECT DISTINCT t.*, p.amount AS payment_amount,
         CASE WHEN ABS(t.order_total - p.amount) < 0.01 THEN 'MATCH' ELSE 'MISMATCH' END AS status_check,
         ABS(t.order_total - p.amount) AS difference
  FROM totals t LEFT JOIN s_payments p ON p.order_id = t.order_id)"""

PAYMENT_RECONCILIATION = f"""{_with(SALES, PAYMENTS, RECONCILED)}
SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, status,
       CAST(order_total AS DOUBLE) AS order_total, CAST(payment_amount AS DOUBLE) AS payment_amount,
       status_check, CAST(difference AS DOUBLE) AS difference
FROM reconciled ORDER BY order_id"""

PAYMENT_RECONCILIATION_POSITIONS = f"""{_with(SALES, PAYMENTS, RECONCILED)}
SELECT ROW_NUMBER() OVER (ORDER BY order_id, payment_amount) AS position, order_id,
       CAST(payment_amount AS DOUBLE) AS payment_amount, status_check
FROM reconciled"""

RECONCILIATION_UNKNOWN_AMOUNTS = f"""{_with(SALES, PAYMENTS.replace("1, 25.00", "1, NULL"), RECONCILED)}
SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, status,
       CAST(order_total AS DOUBLE) AS order_total, CAST(payment_amount AS DOUBLE) AS payment_amount,
       status_check, CAST(difference AS DOUBLE) AS difference
FROM reconciled"""

PAYMENT_MISMATCHES = f"""{_with(SALES, PAYMENTS, RECONCILED)}
SELECT order_id, CAST(order_total AS DOUBLE) AS order_total,
       CAST(COALESCE(payment_amount, 0) AS DOUBLE) AS payment_amount, CAST(difference AS DOUBLE) AS difference
FROM reconciled WHERE status_check = 'MISMATCH'"""

COUNTERS = f"""
counters AS (
  SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (status_check = 'MATCH') AS matching,
         COUNT(*) FILTER (status_check <> 'MATCH') AS mismatching
  FROM reconciled),
shares AS (
  SELECT *, {_report('CAST(matching AS DOUBLE) / NULLIF(total_orders, 0) * 100', 1)} AS matching_percent,
         {_report('CAST(mismatching AS DOUBLE) / NULLIF(total_orders, 0) * 100', 1)} AS mismatching_percent
  FROM counters)"""

RECONCILIATION_SUMMARY = f"{_with(SALES, PAYMENTS, RECONCILED, COUNTERS)}\nSELECT * FROM shares"

ORDERS_WITHOUT_PAYMENTS = f"""{_with(SALES, PAYMENTS)}
SELECT o.order_id, CAST(COALESCE(SUM(i.quantity * i.price), 0) AS DOUBLE) AS order_total
FROM s_orders o LEFT JOIN s_items i ON i.order_id = o.order_id LEFT JOIN s_payments p ON p.order_id = o.order_id
WHERE p.payment_id IS NULL GROUP BY o.order_id"""

PAYMENTS_WITHOUT_ORDERS = f"""{_with(SALES, PAYMENTS)}
SELECT p.payment_id, p.order_id, CAST(p.amount AS DOUBLE) AS amount
FROM s_payments p LEFT JOIN s_orders o ON o.order_id = p.order_id WHERE o.order_id IS NULL"""

UNMATCHED_COUNTS = f"""{_with(SALES, PAYMENTS)}
SELECT 'orders without payments' AS side, COUNT(*) AS unmatched
FROM s_orders o LEFT JOIN s_payments p ON p.order_id = o.order_id WHERE p.payment_id IS NULL
UNION ALL
SELECT 'payments without orders', COUNT(*)
FROM s_payments p LEFT JOIN s_orders o ON o.order_id = p.order_id WHERE o.order_id IS NULL"""

FORMATTED_RECONCILIATION = f"""{_with(SALES, PAYMENTS, RECONCILED)}
SELECT order_id, printf('%-10s $%-14.2f $%-14.2f %-10s ', CAST(order_id AS VARCHAR),
         CAST(order_total AS DOUBLE), CAST(COALESCE(payment_amount, 0) AS DOUBLE), status_check) ||
       COALESCE(printf('$%-11.2f', CAST(difference AS DOUBLE)), rpad('N/A', 12, ' ')) AS line
FROM reconciled"""

FORMATTED_RECONCILIATION_SUMMARY = f"""{_with(SALES, PAYMENTS, RECONCILED, COUNTERS)}
SELECT CAST(i AS INTEGER) AS line_number, CASE i
         WHEN 0 THEN 'Total Orders: ' || total_orders
         WHEN 1 THEN printf('Matching: %s (%.1f%%)', CAST(matching AS VARCHAR), matching_percent)
         ELSE printf('Mismatching: %s (%.1f%%)', CAST(mismatching AS VARCHAR), mismatching_percent) END AS line
FROM shares, range(0, 3) AS lines(i)"""

# --- reading, upsert, audits ---

CUSTOMERS = """
s_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, 'customer' || c_custkey || '@example.com' AS email,
         '+1-555-' || c_custkey AS phone_number, c_mktsegment AS city, n_name AS country
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)"""

READ_CUSTOMERS = f"{_with(CUSTOMERS)}\nSELECT * FROM s_customers"

READ_PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price
FROM part"""

READ_ORDERS = f"""{_with(SALES)}
SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, status FROM s_orders"""

READ_ORDER_ITEMS = """
SELECT l_orderkey * 1000000 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price
FROM lineitem"""

READ_PAYMENTS = f"""{_with(SALES, PAYMENTS)}
SELECT payment_id, CAST(amount AS DOUBLE) AS amount, order_id, payment_method,
       strftime(payment_date, '%Y-%m-%d') AS payment_date
FROM s_payments"""

INGEST_ORDERS_QUARANTINE = f"""{_with(SALES)}
SELECT CASE WHEN status = 'P' THEN 'n/a' ELSE CAST(order_id AS VARCHAR) END AS order_id,
       CASE WHEN status = 'P' THEN NULL ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
       CASE WHEN status = 'F' THEN '13/40/2020' ELSE strftime(order_date, '%-m/%-d/%Y') END AS order_date,
       status,
       CASE WHEN status = 'P' THEN 'order_id: bad value n/a; customer_id: missing'
            ELSE 'order_date: bad value 13/40/2020' END AS reason
FROM s_orders WHERE priority = '5-LOW' AND status IN ('P', 'F')"""

INGEST_UPSERT_ORDERS = f"""{_with(SALES)}
SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date,
       status || CASE WHEN priority = '1-URGENT' THEN '-2' ELSE '' END AS status
FROM s_orders"""

INGEST_LOAD_COUNTERS = f"""{_with(SALES)},
counted AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (priority = '5-LOW' AND status IN ('P', 'F')) AS damaged,
         COUNT(*) FILTER (priority = '1-URGENT') AS urgent, COUNT(*) FILTER (priority = '2-HIGH') AS high
  FROM s_orders)
SELECT CAST(1 AS INTEGER) AS load, 'orders' AS table_name, n AS rows_read, damaged AS rows_refused, 0::BIGINT AS rows_superseded,
       0::BIGINT AS rows_replaced, n - damaged AS rows_inserted, 0::BIGINT AS rows_kept FROM counted
UNION ALL
SELECT 2, 'orders', 2 * urgent + high, 0, urgent, urgent, high, n - damaged - urgent FROM counted"""

UPSERT_LATEST_BY_KEY = """
WITH ranked AS (
  SELECT *, ROW_NUMBER() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY (l_linestatus = 'F'), l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM ranked WHERE rn = 1"""

TABLE_ROW_COUNTS = f"""{_with(SALES, PAYMENTS)}
SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'products', COUNT(*) FROM part
UNION ALL SELECT 'orders', COUNT(*) FROM s_orders
UNION ALL SELECT 'order_items', COUNT(*) FROM s_items
UNION ALL SELECT 'payments', COUNT(*) FROM s_payments"""


def _orphans(child: str, label: str, column: str, parent: str, key: str) -> str:
    return f"""SELECT '{label}' AS reference,
       COUNT(*) FILTER (c.{column} IS NOT NULL AND p.{key} IS NULL) AS orphan_rows,
       COUNT(*) FILTER (c.{column} IS NULL) AS null_rows
FROM {child} c LEFT JOIN {parent} p ON p.{key} = c.{column}"""


FK_ORPHAN_COUNTS = f"{_with(SALES, PAYMENTS)}\n" + "\nUNION ALL\n".join(
    [
        _orphans("s_orders", "orders.customer_id -> customers.customer_id", "customer_id", "customer", "c_custkey"),
        _orphans("s_items", "order_items.order_id -> orders.order_id", "order_id", "orders", "o_orderkey"),
        _orphans("s_items", "order_items.product_id -> products.product_id", "product_id", "part", "p_partkey"),
        _orphans("s_payments", "payments.order_id -> orders.order_id", "order_id", "orders", "o_orderkey"),
    ]
)


def _unique(name: str, source: str, label: str, key: str) -> str:
    return f"""SELECT '{name}' AS table_name, 'unique' AS check_name, '{label}' AS column_name,
       (SELECT COUNT(*) FROM {source}) - (SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {source})) AS violations"""


def _not_null(name: str, source: str, column: str) -> str:
    return f"SELECT '{name}', 'not null', '{column}', COUNT(*) FILTER ({column} IS NULL) FROM {source}"


KEY_NULL_AUDIT = f"""{_with(SALES, PAYMENTS, CUSTOMERS)},
s_products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS price FROM part)
""" + "\nUNION ALL\n".join(
    [
        _unique("customers", "s_customers", "customer_id", "customer_id"),
        *[_not_null("customers", "s_customers", c) for c in ("customer_id", "customer_name", "email")],
        _unique("products", "s_products", "product_id", "product_id"),
        *[_not_null("products", "s_products", c) for c in ("product_id", "product_name", "price")],
        _unique("orders", "s_orders", "order_id", "order_id"),
        *[_not_null("orders", "s_orders", c) for c in ("order_id", "customer_id", "order_date")],
        _unique("order_items", "s_items", "order_id, line_number", "order_id, line_number"),
        *[_not_null("order_items", "s_items", c) for c in ("order_id", "product_id", "quantity", "price")],
        _unique("payments", "s_payments", "payment_id", "payment_id"),
        *[_not_null("payments", "s_payments", c) for c in ("payment_id", "amount", "order_id", "payment_date")],
    ]
)

# --- generator ---


def _mixed(key: str, salt: int) -> str:
    """The arithmetic of ``functions.mix`` written out."""
    low, high = f"({key} & {MODULUS})", f"({key} >> 31)"
    first = f"(({low} * 16807 + {high} * 69621 + {salt * 7919}) % {MODULUS})"
    second = f"(({first} * {first} + {salt}) % {MODULUS})"
    return f"(({second} * 48271 + {first}) % {MODULUS})"


def _wide(key: str, salt: int) -> str:
    return f"({_mixed(key, salt)} * 2147483648 + {_mixed(key, salt + WIDE)})"


def _int(key: str, salt: int, low: int, high: int | str) -> str:
    return f"({_mixed(key, salt)} % ({high} - {low} + 1) + {low})"


def _pick(key: str, salt: int, values: list[str]) -> str:
    options = ", ".join(f"'{v}'" for v in values)
    return f"[{options}][{_int(key, salt, 1, len(values))}]"


def _cents(expression: str, kind: str = "DECIMAL(12,2)") -> str:
    return f"CAST(CAST({expression} AS DECIMAL(16,0)) * CAST('0.01' AS DECIMAL(3,2)) AS {kind})"


MADE_PRODUCTS = f"""
m_products AS (
  SELECT id AS product_id, {_pick('id', 21, g.ADJECTIVES)} || ' ' || {_pick('id', 22, g.NOUNS)} AS product_name,
         {_pick('id', 23, g.CATEGORIES)} AS category, {_cents(_int('id', 24, 1000, 100000))} AS price
  FROM (SELECT p_partkey + 1 AS id FROM part))"""

MADE_ORDERS = f"""
m_orders AS (
  SELECT id AS order_id, {_wide('id', 31)} % (SELECT COUNT(*) FROM customer) + 1 AS customer_id,
         DATE '2006-01-01' + CAST({_int('id', 32, 0, 729)} AS INTEGER) AS order_date,
         {_pick('id', 33, g.ORDER_STATUSES)} AS status
  FROM (SELECT o_orderkey + 1 AS id FROM orders))"""

_SLOTS = f"LEAST({_int('order_id', 41, 1, 5)}, n)"
_STEP = f"[{', '.join(map(str, g.STEPS))}][{_int('order_id', 43, 1, len(g.STEPS))}]"

MADE_ITEMS = f"""
m_drawn AS (
  SELECT order_id, n, UNNEST(range(1, {_SLOTS} + 1)) AS slot
  FROM m_orders, (SELECT COUNT(*) AS n FROM part)),
m_placed AS (
  SELECT order_id * 5 + slot - 5 AS item_id, order_id,
         ({_wide('order_id', 42)} + slot * {_STEP}) % n + 1 AS product_id
  FROM m_drawn),
m_items AS (
  SELECT item_id, order_id, product_id, CAST({_int('item_id', 44, 1, 5)} AS INTEGER) AS quantity,
         {_cents(f"(CAST(price * 100 AS BIGINT) * {_int('item_id', 45, 9000, 11000)} + 5000) // 10000")} AS price
  FROM m_placed JOIN m_products USING (product_id))"""

GEN_CUSTOMERS = f"""
WITH named AS (
  SELECT id, {_pick('id', 11, g.FIRST_NAMES)} AS given, {_pick('id', 12, g.LAST_NAMES)} AS family
  FROM (SELECT c_custkey + 1 AS id FROM customer))
SELECT id AS customer_id, given || ' ' || family AS customer_name,
       lower(given) || '.' || lower(family) || id || '@example.com' AS email,
       '+1-555-' || lpad(CAST({_int('id', 13, 0, 9999999)} AS VARCHAR), 7, '0') AS phone_number,
       {_pick('id', 14, g.CITIES)} AS city, {_pick('id', 15, g.COUNTRIES)} AS country
FROM named"""

GEN_PRODUCTS = f"""{_with(MADE_PRODUCTS)}
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM m_products"""

GEN_ORDERS = f"""{_with(MADE_ORDERS)}
SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, status FROM m_orders"""

GEN_ORDER_ITEMS = f"""{_with(MADE_PRODUCTS, MADE_ORDERS, MADE_ITEMS)}
SELECT item_id, order_id, product_id, quantity, CAST(price AS DOUBLE) AS price FROM m_items"""

GEN_PAYMENTS = f"""{_with(MADE_PRODUCTS, MADE_ORDERS, MADE_ITEMS)},
totals AS (SELECT order_id, SUM(quantity * price) AS total FROM m_items GROUP BY order_id)
SELECT order_id AS payment_id,
       CAST(COALESCE(total, {_cents(_int('order_id', 51, 5000, 50000), 'DECIMAL(18,2)')}) AS DOUBLE) AS amount,
       order_id, {_pick('order_id', 53, g.PAYMENT_METHODS)} AS payment_method,
       strftime(LEAST(order_date + CAST({_int('order_id', 52, 0, 7)} AS INTEGER), DATE '2007-12-31'),
                '%Y-%m-%d') AS payment_date
FROM m_orders LEFT JOIN totals USING (order_id)"""

GEN_VOLUMES = f"""
WITH volumes AS (
  SELECT (SELECT COUNT(*) FROM customer) AS customers, (SELECT COUNT(*) FROM part) AS n, (SELECT COUNT(*) FROM orders) AS placed),
drawn AS (
  SELECT SUM(LEAST({_int('order_id', 41, 2, 4)}, n))::BIGINT AS items
  FROM volumes, UNNEST(range(1, placed + 1)) AS ids(order_id))
SELECT UNNEST(['customers', 'products', 'orders', 'order_items', 'payments']) AS table_name,
       UNNEST([customers, n, placed, items, placed]) AS row_count
FROM volumes, drawn"""

MONTHLY_NET_REVENUE = f"""{_with(SALES)},
net AS (
  SELECT l_orderkey AS order_id,
         CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS paid
  FROM lineitem)
SELECT strftime(order_date, '%Y-%m') AS month, strftime(order_date, '%Y') AS year, strftime(order_date, '%m') AS month_num,
       CAST(SUM(paid) AS DOUBLE) AS total_revenue, COUNT(DISTINCT order_id) AS order_count
FROM s_orders JOIN net USING (order_id) GROUP BY ALL"""

# Lines of a product file by the last digit of the key: 1 a quoted break, 2 a field too many, 3 one too few,
# 4 more places than a price holds, 5 three places.
DIRTY = """
WITH dirty AS (
  SELECT p_partkey AS product_id, p_partkey % 10 AS kind, p_name, p_type,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price
  FROM part)"""

READ_DIRTY_GOOD = f"""{DIRTY}
SELECT product_id, p_name || CASE WHEN kind = 1 THEN chr(10) || 'second "line"' ELSE '' END AS product_name,
       p_type AS category, CAST(price || CASE WHEN kind = 5 THEN '9' ELSE '' END AS DOUBLE) AS price
FROM dirty WHERE kind NOT IN (2, 3, 4)"""

READ_DIRTY_QUARANTINE = f"""{DIRTY}
SELECT CAST(product_id AS VARCHAR) AS product_id,
       CASE kind WHEN 2 THEN 'wrong number of fields: ' || product_id || ',"' || p_name || '",' || p_type || ',' || price || ',surplus'
                 WHEN 3 THEN 'wrong number of fields: ' || product_id || ',"' || p_name || '",' || p_type
                 ELSE 'price: bad value ' || price || '0000001' END AS reason
FROM dirty WHERE kind IN (2, 3, 4)"""

FORMATTED_FORECAST_LAST = f"""{_with(SALES, MONTHLY, CALENDAR, LAST)},
forecast AS (
  SELECT 'Forecast Month ' || k AS forecast_period, {_report('start + growth * k')} AS forecasted_revenue
  FROM last_month, range(1, 4) AS ks(k))
SELECT forecast_period, printf('%-20s $', forecast_period) ||
       rpad(printf('%,.2f', forecasted_revenue), 19, ' ') AS line
FROM forecast"""

FORMATTED_RANGE_SLOPE = f"""{_with(SALES, MONTHLY)},
ranged AS (
  SELECT {_report(RANGE_SLOPE)} AS slope, {_report('CAST(SUM(revenue) AS DOUBLE) / NULLIF(COUNT(*), 0)')} AS mean_revenue,
         {_sign(RANGE_SLOPE, *_DIRECTION)} AS direction
  FROM lagged)
SELECT CAST(i AS INTEGER) AS line_number, CASE i
         WHEN 0 THEN printf('Overall Slope (Trend): $%,.2f per month', slope)
         WHEN 1 THEN printf('Average Monthly Revenue: $%,.2f', mean_revenue)
         ELSE 'Trend Direction: ' || direction END AS line
FROM ranged, range(0, 3) AS lines(i)"""

FORMATTED_SUMMARY_NONZERO = f"""{_with(SALES, MONTHLY, CALENDAR)},
summary AS (SELECT {STATISTICS} FROM monthly),
moved AS (SELECT {_report(NONZERO)} AS mean_change FROM calendar)
SELECT CAST(i AS INTEGER) AS line_number, CASE i
         WHEN 0 THEN 'Total Months Analyzed: ' || total_months
         WHEN 1 THEN printf('Total Revenue: $%,.2f', total_revenue)
         WHEN 2 THEN printf('Average Monthly Revenue: $%,.2f', avg_monthly_revenue)
         WHEN 3 THEN printf('Minimum Monthly Revenue: $%,.2f', min_monthly_revenue)
         WHEN 4 THEN printf('Maximum Monthly Revenue: $%,.2f', max_monthly_revenue)
         ELSE printf('Average Monthly Change: $%,.2f', mean_change) END AS line
FROM summary, moved, range(0, 6) AS lines(i)"""

FORMATTED_MISMATCHES = f"""{_with(SALES, PAYMENTS, RECONCILED)}
SELECT order_id, printf('%-10s $%-14.2f $%-14.2f ', CAST(order_id AS VARCHAR),
         CAST(order_total AS DOUBLE), CAST(COALESCE(payment_amount, 0) AS DOUBLE)) ||
       COALESCE(printf('$%-11.2f', CAST(difference AS DOUBLE)), rpad('N/A', 12, ' ')) AS line
FROM reconciled WHERE status_check = 'MISMATCH'"""

FORMATTED_UNPAID = f"""{_with(SALES, PAYMENTS)},
unpaid AS (
  SELECT o.order_id, CAST(COALESCE(SUM(i.quantity * i.price), 0) AS DOUBLE) AS order_total
  FROM s_orders o LEFT JOIN s_items i ON i.order_id = o.order_id LEFT JOIN s_payments p ON p.order_id = o.order_id
  WHERE p.payment_id IS NULL GROUP BY o.order_id)
SELECT 'row' AS kind, printf('%-10s $%-14.2f', CAST(order_id AS VARCHAR), order_total) AS line FROM unpaid
UNION ALL SELECT 'total', 'Total orders without payments: ' || COUNT(*) FROM unpaid"""

FORMATTED_ORPHANS = f"""{_with(SALES, PAYMENTS)},
orphans AS (
  SELECT p.payment_id, p.order_id, CAST(p.amount AS DOUBLE) AS amount
  FROM s_payments p LEFT JOIN s_orders o ON o.order_id = p.order_id WHERE o.order_id IS NULL)
SELECT 'row' AS kind,
       printf('%-12s %-10s $%-14.2f', CAST(payment_id AS VARCHAR), CAST(order_id AS VARCHAR), amount) AS line
FROM orphans
UNION ALL SELECT 'total', 'Total orphan payments: ' || COUNT(*) FROM orphans"""

ORACLES: dict[str, str] = {
    "monthly_net_revenue": MONTHLY_NET_REVENUE,
    "ingest_upsert_orders": INGEST_UPSERT_ORDERS,
    "read_dirty_good": READ_DIRTY_GOOD,
    "read_dirty_good_split": READ_DIRTY_GOOD,
    "read_dirty_quarantine": READ_DIRTY_QUARANTINE,
    "read_dirty_quarantine_split": READ_DIRTY_QUARANTINE,
    "formatted_forecast_last": FORMATTED_FORECAST_LAST,
    "formatted_range_slope": FORMATTED_RANGE_SLOPE,
    "formatted_summary_nonzero": FORMATTED_SUMMARY_NONZERO,
    "formatted_mismatches": FORMATTED_MISMATCHES,
    "formatted_unpaid": FORMATTED_UNPAID,
    "formatted_orphans": FORMATTED_ORPHANS,
    "monthly_trend_detail": MONTHLY_TREND_DETAIL,
    "monthly_trend_alt": MONTHLY_TREND_ALT,
    "monthly_trend_calendar": MONTHLY_TREND_CALENDAR,
    "monthly_revenue": MONTHLY_REVENUE,
    "monthly_with_previous": MONTHLY_WITH_PREVIOUS,
    "monthly_moving_avg": MONTHLY_MOVING_AVG,
    "monthly_summary": MONTHLY_SUMMARY,
    "monthly_change_summary": MONTHLY_CHANGE_SUMMARY,
    "trend_range_slope": TREND_RANGE_SLOPE,
    "trend_endpoint_slope": TREND_ENDPOINT_SLOPE,
    "avg_nonzero_change": AVG_NONZERO_CHANGE,
    "trend_line_ols": TREND_LINE_OLS,
    "forecast_from_max": FORECAST_FROM_MAX,
    "forecast_from_last": FORECAST_FROM_LAST,
    "forecast_series_dated": FORECAST_SERIES_DATED,
    "chart_series": CHART_SERIES,
    "formatted_trend": FORMATTED_TREND,
    "formatted_trend_calendar": FORMATTED_TREND_CALENDAR,
    "formatted_summary": FORMATTED_SUMMARY,
    "formatted_slope": FORMATTED_SLOPE,
    "formatted_forecast": FORMATTED_FORECAST,
    "order_totals": ORDER_TOTALS,
    "payment_reconciliation": PAYMENT_RECONCILIATION,
    "payment_mismatches": PAYMENT_MISMATCHES,
    "reconciliation_summary": RECONCILIATION_SUMMARY,
    "orders_without_payments": ORDERS_WITHOUT_PAYMENTS,
    "payments_without_orders": PAYMENTS_WITHOUT_ORDERS,
    "unmatched_counts": UNMATCHED_COUNTS,
    "formatted_reconciliation": FORMATTED_RECONCILIATION,
    "formatted_reconciliation_summary": FORMATTED_RECONCILIATION_SUMMARY,
    "read_customers": READ_CUSTOMERS,
    "read_products": READ_PRODUCTS,
    "read_orders": READ_ORDERS,
    "read_order_items": READ_ORDER_ITEMS,
    "read_payments": READ_PAYMENTS,
    "ingest_orders_dates": READ_ORDERS,
    "ingest_payments_dates": READ_PAYMENTS,
    "ingest_orders_quarantine": INGEST_ORDERS_QUARANTINE,
    "upsert_latest_by_key": UPSERT_LATEST_BY_KEY,
    "table_row_counts": TABLE_ROW_COUNTS,
    "fk_orphan_counts": FK_ORPHAN_COUNTS,
    "key_null_audit": KEY_NULL_AUDIT,
    "gen_customers": GEN_CUSTOMERS,
    "gen_products": GEN_PRODUCTS,
    "gen_orders": GEN_ORDERS,
    "gen_order_items": GEN_ORDER_ITEMS,
    "gen_payments": GEN_PAYMENTS,
    "gen_volumes": GEN_VOLUMES,
    "ingest_load_counters": INGEST_LOAD_COUNTERS,
    "payment_reconciliation_positions": PAYMENT_RECONCILIATION_POSITIONS,
    "monthly_trend_positions": MONTHLY_TREND_POSITIONS,
    "reconciliation_unknown_amounts": RECONCILIATION_UNKNOWN_AMOUNTS,
}
