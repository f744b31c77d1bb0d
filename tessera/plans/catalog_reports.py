"""Registered report queries."""

from __future__ import annotations

from ..sources import tables as tb
from . import reports
from .registry import query, rounded


@query("report_daily_sales", f"""
WITH sales AS ({tb.SALES_SQL}),
d AS (SELECT DISTINCT * FROM sales),
nn AS (SELECT * FROM d WHERE date IS NOT NULL AND product_id IS NOT NULL AND product_name IS NOT NULL
       AND category IS NOT NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL
       AND total_amount IS NOT NULL AND customer_id IS NOT NULL AND region IS NOT NULL)
SELECT category, round(sum(total_amount), 4) AS total_amount, round(sum(quantity), 4) AS quantity,
       round(avg(unit_price), 4) AS unit_price
FROM nn GROUP BY category ORDER BY total_amount DESC
""")
def q_report_daily_sales(spark, d):
    return rounded(reports.daily_sales(tb.sales(spark, d)))


import datetime as _dt  # noqa: E402

from pyspark.sql import functions as _F  # noqa: E402


@query("sql_daily", f"""
SELECT * FROM ({tb.SALES_SQL}) WHERE date >= TIMESTAMP '1996-03-15' AND date < TIMESTAMP '1996-03-16'
ORDER BY total_amount DESC
""")
def q_sql_daily(spark, d):
    return reports.sql_daily(spark, tb.sales(spark, d), _dt.date(1996, 3, 15))


@query("sql_weekly", f"""
SELECT date, agent_id, agent_name, team, calls_handled, avg_handling_time, first_call_resolution,
       customer_satisfaction, sales_amount, conversion_rate
FROM ({tb.PERFORMANCE_SQL}) WHERE date >= TIMESTAMP '2024-01-13' ORDER BY date, agent_id
""")
def q_sql_weekly(spark, d):
    return reports.sql_weekly(spark, tb.performance(spark, d), _dt.date(2024, 1, 20))


@query("sql_monthly", f"""
SELECT date, department, round(revenue, 4) AS revenue, round(costs, 4) AS costs, round(profit, 4) AS profit, headcount,
       round(productivity_index, 4) AS productivity_index, customer_count, new_customers, churned_customers
FROM ({tb.MONTHLY_SQL}) WHERE date >= TIMESTAMP '2000-06-01'
""")
def q_sql_monthly(spark, d):
    r = reports.sql_monthly(spark, tb.monthly(spark, d, since=_dt.datetime(2000, 6, 1)), _dt.date(2000, 6, 15))
    return rounded(r, 4)


_WEEK = f"""(SELECT DISTINCT * FROM ({tb.PERFORMANCE_SQL}) WHERE date >= TIMESTAMP '2024-01-13')"""


@query("report_weekly_kpi", f"""
SELECT team, CAST(sum(calls_handled) AS BIGINT) AS calls_handled, round(avg(avg_handling_time), 4) AS avg_handling_time,
       round(avg(CAST(first_call_resolution AS DOUBLE)), 4) AS first_call_resolution,
       round(avg(customer_satisfaction), 4) AS customer_satisfaction, round(sum(sales_amount), 4) AS sales_amount,
       round(avg(conversion_rate), 4) AS conversion_rate
FROM {_WEEK} GROUP BY team
""")
def q_report_weekly(spark, d):
    return rounded(reports.weekly_kpi(tb.performance(spark, d), _dt.date(2024, 1, 20))["by_team"])


@query("report_weekly_kpi_list", f"""
SELECT 'performance' AS category, 'Total Calls' AS kpi_name, round(CAST(sum(calls_handled) AS DOUBLE), 4) AS value FROM {_WEEK}
UNION ALL SELECT 'performance', 'Average Handling Time', round(avg(avg_handling_time), 4) FROM {_WEEK}
UNION ALL SELECT 'performance', 'FCR Rate', round(avg(CAST(first_call_resolution AS DOUBLE)), 4) FROM {_WEEK}
UNION ALL SELECT 'customer', 'CSAT Score', round(avg(customer_satisfaction), 4) FROM {_WEEK}
UNION ALL SELECT 'sales', 'Total Sales', round(sum(sales_amount), 4) FROM {_WEEK}
UNION ALL SELECT 'sales', 'Conversion Rate', round(avg(conversion_rate), 4) FROM {_WEEK}
""")
def q_report_weekly_list(spark, d):
    return rounded(reports.weekly_kpi(tb.performance(spark, d), _dt.date(2024, 1, 20))["kpis"])


@query("report_weekly_kpi_trend", f"""
SELECT date_trunc('day', date) AS day, CAST(sum(calls_handled) AS BIGINT) AS calls_handled,
       round(sum(sales_amount), 4) AS sales_amount FROM {_WEEK} GROUP BY 1
""")
def q_report_weekly_trend(spark, d):
    return rounded(reports.weekly_kpi(tb.performance(spark, d), _dt.date(2024, 1, 20))["trend"])


@query("report_monthly_summary", f"""
WITH m AS (SELECT DISTINCT * FROM ({tb.MONTHLY_SQL})),
a AS (SELECT department, sum(revenue) AS revenue, sum(costs) AS costs, sum(profit) AS profit,
             avg(headcount) AS headcount, avg(productivity_index) AS productivity_index,
             arg_max(customer_count, date) AS customer_count, sum(new_customers) AS new_customers,
             sum(churned_customers) AS churned_customers
      FROM m WHERE department IS NOT NULL GROUP BY department)
SELECT department, round(revenue, 4) AS revenue, round(costs, 4) AS costs, round(profit, 4) AS profit,
       round(headcount, 4) AS headcount, round(productivity_index, 4) AS productivity_index, customer_count,
       new_customers, churned_customers, round(profit / revenue * 100, 4) AS profit_margin,
       new_customers - churned_customers AS net_customer_growth
FROM a ORDER BY profit DESC
""")
def q_report_monthly(spark, d):
    return rounded(reports.monthly_summary(tb.monthly(spark, d)), 4)


@query("report_training", f"""
WITH t AS (SELECT DISTINCT * FROM ({tb.TRAINING_SQL}))
SELECT round(CASE WHEN count(*) > 0 THEN sum(CAST(completed AS INTEGER)) / count(*) * 100 ELSE 0 END, 6)
       AS training_completion_rate, round(avg(score), 6) AS average_assessment_score,
       CAST(count(*) AS DOUBLE) AS records FROM t
""")
def q_report_training(spark, d):
    return rounded(reports.training(tb.training(spark, d)), 6)


@query("report_training_window", f"""
WITH t AS (SELECT DISTINCT * FROM ({tb.TRAINING_SQL}) WHERE completion_date >= DATE '2024-05-16')
SELECT round(CASE WHEN count(*) > 0 THEN sum(CAST(completed AS INTEGER)) / count(*) * 100 ELSE 0 END, 6)
       AS training_completion_rate, round(avg(score), 6) AS average_assessment_score,
       CAST(count(*) AS DOUBLE) AS records FROM t
""")
def q_report_training_window(spark, d):
    return rounded(reports.training(tb.training(spark, d), _dt.date(2024, 6, 15)), 6)


def _monthly_kpi_sql():
    m = f"(SELECT *, profit / revenue * 100 AS profit_margin, new_customers - churned_customers AS net_customer_growth FROM ({tb.MONTHLY_SQL}))"
    kpis = [("Total Revenue", "revenue"), ("Total Profit", "profit"), ("Net Customer Growth", "net_customer_growth")]
    parts = []
    for name, col in kpis:
        c = f"coalesce(sum({col}) FILTER (WHERE date >= TIMESTAMP '2001-07-01' AND date < TIMESTAMP '2001-08-01'), 0)"
        p = f"coalesce(sum({col}) FILTER (WHERE date >= TIMESTAMP '2001-06-01' AND date < TIMESTAMP '2001-07-01'), 0)"
        parts.append(f"""SELECT '{name}' AS kpi_name, round({c}, 4) AS current, round({p}, 4) AS previous,
            round({c} - {p}, 4) AS change,
            round(CASE WHEN {p} <> 0 THEN ({c} - {p}) / {p} * 100 ELSE 0 END, 4) AS change_percentage,
            CASE WHEN {c} - {p} > 0 THEN 'up' WHEN {c} - {p} < 0 THEN 'down' ELSE 'stable' END AS trend FROM {m}""")
    july = "FILTER (WHERE date >= TIMESTAMP '2001-07-01' AND date < TIMESTAMP '2001-08-01')"
    for name, value in (("Profit Margin", f"avg(profit_margin) {july}"),
                        ("Customer Base", f"CAST(last(customer_count ORDER BY date, department) {july} AS DOUBLE)")):
        parts.append(f"""SELECT '{name}', round({value}, 4), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
            CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR) FROM {m}""")
    return "\nUNION ALL\n".join(parts)


@query("report_monthly_kpis", _monthly_kpi_sql())
def q_report_monthly_kpis(spark, d):
    both = tb.monthly(spark, d, since=_dt.datetime(2001, 6, 1), until=_dt.datetime(2001, 8, 1))
    r = reports.monthly_kpis(both, _dt.date(2001, 7, 15))
    return r.select("kpi_name", *[_F.round(c, 4).alias(c) for c in ("current", "previous", "change")],
                    _F.round("change_percentage", 4).alias("change_percentage"), "trend")
