"""Registered KPI queries. Several KPIs over one table share one aggregate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.time import ntz_lit
from ..operators import kpi as K
from ..sources import tables as tb
from .registry import query, rounded

S = f"({tb.SALES_SQL})"
P = f"({tb.PERFORMANCE_SQL})"
T = f"({tb.TRAINING_SQL})"


def _one(df, k: K.Kpi, digits: int = 4):
    return rounded(K.kpi_frame(df, [k]).select(k.name), digits)


@query("kpi_total_revenue", f"SELECT round(coalesce(sum(total_amount), 0), 2) AS total_revenue FROM {S}")
def q_total_revenue(spark, d):
    return _one(tb.sales(spark, d), K.total_revenue("total_amount"), 2)


@query("kpi_aov", f"SELECT round(avg(total_amount), 4) AS average_order_value FROM {S}")
def q_aov(spark, d):
    return _one(tb.sales(spark, d), K.average_order_value("total_amount"))


@query("kpi_aov_by_order", """
SELECT round(avg(s), 4) AS average_order_value
FROM (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1)
""")
def q_aov_by_order(spark, d):
    return rounded(K.average_order_value_by_order(tb.table(spark, d, "lineitem"), "l_extendedprice", "l_orderkey"))


@query("kpi_growth_rate", """
WITH s AS (SELECT coalesce(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 1998), 0) AS c,
                  coalesce(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 1997), 0) AS p FROM orders)
SELECT round(CASE WHEN p = 0 THEN 0 ELSE (c - p) / p * 100 END, 6) AS growth_rate FROM s
""")
def q_growth(spark, d):
    y = F.year("o_orderdate")
    v = F.col("o_totalprice")
    k = K.growth_rate(F.coalesce(F.sum(F.when(y == 1998, v)), F.lit(0.0)),
                      F.coalesce(F.sum(F.when(y == 1997, v)), F.lit(0.0)))
    return _one(tb.table(spark, d, "orders"), k, 6)


@query("kpi_conversion_rate", """
SELECT round(CASE WHEN count(*) = 0 THEN 0 ELSE count(*) FILTER (WHERE event_type = 'purchase') / count(*) * 100 END, 6)
       AS conversion_rate FROM events
""")
def q_conversion(spark, d):
    k = K.conversion_rate(F.count_if(F.col("event_type") == "purchase"), F.count(F.lit(1)))
    return _one(tb.table(spark, d, "events"), k, 6)


@query("kpi_aht", f"SELECT round(avg(avg_handling_time), 4) AS average_handling_time FROM {P}")
def q_aht(spark, d):
    return _one(tb.performance(spark, d), K.average_handling_time("avg_handling_time"))


@query("kpi_fcr", f"""
SELECT round(CASE WHEN count(*) > 0 THEN sum(CAST(first_call_resolution AS INTEGER)) / count(*) * 100 ELSE 0 END, 6)
       AS first_call_resolution FROM {P}
""")
def q_fcr(spark, d):
    return _one(tb.performance(spark, d), K.first_call_resolution("first_call_resolution"), 6)


@query("kpi_productivity", f"""
SELECT round(CASE WHEN sum(calls_handled) > 0 THEN sum(sales_amount) / sum(calls_handled) ELSE 0 END, 6)
       AS productivity_rate FROM {P}
""")
def q_productivity(spark, d):
    return _one(tb.performance(spark, d), K.productivity_rate("sales_amount", "calls_handled"), 6)


def _nps_input(spark, d):
    ev = tb.table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(F.when(F.col("event_id") % 13 == 0, None).otherwise(k % 11).alias("score"))


@query("kpi_nps", """
WITH s AS (SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) % 11 END
           AS score FROM events)
SELECT round(CASE WHEN count(*) = 0 THEN 0
             ELSE (count(*) FILTER (WHERE score >= 9) - count(*) FILTER (WHERE score <= 6)) / count(*) * 100 END, 6)
       AS net_promoter_score FROM s
""")
def q_nps(spark, d):
    return _one(_nps_input(spark, d), K.net_promoter_score("score"), 6)


@query("kpi_csat", f"SELECT round(avg(customer_satisfaction) / 5 * 100, 6) AS customer_satisfaction_score FROM {P}")
def q_csat(spark, d):
    return _one(tb.performance(spark, d), K.customer_satisfaction_score("customer_satisfaction"), 6)


@query("kpi_churn", """
SELECT round(CASE WHEN count(*) > 0 THEN coalesce(sum(toxic), 0) / count(*) * 100 ELSE 0 END, 6) AS churn_rate FROM labels
""")
def q_churn(spark, d):
    return _one(tb.table(spark, d, "labels"), K.churn_rate("toxic"), 6)


@query("kpi_retention", """
SELECT round(CASE WHEN count(*) > 0 THEN coalesce(sum(quality), 0) / count(*) * 100 ELSE 0 END, 6) AS retention_rate
FROM labels
""")
def q_retention(spark, d):
    return _one(tb.table(spark, d, "labels"), K.retention_rate("quality"), 6)


@query("kpi_training_completion", f"""
SELECT round(CASE WHEN count(*) > 0 THEN sum(CAST(completed AS INTEGER)) / count(*) * 100 ELSE 0 END, 6)
       AS training_completion_rate FROM {T}
""")
def q_training_completion(spark, d):
    return _one(tb.training(spark, d), K.training_completion_rate("completed"), 6)


@query("kpi_assessment", f"SELECT round(avg(score), 4) AS average_assessment_score FROM {T}")
def q_assessment(spark, d):
    return _one(tb.training(spark, d), K.average_assessment_score("score"))


@query("kpi_training_hours", f"""
SELECT round(CASE WHEN count(DISTINCT employee) > 0 THEN sum(hours) / count(DISTINCT employee) ELSE 0 END, 6)
       AS training_hours_per_employee FROM {T}
""")
def q_training_hours(spark, d):
    return _one(tb.training(spark, d), K.training_hours_per_employee("hours", "employee"), 6)


@query("kpi_certification", f"""
SELECT round(CASE WHEN count(*) > 0 THEN sum(CAST(certified AS INTEGER)) / count(*) * 100 ELSE 0 END, 6)
       AS certification_rate FROM {T}
""")
def q_certification(spark, d):
    return _one(tb.training(spark, d), K.certification_rate("certified"), 6)


def _perf_kpis():
    return [K.average_handling_time("avg_handling_time"), K.first_call_resolution("first_call_resolution"),
            K.productivity_rate("sales_amount", "calls_handled"),
            K.customer_satisfaction_score("customer_satisfaction"),
            K.conversion_rate(F.count_if(F.col("team") == "purchase"), F.count(F.lit(1)))]


_PERF_SQL = {
    "average_handling_time": "avg(avg_handling_time)",
    "first_call_resolution": "CASE WHEN count(*) > 0 THEN sum(CAST(first_call_resolution AS INTEGER)) / count(*) * 100 ELSE 0 END",
    "productivity_rate": "CASE WHEN sum(calls_handled) > 0 THEN sum(sales_amount) / sum(calls_handled) ELSE 0 END",
    "customer_satisfaction_score": "avg(customer_satisfaction) / 5 * 100",
    "conversion_rate": "CASE WHEN count(*) = 0 THEN 0 ELSE count(*) FILTER (WHERE team = 'purchase') / count(*) * 100 END",
}
_CAT = {"average_handling_time": "performance", "first_call_resolution": "performance",
        "productivity_rate": "performance", "customer_satisfaction_score": "customer", "conversion_rate": "sales"}


@query("kpi_summary", "\nUNION ALL\n".join(
    f"SELECT '{_CAT[n]}' AS category, '{n}' AS kpi_name, round({e}, 6) AS value FROM {P}" for n, e in _PERF_SQL.items()))
def q_kpi_summary(spark, d):
    return rounded(K.kpi_summary(tb.performance(spark, d), _perf_kpis()), 6)


_SPLIT = "TIMESTAMP '2024-01-16'"


@query("kpi_compare", "WITH " + ", ".join([
    f"c AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _PERF_SQL.items())} FROM {P} WHERE date >= {_SPLIT})",
    f"p AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _PERF_SQL.items())} FROM {P} WHERE date < {_SPLIT})"])
    + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS kpi_name, round(c.{n}, 6) AS current, round(p.{n}, 6) AS previous,
        round(c.{n} - p.{n}, 6) AS change,
        round(CASE WHEN p.{n} <> 0 THEN (c.{n} - p.{n}) / p.{n} * 100 ELSE 0 END, 6) AS change_percentage,
        CASE WHEN c.{n} - p.{n} > 0 THEN 'up' WHEN c.{n} - p.{n} < 0 THEN 'down' ELSE 'stable' END AS trend
        FROM c, p""" for n in _PERF_SQL))
def q_kpi_compare(spark, d):
    perf = tb.performance(spark, d)
    split = ntz_lit(dt.datetime(2024, 1, 16))
    cur, prev = perf.where(F.col("date") >= split), perf.where(F.col("date") < split)
    return rounded(K.compare_kpis(cur, prev, _perf_kpis()), 6)


WEEKLY_KPIS = [
    {"name": "Total Calls", "column": "calls_handled", "aggregation": "sum", "format": "number"},
    {"name": "Average Handling Time", "column": "avg_handling_time", "aggregation": "mean", "format": "time"},
    {"name": "FCR Rate", "column": "fcr_pct", "aggregation": "mean", "format": "percentage"},
    {"name": "CSAT Score", "column": "customer_satisfaction", "aggregation": "mean", "format": "decimal"},
    {"name": "Total Sales", "column": "sales_amount", "aggregation": "sum", "format": "currency"},
    {"name": "Conversion Rate", "column": "conversion_pct", "aggregation": "mean", "format": "percentage"},
]
_SPEC_SQL = {
    "Total Calls": ("CAST(sum(calls_handled) AS DOUBLE)", "format('{:,.0f}', v)"),
    "Average Handling Time": ("avg(avg_handling_time)",
                              "CASE WHEN v < 60 THEN printf('%.1fs', v) WHEN v < 3600 THEN printf('%.1fm', v / 60) ELSE printf('%.1fh', v / 3600) END"),
    "FCR Rate": ("avg(CAST(first_call_resolution AS INTEGER) * 100.0)", "printf('%.1f%%', v)"),
    "CSAT Score": ("avg(customer_satisfaction)", "printf('%.2f', v)"),
    "Total Sales": ("sum(sales_amount)", "'$' || format('{:,.2f}', v)"),
    "Conversion Rate": ("avg(conversion_rate * 100)", "printf('%.1f%%', v)"),
}


def _spec_input(spark, d):
    return tb.performance(spark, d).withColumns({
        "fcr_pct": F.col("first_call_resolution").cast("int") * 100.0,
        "conversion_pct": F.col("conversion_rate") * 100})


@query("kpi_spec", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS kpi_name, round(v, 4) AS value, {f} AS display FROM (SELECT {e} AS v FROM {P})"
    for n, (e, f) in _SPEC_SQL.items()))
def q_kpi_spec(spark, d):
    src = _spec_input(spark, d)
    kpis = K.spec_kpis(WEEKLY_KPIS)
    wide = K.kpi_frame(src, kpis)
    fmt = {s["name"]: s.get("format") for s in WEEKLY_KPIS}
    rows = F.array(*[F.struct(F.lit(k.name).alias("kpi_name"), F.col(k.name).alias("value"),
                              K.format_value(F.col(k.name), fmt[k.name]).alias("display")) for k in kpis])
    return rounded(wide.select(F.inline(rows)), 4)


@query("kpi_format", f"""
SELECT agent_id, round(v, 4) AS seconds,
       CASE WHEN v < 60 THEN printf('%.1fs', v) WHEN v < 3600 THEN printf('%.1fm', v / 60) ELSE printf('%.1fh', v / 3600) END
       AS duration
FROM (SELECT agent_id, CAST(sum(avg_handling_time) AS DOUBLE) * 3 AS v FROM {P} GROUP BY agent_id)
""")
def q_kpi_format(spark, d):
    perf = tb.performance(spark, d)
    g = perf.groupBy("agent_id").agg((F.sum("avg_handling_time").cast("double") * 3).alias("seconds"))
    return rounded(g.withColumn("duration", K.format_duration(F.col("seconds"))), 4)
