"""The reports of the reference as compositions of operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import literal_like, trunc_ntz
from ..operators import cleaning as cl
from ..operators import transform as tr


def daily_sales(sales: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """extract → dedup → drop nulls → aggregate by category (sum, sum, mean) → sort desc.

    ``as_of`` selects one day (the reference's ``date = CURRENT_DATE``, made an
    explicit parameter); ``None`` keeps every day.
    """
    src = sales
    if as_of is not None:
        start = dt.datetime.combine(as_of, dt.time())
        src = src.where((F.col("date") >= literal_like(src, "date", start))
                        & (F.col("date") < literal_like(src, "date", start + dt.timedelta(days=1))))
    clean = cl.remove_nulls(cl.remove_duplicates(src))
    agg = tr.aggregate(clean, ["category"], {"total_amount": "sum", "quantity": "sum", "unit_price": "mean"})
    return tr.sort(agg, "total_amount", ascending=False)


# ---- report source queries as SQL text with named parameters (the configs' SELECTs) ----

DAILY_SQL = """
SELECT date, product_id, product_name, category, quantity, unit_price, total_amount, customer_id, region
FROM {sales}
WHERE date >= CAST(:day_start AS TIMESTAMP_NTZ) AND date < CAST(:day_end AS TIMESTAMP_NTZ)
ORDER BY total_amount DESC
"""

WEEKLY_SQL = """
SELECT date, agent_id, agent_name, team, calls_handled, avg_handling_time, first_call_resolution,
       customer_satisfaction, sales_amount, conversion_rate
FROM {performance_metrics}
WHERE date >= CAST(:since AS TIMESTAMP_NTZ)
ORDER BY date, agent_id
"""

MONTHLY_SQL = """
SELECT date, department, revenue, costs, profit, headcount, productivity_index, customer_count, new_customers,
       churned_customers
FROM {monthly_summary}
WHERE date >= CAST(:month_start AS TIMESTAMP_NTZ)
"""


def sql_daily(spark, sales: DataFrame, as_of: dt.date) -> DataFrame:
    start = dt.datetime.combine(as_of, dt.time())
    return spark.sql(DAILY_SQL, args={"day_start": str(start), "day_end": str(start + dt.timedelta(days=1))},
                     sales=sales)


def sql_weekly(spark, performance: DataFrame, as_of: dt.date) -> DataFrame:
    since = dt.datetime.combine(as_of, dt.time()) - dt.timedelta(days=7)
    return spark.sql(WEEKLY_SQL, args={"since": str(since)}, performance_metrics=performance)


def sql_monthly(spark, monthly: DataFrame, as_of: dt.date) -> DataFrame:
    start = dt.datetime(as_of.year, as_of.month, 1)
    return spark.sql(MONTHLY_SQL, args={"month_start": str(start)}, monthly_summary=monthly)


# fixed values: as declared for the report
WEEKLY_TEAM_METRICS = {"calls_handled": "sum", "avg_handling_time": "mean", "first_call_resolution": "mean",
                       "customer_satisfaction": "mean", "sales_amount": "sum", "conversion_rate": "mean"}


def weekly_kpi(performance: DataFrame, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """extract (trailing 7 days) → clean → by-team aggregate, KPI list, daily trend.

    The reference never applies its aggregation and its KPI table is always
    empty; here the declared aggregation and KPI list are computed."""
    from ..operators import kpi as K
    src = performance
    if as_of is not None:
        since = dt.datetime.combine(as_of, dt.time()) - dt.timedelta(days=7)
        src = src.where(F.col("date") >= literal_like(performance, "date", since))
    clean = cl.remove_nulls(cl.remove_duplicates(src))
    clean = clean.withColumn("first_call_resolution", F.col("first_call_resolution").cast("double"))
    by_team = tr.sort(tr.aggregate(clean, ["team"], WEEKLY_TEAM_METRICS), "sales_amount", ascending=False)
    specs = [{"name": "Total Calls", "column": "calls_handled", "aggregation": "sum", "category": "performance"},
             {"name": "Average Handling Time", "column": "avg_handling_time", "aggregation": "mean",
              "category": "performance"},
             {"name": "FCR Rate", "column": "first_call_resolution", "aggregation": "mean",
              "category": "performance"},
             {"name": "CSAT Score", "column": "customer_satisfaction", "aggregation": "mean", "category": "customer"},
             {"name": "Total Sales", "column": "sales_amount", "aggregation": "sum", "category": "sales"},
             {"name": "Conversion Rate", "column": "conversion_rate", "aggregation": "mean", "category": "sales"}]
    kpis = K.kpi_summary(clean, K.spec_kpis(specs))
    trend = tr.aggregate(clean.withColumn("day", trunc_ntz(F.col("date"), "day")), ["day"],
                         {"calls_handled": "sum", "sales_amount": "sum"})
    return {"by_team": by_team, "kpis": kpis, "trend": trend}


# fixed values: as declared for the report
MONTHLY_STEPS = [
    {"type": "aggregate", "groupby": ["department"],
     "metrics": {"revenue": "sum", "costs": "sum", "profit": "sum", "headcount": "mean",
                 "productivity_index": "mean", "customer_count": "last", "new_customers": "sum",
                 "churned_customers": "sum"}},
    {"type": "calculate", "name": "profit_margin", "expression": "(profit / revenue) * 100"},
    {"type": "calculate", "name": "net_customer_growth", "expression": "new_customers - churned_customers"},
    {"type": "sort", "by": "profit", "ascending": False},
]


def monthly_summary(monthly: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """extract (month to date, or all months) → clean → aggregate by department
    (``last`` by date) → two calculated columns → sort by profit."""
    from .steps import apply_transformations
    src = monthly
    if as_of is not None:
        src = src.where(F.col("date") >= literal_like(src, "date", dt.datetime(as_of.year, as_of.month, 1)))
    clean = cl.remove_nulls(cl.remove_duplicates(src))
    return apply_transformations(clean, MONTHLY_STEPS, order_by="date")


def training(records: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """dedup → completion rate and average score (when the columns exist), one row.
    With ``as_of``, only records completed in the 30 days before it or later."""
    from ..operators import kpi as K
    src = records
    if as_of is not None:
        since = dt.datetime.combine(as_of, dt.time()) - dt.timedelta(days=30)
        src = src.where(F.col("completion_date") >= literal_like(src, "completion_date", since))
    clean = cl.remove_duplicates(src)
    kpis = []
    if "completed" in clean.columns:
        kpis.append(K.training_completion_rate("completed"))
    if "score" in clean.columns:
        kpis.append(K.average_assessment_score("score"))
    kpis.append(K.Kpi("records", "training", F.count(F.lit(1))))
    return K.kpi_frame(clean, kpis).select(*[k.name for k in kpis])


# fixed values: as declared for the report
MONTHLY_KPIS = [
    {"name": "Total Revenue", "column": "revenue", "aggregation": "sum", "format": "currency",
     "compare_previous": True},
    {"name": "Total Profit", "column": "profit", "aggregation": "sum", "format": "currency",
     "compare_previous": True},
    {"name": "Profit Margin", "column": "profit_margin", "aggregation": "mean", "format": "percentage"},
    {"name": "Customer Base", "column": "customer_count", "aggregation": "last", "format": "number"},
    {"name": "Net Customer Growth", "column": "net_customer_growth", "aggregation": "sum", "format": "number",
     "compare_previous": True},
]


def monthly_kpis(monthly: DataFrame, as_of: dt.date, specs: list[dict] | None = None) -> DataFrame:
    """The declared monthly KPIs, one row each, from one aggregate over one read of
    both months: the month of ``as_of`` and, for KPIs that ask for
    ``compare_previous``, the month before with change, change_percentage and
    trend (NULL for the others)."""
    from ..operators import kpi as K
    specs = list(specs or MONTHLY_KPIS)
    rows = (monthly.withColumn("profit_margin", F.try_divide(F.col("profit"), F.col("revenue")) * 100)
            .withColumn("net_customer_growth", F.col("new_customers") - F.col("churned_customers")))
    start = dt.datetime(as_of.year, as_of.month, 1)
    prev = dt.datetime(start.year - (start.month == 1), (start.month - 2) % 12 + 1, 1)
    nxt = dt.datetime(start.year + (start.month == 12), start.month % 12 + 1, 1)
    d = F.col("date")
    both = (rows.where((d >= literal_like(rows, "date", prev)) & (d < literal_like(rows, "date", nxt)))
            .withColumn("__period", F.when(d >= literal_like(rows, "date", start), "current").otherwise("previous")))
    table = K.compare_tagged(both, K.spec_kpis(specs, order_by=F.struct("date", "department")))
    compared = F.col("kpi_name").isin([s["name"] for s in specs if s.get("compare_previous")])
    return table.select("kpi_name", "current", *[F.when(compared, F.col(c)).alias(c)
                                                 for c in ("previous", "change", "change_percentage", "trend")])
