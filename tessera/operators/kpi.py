"""KPIs as aggregate expressions, fused into one aggregate per table.

A ``Kpi`` is (name, category, value expression, recorded expression). Any set
of KPIs over one table is computed by one ``agg`` (one scan, partial
aggregation); ``kpi_summary`` lays the one-row result out as the long table
(category, kpi_name, value). A KPI whose denominator is zero has value 0 and,
as in the reference, is not recorded in the summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import agg_column
from ..functions.nulls import col_of, drop_null_keys, nan_to_null, sum0


@dataclass(frozen=True)
class Kpi:
    name: str
    category: str
    value: Column
    recorded: Column = None  # type: ignore[assignment]

    def record_expr(self) -> Column:
        return F.lit(True) if self.recorded is None else self.recorded


def _flag_sum(c) -> Column:
    return sum0(col_of(c).cast("int"))


def _rate(numer: Column, denom: Column, scale: float = 100.0) -> Column:
    return F.when(denom > 0, numer / denom * scale).otherwise(F.lit(0.0))


def _n() -> Column:
    return F.count(F.lit(1))


# sales
def total_revenue(amount: str) -> Kpi:
    return Kpi("total_revenue", "sales", sum0(amount).cast("double"))


def average_order_value(amount: str) -> Kpi:
    return Kpi("average_order_value", "sales", F.avg(amount))


def growth_rate(current: Column, previous: Column) -> Kpi:
    return Kpi("growth_rate", "sales",
               F.when(previous == 0, F.lit(0.0)).otherwise((current - previous) / previous * 100),
               previous != 0)


def conversion_rate(conversions: Column, total: Column) -> Kpi:
    return Kpi("conversion_rate", "sales",
               F.when(total == 0, F.lit(0.0)).otherwise(conversions / total * 100), total != 0)


# performance
def average_handling_time(time: str) -> Kpi:
    return Kpi("average_handling_time", "performance", F.avg(time))


def first_call_resolution(resolved: str, total: str | None = None) -> Kpi:
    denom = _n() if total is None else sum0(total)
    return Kpi("first_call_resolution", "performance", _rate(_flag_sum(resolved), denom))


def productivity_rate(output: str, hours: str) -> Kpi:
    return Kpi("productivity_rate", "performance", _rate(sum0(output), sum0(hours), 1.0))


# customer
def net_promoter_score(score: str) -> Kpi:
    s = F.col(score)
    return Kpi("net_promoter_score", "customer",
               _rate(F.count_if(s >= 9) - F.count_if(s <= 6), _n()), _n() > 0)


def customer_satisfaction_score(score: str, max_score: float = 5) -> Kpi:
    return Kpi("customer_satisfaction_score", "customer", F.avg(score) / F.lit(float(max_score)) * 100)


def churn_rate(flag: str) -> Kpi:
    return Kpi("churn_rate", "customer", _rate(_flag_sum(flag), _n()))


def retention_rate(flag: str) -> Kpi:
    return Kpi("retention_rate", "customer", _rate(_flag_sum(flag), _n()))


# training
def training_completion_rate(flag: str) -> Kpi:
    return Kpi("training_completion_rate", "training", _rate(_flag_sum(flag), _n()))


def average_assessment_score(score: str) -> Kpi:
    return Kpi("average_assessment_score", "training", F.avg(score))


def training_hours_per_employee(hours: str, employee: str, exact: bool = True) -> Kpi:
    distinct = F.count_distinct(employee) if exact else F.approx_count_distinct(employee)
    return Kpi("training_hours_per_employee", "training", _rate(sum0(hours), distinct, 1.0))


def certification_rate(flag: str) -> Kpi:
    return Kpi("certification_rate", "training", _rate(_flag_sum(flag), _n()))


def average_order_value_by_order(df: DataFrame, amount: str, order: str) -> DataFrame:
    """Mean of per-order sums (two-level aggregate; NULL order keys dropped, N1)."""
    per_order = drop_null_keys(df, [order]).groupBy(order).agg(sum0(amount).alias("__s"))
    return per_order.agg(F.avg("__s").alias("average_order_value"))


def kpi_frame(df: DataFrame, kpis: Sequence[Kpi], group_by: Sequence[str] = ()) -> DataFrame:
    """All KPIs of one table in one aggregate: one row (or one row per group)."""
    df = nan_to_null(df)
    exprs = [k.value.cast("double").alias(k.name) for k in kpis]
    exprs += [k.record_expr().alias(f"__rec_{k.name}") for k in kpis]
    return df.groupBy(*group_by).agg(*exprs)


def kpi_summary(df: DataFrame, kpis: Sequence[Kpi], group_by: Sequence[str] = ()) -> DataFrame:
    """Long table (category, kpi_name, value) of the recorded KPIs."""
    wide = kpi_frame(df, kpis, group_by)
    rows = F.array(*[F.struct(F.lit(k.category).alias("category"), F.lit(k.name).alias("kpi_name"),
                              F.col(k.name).alias("value"), F.col(f"__rec_{k.name}").alias("__rec"))
                     for k in kpis])
    return (wide.select(*group_by, F.inline(rows)).where(F.col("__rec")).drop("__rec"))


def compare_kpis(current: DataFrame, previous: DataFrame, kpis: Sequence[Kpi]) -> DataFrame:
    """Per KPI: current, previous, change, change_percentage (0 if previous is 0), trend.

    Both periods go through one aggregate grouped by a period tag; the rest
    works on two rows. Where both come from one table, tag its rows instead
    (``compare_tagged``), so that it is read once."""
    return compare_tagged(current.withColumn("__period", F.lit("current")).unionByName(
        previous.withColumn("__period", F.lit("previous")), allowMissingColumns=True), kpis)


def compare_tagged(tagged: DataFrame, kpis: Sequence[Kpi]) -> DataFrame:
    """``compare_kpis`` of one table whose column ``__period`` is 'current' or 'previous'."""
    wide = kpi_frame(tagged, kpis, ["__period"])
    long = wide.select("__period", F.inline(F.array(*[
        F.struct(F.lit(k.name).alias("kpi_name"), F.col(k.name).alias("value")) for k in kpis])))
    p = long.groupBy("kpi_name").agg(
        F.max(F.when(F.col("__period") == "current", F.col("value"))).alias("current"),
        F.max(F.when(F.col("__period") == "previous", F.col("value"))).alias("previous"))
    change = F.col("current") - F.col("previous")
    return p.select(
        "kpi_name", "current", "previous", change.alias("change"),
        F.when(F.col("previous") != 0, change / F.col("previous") * 100).otherwise(F.lit(0.0)).alias(
            "change_percentage"),
        F.when(change > 0, "up").when(change < 0, "down").otherwise("stable").alias("trend"))


def spec_kpis(specs: Sequence[dict], order_by: str | None = None) -> list[Kpi]:
    """Declared KPI list (name, column, aggregation[, format]) → Kpi objects."""
    out = []
    for s in specs:
        out.append(Kpi(s["name"], s.get("category", "report"),
                       agg_column(s.get("aggregation", "sum"), s["column"], order_by)))
    return out


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text rounded like Python's ``f"{v:.{digits}f}"`` (correct rounding of
    the binary value; ``format_string`` would round the shortest decimal form half-up)."""
    return F.regexp_replace(F.format_number(value.cast("double"), digits), ",", "")


def format_duration(seconds: Column) -> Column:
    """``<60 s → "x.xs"``, ``<3600 → "x.xm"``, else ``"x.xh"``."""
    s = seconds.cast("double")
    return (F.when(s < 60, F.concat(fixed(s, 1), F.lit("s")))
            .when(s < 3600, F.concat(fixed(s / 60, 1), F.lit("m")))
            .otherwise(F.concat(fixed(s / 3600, 1), F.lit("h"))))


def format_value(value: Column, fmt: str | None) -> Column:
    """Display string for a declared KPI format: time, percentage, decimal, currency, number."""
    if fmt == "time":
        return format_duration(value)
    if fmt == "percentage":
        return F.concat(fixed(value, 1), F.lit("%"))
    if fmt == "decimal":
        return fixed(value, 2)
    if fmt == "currency":
        return F.concat(F.lit("$"), F.format_number(value, 2))
    if fmt == "number":
        return F.format_number(value, 0)
    return value.cast("string")
