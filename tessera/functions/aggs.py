"""Aggregate-name map: the pandas names accepted by the reference → Spark aggregates.

Medians, quantiles and modes per group are not here: they need an index of the values (functions.stats).
Null rules: sum of nothing is 0 (N2), mean/min/max/std skip NULL (N3 after
NaN normalisation), first/last skip NULL and follow an explicit order key (N27).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import col_of, first_non_null, last_non_null, sum0


def agg_column(func: str, c: str, order_by: str | Column | None = None) -> Column:
    col = col_of(c)
    f = func.lower()
    if f == "sum":
        return sum0(col)
    if f in ("mean", "avg", "average"):
        return F.avg(col)
    if f == "min":
        return F.min(col)
    if f == "max":
        return F.max(col)
    if f == "count":
        return F.count(col)
    if f == "size":
        return F.count(F.lit(1))
    if f == "nunique":
        return F.count_distinct(col)
    if f == "median":
        return F.median(col)
    if f == "std":
        return F.stddev_samp(col)
    if f == "var":
        return F.var_samp(col)
    if f in ("prod", "product"):
        return F.coalesce(F.product(col), F.lit(1.0))
    if f in ("any", "all"):                       # truth of numbers and booleans; of nothing: any false, all true
        truth = col.cast("boolean")
        return F.coalesce(F.bool_or(truth), F.lit(False)) if f == "any" else F.coalesce(F.bool_and(truth), F.lit(True))
    if f == "sem":
        return F.stddev_samp(col) / F.sqrt(F.count(col))
    if f == "skew":                               # bias-corrected, as pandas; 0 without variance
        n = F.count(col)
        g = F.when(F.var_pop(col) == 0, F.lit(0.0)).otherwise(F.skewness(col))
        return F.when(n >= 3, g * F.sqrt((n * (n - 1)).cast("double")) / (n - 2))
    if f in ("first", "last"):
        if order_by is None:
            raise ValueError(f"aggregate '{f}' needs an explicit order_by column (Spark rows have no order)")
        if isinstance(order_by, (list, tuple)):   # compares like ORDER BY ... NULLS LAST
            order_by = F.struct(*[x for o in order_by for x in (col_of(o).isNull(), col_of(o))])
        return first_non_null(col, order_by) if f == "first" else last_non_null(col, order_by)
    raise ValueError(f"unknown aggregate function: {func}")


def quantile_of(func: str) -> float | None:
    """The quantile that a name asks for: median, quantile (0.5) or q1 to q99; None for other names."""
    f = func.lower()
    if f in ("median", "quantile"):
        return 0.5
    return int(f[1:]) / 100 if f[:1] == "q" and f[1:].isdigit() and 0 < int(f[1:]) < 100 else None


def agg_name(c: str, func: str) -> str:
    return f"{c}_{func}"
