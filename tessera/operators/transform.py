"""Transformation operators: columns, expressions, group-by, pivot/melt, sort,
filters, joins, per-value functions and time resampling."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions
from ..functions.aggs import agg_column, quantile_of
from ..functions.nulls import (as_list, contains_regex, drop_null_keys, isin_with_null, nan_to_null,
                               ne_keep_null, numeric_columns, sort_exprs)


def add_column(df: DataFrame, name: str, value=None, formula=None, return_type: str = "double") -> DataFrame:
    """Add a constant, a Column, a pandas-eval style expression string, or a
    Python row function (Arrow-batched pandas UDF over the row struct)."""
    if formula is None:
        return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    if isinstance(formula, Column):
        return df.withColumn(name, formula)
    if isinstance(formula, str):
        return df.withColumn(name, expressions.to_column(formula))
    if callable(formula):
        fn = formula

        @F.pandas_udf(return_type)
        def _row_fn(rows: pd.DataFrame) -> pd.Series:
            return rows.apply(fn, axis=1)

        return df.withColumn(name, _row_fn(F.struct(*[F.col(c) for c in df.columns])))
    raise TypeError("formula must be a Column, an expression string or a callable")


def calculate_column(df: DataFrame, name: str, expression: str) -> DataFrame:
    """``(profit / revenue) * 100``-style expression; division by zero → NULL (N18)."""
    return df.withColumn(name, expressions.to_column(expression))


def aggregate(df: DataFrame, groupby: Sequence[str] | str, aggregations: dict[str, str | list[str]],
              order_by: str | Column | None = None) -> DataFrame:
    """Group-by with pandas-named functions. A single function keeps the column
    name; a list names the outputs ``col_func``. NULL and NaN keys are dropped (N1, N3),
    sums of nothing are 0 (N2), first/last follow ``order_by`` (N27)."""
    keys = as_list(groupby)
    df = nan_to_null(df, [*keys, *aggregations])
    exprs, medians, modes, order = [], [], [], []
    for c, funcs in aggregations.items():
        multi = isinstance(funcs, (list, tuple))
        for f in (funcs if multi else [funcs]):
            name = f"{c}_{f}" if multi else c
            order.append(name)
            if quantile_of(f) is not None and keys:
                medians.append((c, quantile_of(f), name))      # exact and distributed, see functions.stats
            elif f == "mode" and keys:
                modes.append((c, name))
            else:
                exprs.append(agg_column(f, c, order_by).alias(name))
    src = drop_null_keys(df, keys)
    if not medians and not modes:
        return src.groupBy(*keys).agg(*exprs)
    from ..functions.stats import grouped_modes, grouped_quantiles
    # all medians share one value index; a group of missing values only is in the other half
    out = src.groupBy(*keys).agg(*exprs) if exprs else src.select(*keys).distinct()
    if medians:
        out = out.join(grouped_quantiles(src, keys, medians), keys, "left")
    for c, name in modes:
        out = out.join(grouped_modes(src, keys, c, name), keys, "left")
    return out.select(*keys, *order)


def pivot(df: DataFrame, index: Sequence[str] | str, columns: str, values: str, aggfunc: str = "sum",
          column_values: Sequence | None = None, order_by: Sequence[str] | str | Column | None = None) -> DataFrame:
    """Long → wide. Cells are aggregated first (so a present all-null cell is 0
    for sum, N19) and then spread with ``first``; absent cells are NULL. Pass
    ``column_values`` to skip the extra distinct job on big tables; ``first`` and ``last`` follow ``order_by`` (N27)."""
    idx = as_list(index)
    cell = aggregate(df, idx + [columns], {values: aggfunc}, order_by).withColumnRenamed(values, "__v")
    vals = sorted(column_values) if column_values is not None else None
    return cell.groupBy(*idx).pivot(columns, vals).agg(F.first("__v"))


def melt(df: DataFrame, id_vars: Sequence[str] | str, value_vars: Sequence[str] | None = None,
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide → long; keeps NULL values; mixed value types become strings (N24)."""
    ids = as_list(id_vars)
    vals = as_list(value_vars) or [c for c in df.columns if c not in ids]
    types = {df.schema[c].dataType.simpleString() for c in vals}
    src = df
    if len(types) > 1:
        if all(c in numeric_columns(df) for c in vals):
            src = df.withColumns({c: F.col(c).cast("double") for c in vals})
        else:
            src = df.withColumns({c: F.col(c).cast("string") for c in vals})
    return src.unpivot(ids, vals, var_name, value_name)


def sort(df: DataFrame, by: Sequence[str] | str, ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Global sort, NULLs last both ways (N9). Range-partitioned by Spark."""
    return df.orderBy(*sort_exprs(by, ascending))


def predicate(column: str, condition: str, value) -> Column | None:
    c = F.col(column)
    cond = condition.lower()
    if cond in ("eq", "==", "equals"):
        return c == F.lit(value)
    if cond in ("ne", "!=", "not_equals"):
        return ne_keep_null(c, value)
    if cond in ("gt", ">"):
        return c > F.lit(value)
    if cond in ("lt", "<"):
        return c < F.lit(value)
    if cond in ("gte", ">="):
        return c >= F.lit(value)
    if cond in ("lte", "<="):
        return c <= F.lit(value)
    if cond == "in":
        return isin_with_null(c, as_list(value))
    if cond == "contains":
        return contains_regex(c, str(value))
    return None


def filter_rows(df: DataFrame, column: str, condition: str, value) -> DataFrame:
    """Eight predicates with pandas null rules (N6-N8); unknown condition → unchanged."""
    p = predicate(column, condition, value)
    return df if p is None else df.where(p)       # a NULL outcome drops the row; plain predicates reach the scan


def filter_all(df: DataFrame, conditions: dict[str, object]) -> DataFrame:
    """AND of equalities ``{column: value}``."""
    if not conditions:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in conditions.items()]))


def join(df: DataFrame, other: DataFrame, on: Sequence[str] | str, how: str = "left",
         suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join on same-named keys with pandas merge semantics: NULL keys match
    each other (N4, planned as a normal hash/sort-merge key by Spark), other
    overlapping columns get suffixes (N5), the key appears once."""
    keys = as_list(on)
    how = {"outer": "full_outer", "full": "full_outer"}.get(how, how)
    overlap = (set(df.columns) & set(other.columns)) - set(keys)
    lren = {c: c + suffixes[0] for c in overlap}
    rren = {c: c + suffixes[1] for c in overlap}
    left = df.withColumnsRenamed(lren).alias("__l")
    right = other.withColumnsRenamed(rren).alias("__r")
    cond = reduce(lambda a, b: a & b, [F.col(f"__l.{k}").eqNullSafe(F.col(f"__r.{k}")) for k in keys])
    j = left.join(right, cond, how)
    out = []
    for c in left.columns:
        if c in keys:
            if how in ("full_outer", "right"):
                out.append(F.coalesce(F.col(f"__l.{c}"), F.col(f"__r.{c}")).alias(c))
            else:
                out.append(F.col(f"__l.{c}").alias(c))
        else:
            out.append(F.col(f"__l.{c}").alias(c))
    out += [F.col(f"__r.{c}").alias(c) for c in right.columns if c not in keys]
    return j.select(*out)


def apply_function(df: DataFrame, column: str, func: Callable, new_column: str | None = None,
                   return_type: str | T.DataType = "double") -> DataFrame:
    """Python function on every value, run as an Arrow-batched pandas UDF."""

    @F.pandas_udf(return_type)
    def _value_fn(s: pd.Series) -> pd.Series:
        return s.map(func)

    return df.withColumn(new_column or column, _value_fn(F.col(column)))


# Period start and period-end label for the resample frequencies.
def _period_start(d: Column, freq: str) -> Column:
    f = freq.upper()
    if f == "D":
        return F.to_date(d)
    if f == "W":
        return F.trunc(F.to_date(d), "week")
    if f in ("M", "ME"):
        return F.trunc(F.to_date(d), "month")
    if f in ("Q", "QE"):
        return F.trunc(F.to_date(d), "quarter")
    if f in ("Y", "A", "YE"):
        return F.trunc(F.to_date(d), "year")
    raise ValueError(f"unknown frequency: {freq}")


def _period_label(start: Column, freq: str) -> Column:
    f = freq.upper()
    if f == "D":
        return start
    if f == "W":
        return F.date_add(start, 6)              # weeks end on Sunday
    if f in ("M", "ME"):
        return F.last_day(start)
    if f in ("Q", "QE"):
        return F.last_day(F.add_months(start, 2))
    return F.make_date(F.year(start), F.lit(12), F.lit(31))


def _step(freq: str) -> Column:
    f = freq.upper()
    return {"D": F.expr("INTERVAL 1 DAY"), "W": F.expr("INTERVAL 7 DAYS")}.get(
        f, F.expr("INTERVAL 3 MONTHS") if f in ("Q", "QE") else
        F.expr("INTERVAL 1 YEAR") if f in ("Y", "A", "YE") else F.expr("INTERVAL 1 MONTH"))


def resample_time(df: DataFrame, date_column: str, freq: str, agg_func: str = "sum",
                  order_by: Sequence[str] | str | Column | None = None) -> DataFrame:
    """Regular time bins over the numeric columns, labelled by period end
    (W = Sunday, M/Q/Y = last day), empty bins present (sum → 0, mean → NULL, N21).

    The data is reduced to one row per bin with partial aggregation; the spine
    of all bins between the first and last one is generated from a one-row
    min/max aggregate (its size is the number of periods, not the data size)
    and left-joined. ``first`` and ``last`` need ``order_by``, as rows of one bin have no order.
    Deviation: only numeric columns are aggregated.
    """
    dtype = df.schema[date_column].dataType
    nums = [c for c in numeric_columns(df) if c != date_column]
    start = _period_start(F.col(date_column), freq)
    binned = (df.where(F.col(date_column).isNotNull())
              .groupBy(start.alias("__start"))
              .agg(*[agg_column(agg_func, c, order_by).alias(c) for c in nums]))
    spine = (binned.agg(F.min("__start").alias("lo"), F.max("__start").alias("hi"))
             .where(F.col("lo").isNotNull())
             .select(F.explode(F.sequence("lo", "hi", _step(freq))).alias("__start")))
    out = spine.join(binned, "__start", "left")
    if agg_func in ("sum", "count", "size", "nunique"):
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in nums})
    label = _period_label(F.col("__start"), freq)
    label = label.cast(dtype) if not isinstance(dtype, T.DateType) else label
    return out.select(label.alias(date_column), *nums)
