"""Aggregation operators: group-by, describe, totals, shares, top-k, period
comparison, cross tabs, percentiles, total rows, metric sets.

All of them are aggregates with map-side partial aggregation; grand totals are
one-row scalar subqueries, multi-dimension tables are rolled up from the rows of the finest key.
NaN values count as missing (N3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import (as_list, drop_null_keys, nan_to_null, numeric_columns, sort_exprs,
                               string_columns, sum0)
from ..functions import stats as st
from ..functions.time import literal_like
from ..session import ensure_checkpoint_dir
from . import transform as tr


def group_by(df: DataFrame, columns: Sequence[str] | str, aggregations: dict[str, str | list[str]],
             order_by: str | None = None) -> DataFrame:
    """Multi-function group-by; outputs ``col_func`` for lists, ``col`` for one function.
    Key columns keep their names (the reference renames them ``key_``)."""
    return tr.aggregate(df, columns, aggregations, order_by=order_by)


_STATS = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def summarize(df: DataFrame, numeric_only: bool = True, exact: bool = True) -> DataFrame:
    """describe(): one row per column (transposed layout, fixed schema):
    column, count, mean, std, min, q25, q50, q75, max [, unique, top, freq].

    numeric_only: numeric columns (booleans excluded, N26), quantiles linear (N10).
    Otherwise string columns are added with count, unique, top (most frequent,
    smallest on ties) and freq; their numeric statistics are NULL.
    Moments come from one aggregate, the quantiles of all columns from shared
    passes, unique and top values of all string columns from one value index
    (functions.stats); the result has one row per column.
    """
    df = nan_to_null(df)
    nums = numeric_columns(df)
    strs = [] if numeric_only else string_columns(df)
    if not nums and not strs:
        raise ValueError("no columns to describe")
    aggs = []
    for c in nums:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    for c in strs:
        aggs.append(F.count(c).alias(f"{c}__count"))
    m = st.one_row(df.agg(*aggs))
    points = [0.25, 0.5, 0.75]
    quartiles = st.exact_quantiles_of(df, nums, points) if exact and nums else {c: st.approx_quantiles(df, c, points) for c in nums}
    tops = st.top_values(df, strs)
    rows = []
    for c in nums:
        q = quartiles[c]
        rows.append((c, float(m[f"{c}__count"]), m[f"{c}__mean"], m[f"{c}__std"], m[f"{c}__min"], q[0], q[1], q[2],
                     m[f"{c}__max"]) + (() if numeric_only else (None, None, None)))
    for c in strs:
        unique, top, freq = tops[c]
        rows.append((c, float(m[f"{c}__count"]), None, None, None, None, None, None, None,
                     unique, top, freq if top is not None else None))
    schema = ("column string, count double, mean double, std double, min double, q25 double, q50 double, "
              "q75 double, max double")
    if not numeric_only:
        schema += ", unique long, top string, freq long"
    return df.sparkSession.createDataFrame(rows, schema)


def calculate_totals(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, total) for each numeric column (listed non-numeric columns are skipped)."""
    df = nan_to_null(df)
    nums = numeric_columns(df)
    cols = [c for c in (as_list(columns) or nums) if c in nums]
    row = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), sum0(F.col(c).cast("double")).alias("total"))
                           for c in cols]).alias("__t"))
    return row.select(F.inline("__t"))


def calculate_percentages(df: DataFrame, value_column: str, group_column: str | None = None,
                          output: str = "percentage") -> DataFrame:
    """Group share of the grand total × 100 (group, percentage), or every row
    plus its share. The grand total is a scalar subquery (one aggregate)."""
    df = nan_to_null(df, [value_column])
    total = df.select(F.sum(value_column).alias("t")).scalar()
    if group_column:
        g = drop_null_keys(df, [group_column]).groupBy(group_column).agg(sum0(value_column).alias("__s"))
        return g.select(group_column, (F.try_divide(F.col("__s"), total) * 100).alias(output))
    return df.withColumn(output, F.try_divide(F.col(value_column), total) * 100)


def top_n(df: DataFrame, column: str, n: int = 10, ascending: bool = False,
          tie_breaker: Sequence[str] | str | None = None) -> DataFrame:
    """n largest (or smallest) rows; NULLs last (N17). Planned as TakeOrderedAndProject:
    each partition keeps its own top n, the driver merges n × partitions rows."""
    df = nan_to_null(df, [column])
    order = sort_exprs([column], [ascending]) + [F.col(c).asc_nulls_last() for c in as_list(tie_breaker)]
    return df.orderBy(*order).limit(n)


def bottom_n(df: DataFrame, column: str, n: int = 10, tie_breaker=None) -> DataFrame:
    return top_n(df, column, n, ascending=True, tie_breaker=tie_breaker)


def compare_periods(df: DataFrame, date_column: str, value_column: str, current_period,
                    previous_period=None, bounded: bool = False) -> DataFrame:
    """One row: current, previous, change, change_percentage (0 if previous is 0).

    current = sum where date ≥ current_period; previous = sum of everything
    earlier (the reference ignores ``previous_period``); ``bounded=True`` uses
    previous_period ≤ date < current_period instead.
    """
    df = nan_to_null(df, [value_column])
    d = F.col(date_column)
    cur_start = literal_like(df, date_column, current_period)
    is_cur = d >= cur_start
    is_prev = d < cur_start
    if bounded and previous_period is not None:
        is_prev = is_prev & (d >= literal_like(df, date_column, previous_period))
    v = F.col(value_column)
    row = df.agg(sum0(F.when(is_cur, v)).alias("current"), sum0(F.when(is_prev, v)).alias("previous"))
    change = F.col("current") - F.col("previous")
    return row.select("current", "previous", change.alias("change"),
                      F.when(F.col("previous") != 0, change / F.col("previous") * 100).otherwise(F.lit(0.0))
                      .alias("change_percentage"))


def cross_tabulation(df: DataFrame, row_column: str, col_column: str, value_column: str | None = None,
                     aggfunc: str = "count", column_values: Sequence | None = None,
                     order_by: Sequence[str] | str | None = None) -> DataFrame:
    """Frequency table (absent cell 0, N20) or aggregated cells (absent cell NULL)."""
    if value_column is None:
        src = drop_null_keys(df, [row_column, col_column])
        vals = sorted(column_values) if column_values is not None else None
        t = src.groupBy(row_column).pivot(col_column, vals).count()
        return t.na.fill(0, subset=[c for c in t.columns if c != row_column])
    return tr.pivot(df, row_column, col_column, value_column, aggfunc, column_values, order_by)


def percentiles(df: DataFrame, column: str, qs: Sequence[float] = (0.25, 0.5, 0.75), exact: bool = True,
                names: Sequence[str] | None = None) -> DataFrame:
    """One row p25, p50, p75 (linear interpolation, N10), computed distributed
    (functions.stats); ``exact=False`` → approx_percentile."""
    names = list(names or [f"p{int(round(q * 100))}" for q in qs])
    values = st.quantiles(df, column, list(qs), exact)
    return df.sparkSession.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in names))


def add_total_row(df: DataFrame, label_column: str, sum_columns: Sequence[str], label: str = "TOTAL",
                  flag_column: str = "is_total") -> DataFrame:
    """Append one TOTAL row (label in ``label_column``, sums of ``sum_columns``);
    ``flag_column`` marks it so a sort can keep it last."""
    df = nan_to_null(df, sum_columns)
    total = df.agg(*[sum0(c).alias(c) for c in sum_columns]).withColumn(label_column, F.lit(label))
    return (df.withColumn(flag_column, F.lit(False))
            .unionByName(total.withColumn(flag_column, F.lit(True)), allowMissingColumns=True))


def _finest(df: DataFrame, value_column: str, dims: list[str]) -> DataFrame:
    """Sum, count, extrema per combination of the dimensions, written once: the bottom of the roll-up lattice.

    The rows of the input are read and aggregated once; every coarser table is a sum over these
    rows, of which there are as many as combinations occur.
    """
    ensure_checkpoint_dir(df.sparkSession)
    v = F.col(value_column)
    return df.groupBy(*dims).agg(F.sum(v).alias("__s"), F.count(v).alias("__n"), F.max(v).alias("__mx"),
                                 F.min(v).alias("__mn")).checkpoint(eager=True)


def _per_dimension(fine: DataFrame, dims: list[str]) -> DataFrame:
    """``__d, key, value``: the sum per value of each dimension (NULL keys dropped), each finest row counted into all dimensions at once."""
    entries = [F.struct(F.lit(i).alias("__d"), F.col(d).cast("string").alias("key")) for i, d in enumerate(dims)]
    long = fine.select("__s", F.inline(F.array(*entries))).where(F.col("key").isNotNull())
    return long.groupBy("__d", "key").agg(sum0("__s").cast("double").alias("value"))


def calculate_metrics(df: DataFrame, value_column: str, dimensions: Sequence[str]) -> DataFrame:
    """Long (metric, key, value): total, mean, max, min and the sum per value of
    each dimension. The table is aggregated once at the finest key; all metrics are
    rolled up from those rows."""
    df = nan_to_null(df, [value_column])
    dims = as_list(dimensions)
    fine = _finest(df, value_column, dims)
    total = F.sum("__s")
    overall = fine.agg(F.inline(F.array(
        *[F.struct(F.lit(n).alias("metric"), F.lit(None).cast("string").alias("key"), c.cast("double").alias("value"))
          for n, c in (("total", sum0("__s")), ("mean", F.try_divide(total.cast("double"), F.sum("__n"))),
                       ("max", F.max("__mx")), ("min", F.min("__mn")))])))
    names = F.array(*[F.lit(f"by_{d}") for d in dims]).cast("array<string>")
    return overall.unionByName(_per_dimension(fine, dims).select(names[F.col("__d")].alias("metric"), "key", "value"))


def group_sheets(df: DataFrame, value_column: str, dimensions: Sequence[str]) -> DataFrame:
    """One sum table per dimension, long (dimension, key, value), rolled up from the finest key (see ``calculate_metrics``)."""
    df = nan_to_null(df, [value_column])
    dims = as_list(dimensions)
    names = F.array(*[F.lit(d) for d in dims]).cast("array<string>")
    return _per_dimension(_finest(df, value_column, dims), dims).select(names[F.col("__d")].alias("dimension"), "key", "value")


def split_sheets(long_df: DataFrame, dimensions: Sequence[str]) -> dict[str, DataFrame]:
    """Named per-dimension tables from ``group_sheets`` (lazy filters, no recompute
    if the long table is persisted by the caller)."""
    return {d: long_df.where(F.col("dimension") == d).select(F.col("key").alias(d), "value") for d in dimensions}
