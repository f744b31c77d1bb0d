"""Null and NaN rules of the reference's data model, as Spark Column helpers.

The reference works on pandas, where NaN, None and NaT are one "missing"
notion, group keys drop missing values, sums of nothing are 0 and sorts put
missing values last. Spark has separate NULL and NaN and different defaults.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)
TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (list, tuple)):
        return list(x)
    return [x]


def numeric_columns(df: DataFrame, include_bool: bool = False) -> list[str]:
    """Numeric columns; booleans only when asked (N26)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, NUMERIC_TYPES) or (include_bool and isinstance(f.dataType, T.BooleanType)):
            out.append(f.name)
    return out


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_numeric(df: DataFrame, name: str, include_bool: bool = False) -> bool:
    return name in numeric_columns(df, include_bool)


# N1 — group keys drop missing values
def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = as_list(keys)
    if not keys:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


# N2 — sum of an all-missing group is 0
def sum0(c: str | Column) -> Column:
    return F.coalesce(F.sum(col_of(c)), F.lit(0))


# N3 — NaN is missing: normalise to NULL once, at the scan
def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, FRACTIONAL_TYPES) and (columns is None or f.name in set(columns))]
    if not cols:
        return df
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)) for c in cols})


# N4 — merge matches NULL to NULL
def null_safe_condition(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in on])


# N6 — `!=` keeps NULL rows
def ne_keep_null(c: str | Column, value) -> Column:
    return ~col_of(c).eqNullSafe(F.lit(value))


# N7 — isin with None in the list matches NULL. Meant for ``where`` (a NULL
# outcome drops the row); kept free of wrappers so the scan can take it as
# In(...) OR IsNull(...).
def isin_with_null(c: str | Column, values: Sequence) -> Column:
    vals = list(values)
    non_null = [v for v in vals if v is not None]
    cond = col_of(c).isin(non_null) if non_null else F.lit(False)
    if len(non_null) != len(vals):
        cond = cond | col_of(c).isNull()
    return cond


# N8 — str.contains is a regex, missing → False
def contains_regex(c: str | Column, pattern: str) -> Column:
    return F.coalesce(col_of(c).rlike(pattern), F.lit(False))


# N9 — NULLs last in both directions
def sort_exprs(by: Sequence[str] | str, ascending: bool | Sequence[bool] = True) -> list[Column]:
    by = as_list(by)
    asc = as_list(ascending) if isinstance(ascending, (list, tuple)) else [ascending] * len(by)
    if len(asc) != len(by):
        raise ValueError(f"{len(by)} sort columns but {len(asc)} directions")
    return [F.col(b).asc_nulls_last() if a else F.col(b).desc_nulls_last() for b, a in zip(by, asc)]


# N10 (linear quantiles) and N11 (mode = smallest of the ties) are computed
# distributed in functions.stats.


# N18 — division by zero gives missing (documented deviation: NULL, not inf)
def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


# N27 — first/last skip missing values and follow the order key
def first_non_null(v: str | Column, order: str | Column) -> Column:
    v = col_of(v)
    return F.min_by(v, F.when(v.isNotNull(), col_of(order)))


def last_non_null(v: str | Column, order: str | Column) -> Column:
    v = col_of(v)
    return F.max_by(v, F.when(v.isNotNull(), col_of(order)))


# N28 — sample statistics (n-1)
def std(c: str | Column) -> Column:
    return F.stddev_samp(col_of(c))


def var(c: str | Column) -> Column:
    return F.var_samp(col_of(c))
