"""Named reporting periods as half-open [start, next_start) bounds.

Bounds are computed on the driver from an explicit ``as_of`` (no
CURRENT_DATE inside the plan), so a filter on a date-partitioned table prunes
partitions and Parquet row groups. Weeks start on Monday.
Deviation: the reference's inclusive end (23:59:59.999999, weeks 23:59:59)
becomes the next period's start, exclusive.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import literal_like

PERIODS = ("today", "yesterday", "this_week", "last_week", "this_month", "last_month", "this_quarter", "this_year")


def _midnight(d: dt.date) -> dt.datetime:
    return dt.datetime(d.year, d.month, d.day)


def _add_months(d: dt.date, n: int) -> dt.date:
    m = d.month - 1 + n
    return dt.date(d.year + m // 12, m % 12 + 1, 1)


def date_range(period: str, as_of: dt.date | dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """(start, next_start) of ``period`` around ``as_of``."""
    ref = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    if period == "today":
        s = ref
        return _midnight(s), _midnight(s + dt.timedelta(days=1))
    if period == "yesterday":
        s = ref - dt.timedelta(days=1)
        return _midnight(s), _midnight(ref)
    if period == "this_week":
        s = ref - dt.timedelta(days=ref.weekday())
        return _midnight(s), _midnight(s + dt.timedelta(days=7))
    if period == "last_week":
        s = ref - dt.timedelta(days=ref.weekday() + 7)
        return _midnight(s), _midnight(s + dt.timedelta(days=7))
    if period == "this_month":
        s = ref.replace(day=1)
        return _midnight(s), _midnight(_add_months(s, 1))
    if period == "last_month":
        s = _add_months(ref.replace(day=1), -1)
        return _midnight(s), _midnight(ref.replace(day=1))
    if period == "this_quarter":
        s = dt.date(ref.year, (ref.month - 1) // 3 * 3 + 1, 1)
        return _midnight(s), _midnight(_add_months(s, 3))
    if period == "this_year":
        return dt.datetime(ref.year, 1, 1), dt.datetime(ref.year + 1, 1, 1)
    raise ValueError(f"Unknown period: {period}")


def _bound(df: DataFrame, column: str, value: dt.datetime):
    return literal_like(df, column, value)


def filter_period(df: DataFrame, column: str, period: str, as_of: dt.date | dt.datetime) -> DataFrame:
    start, end = date_range(period, as_of)
    c = F.col(column)
    return df.where((c >= _bound(df, column, start)) & (c < _bound(df, column, end)))


def filter_since(df: DataFrame, column: str, start: dt.datetime) -> DataFrame:
    return df.where(F.col(column) >= _bound(df, column, start))
